"""Grid-bin approximate spatial join (J2/J3) and nearest match per observation.

Semantics (reference intent, SURVEY §2.4/§2.6, §7.3):
  * both sides get ``lat_bin = floor(lat / 0.7)``, ``lon_bin = floor(lon / 0.7)``;
  * an observation's candidates are the locations of exactly its bin (no neighbour bins);
  * the nearest candidate by great-circle miles wins (rounded to 4 dp, ties broken by the
    caller's tie-breaker columns), one row per observation id;
  * observations without a candidate (or without coordinates) survive with null location
    columns and a null distance (left-join semantics).

Physical plan, an adaptive grid:
  * places at one point are one place (the best by the tie breakers), so a point that many share is no hot cell;
  * every bin gets a sub-grid sized from its count, about ``CELL_PLACES`` places a sub-cell. Each sub-cell lists the
    places of the 3x3 block around it (coordinates and tie breakers only), and an observation joins exactly one list,
    on the plain columns bin, row and column: the work per observation does not grow with the places of the bin;
  * a list's places are first compared by the cosine of their angle to the observation, three products each; only those
    as near as the nearest, within more than the rounding of a distance, are measured in miles and ranked;
  * a lower bound on the distance to everything outside the block proves nearly all answers. The others, whose
    block is empty or whose nearest place lies near its edge, search their whole bin in a second pass;
  * the winner's other columns are joined last, on its coordinates.
When the lists are proven small (a measured byte size) they are broadcast and the observation side is one narrow
stage. Otherwise the lists are joined by a shuffle, whose hot side is the observations' (AQE can split the left side
of a left join); observations without coordinates or without places in their bin never enter it, and
the second pass spreads each bin over chunks of at most ``chunk_size`` places.
"""

from __future__ import annotations

from typing import NamedTuple, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geomedallion.functions.geo import (
    DISTANCE_DIGITS, EARTH_RADIUS_KM, GRID_BIN_DEGREES, KM_PER_MILE, grid_bin, rounded_miles,
)
from geomedallion.operators.dedup import Order, first_by_key, orderable
from geomedallion.operators.joins import salted_left_join
from geomedallion.operators.sizing import DEFAULT_BROADCAST_MAX_ROWS, Size, broadcast_if_small, measure
from geomedallion.session import ensure_checkpoint_dir

__all__ = ["BIN_COLS", "add_bins", "bin_join", "candidate_lists", "nearest_location"]

BIN_COLS = ("lat_bin", "lon_bin")
CELL_COLS = ("__r", "__c")
DEFAULT_CHUNK_SIZE = 256
CELL_PLACES = 4  # places a sub-cell, about; a bin of nine times as many is one list
MAX_SUBGRID = 4096
LIST_COPIES = 10  # a place stands in nine lists, and in its whole bin
_R_MILES = EARTH_RADIUS_KM / KM_PER_MILE
_BOUND_MARGIN_MILES = 1e-6  # floating-point slack on the lower bound
# distances equal when rounded lie less than a unit of their last digit apart, cosines then less than half of this
_COSINE_MARGIN = 8 * 10.0 ** -DISTANCE_DIGITS / (2 * _R_MILES)
_UNIT = ("__x", "__y", "__z")


def add_bins(df: DataFrame, lat: str, lon: str, size: float = GRID_BIN_DEGREES) -> DataFrame:
    """F8 on both coordinates."""
    return df.withColumns({BIN_COLS[0]: grid_bin(lat, size), BIN_COLS[1]: grid_bin(lon, size)})


def bin_join(
    left: DataFrame,
    right: DataFrame,
    *,
    left_lat: str,
    left_lon: str,
    right_lat: str,
    right_lon: str,
    size: float = GRID_BIN_DEGREES,
    how: str = "left",
    distance_col: str | None = "dist_miles",
    broadcast_max_rows: int = DEFAULT_BROADCAST_MAX_ROWS,
) -> DataFrame:
    """J2/J3 candidate pairs: equi-join on (lat_bin, lon_bin), plus the great-circle distance.

    The right side is broadcast only when measured small, in rows and in bytes. Otherwise a left join goes through
    ``salted_left_join``: a bin holding a large share of the right rows is split over several
    tasks (AQE could split only the left side of a left outer join).
    """
    l = add_bins(left, left_lat, left_lon, size)
    r = add_bins(right, right_lat, right_lon, size)
    r, small = broadcast_if_small(r, broadcast_max_rows)
    if small or how != "left":
        out = l.join(r, list(BIN_COLS), how)
    else:
        out = salted_left_join(l, r, list(BIN_COLS), broadcast_max_rows=broadcast_max_rows)
    if distance_col:
        out = out.withColumn(distance_col, rounded_miles(left_lat, left_lon, right_lat, right_lon))
    return out


def _sub_index(coord: Column, bin_col: Column, size: float, g: Column) -> Column:
    """Row / column of the sub-cell holding ``coord`` inside its bin (clamped against rounding)."""
    v = F.floor((coord - bin_col.cast("double") * F.lit(float(size))) / (F.lit(float(size)) / g)).cast("int")
    return F.least(F.greatest(v, F.lit(0)), g - 1)


def _cell(lat: Column, lon: Column, size: float) -> list[Column]:
    g = F.col("__g")
    return [_sub_index(lat, F.col(BIN_COLS[0]), size, g).alias(CELL_COLS[0]), _sub_index(lon, F.col(BIN_COLS[1]), size, g).alias(CELL_COLS[1])]


def _block_lower_bound(lat: Column, lon: Column, size: float) -> Column:
    """Miles below which no candidate outside the 3x3 sub-cell block around the observation's sub-cell can lie.

    Latitude edges: a great circle is at least as long as the meridian arc, R * dphi.
    Longitude edges: haversine h >= cos^2(max |lat| of the bin) * sin^2(dlambda / 2).
    A side of the block lying on the bin edge has nothing beyond it (same-bin candidates only).
    Null when no side has anything beyond it (the block is the whole bin).
    """
    r, c, g = F.col(CELL_COLS[0]), F.col(CELL_COLS[1]), F.col("__g")
    cell = F.lit(float(size)) / g
    lat0 = F.col("lat_bin").cast("double") * F.lit(float(size))
    lon0 = F.col("lon_bin").cast("double") * F.lit(float(size))
    cos_min = F.cos(F.radians(F.greatest(F.abs(lat0), F.abs(lat0 + F.lit(float(size))))))

    def meridian(d_deg: Column) -> Column:
        return F.lit(_R_MILES) * F.radians(d_deg)

    def parallel(d_deg: Column) -> Column:
        return F.lit(2 * _R_MILES) * F.asin(F.least(F.lit(1.0), cos_min * F.sin(F.radians(d_deg) / 2)))

    sides = [
        F.when(r - 1 > 0, meridian(lat - (lat0 + (r - 1) * cell))),
        F.when(r + 1 < g - 1, meridian(lat0 + (r + 2) * cell - lat)),
        F.when(c - 1 > 0, parallel(lon - (lon0 + (c - 1) * cell))),
        F.when(c + 1 < g - 1, parallel(lon0 + (c + 2) * cell - lon)),
    ]
    return F.least(*sides)  # least() skips nulls: the sides that exist


def _unit_vector(lat: Column, lon: Column) -> list[Column]:
    p, l = F.radians(lat), F.radians(lon)
    return [(F.cos(p) * F.cos(l)).alias(_UNIT[0]), (F.cos(p) * F.sin(l)).alias(_UNIT[1]), F.sin(p).alias(_UNIT[2])]


def _with_best(df: DataFrame, candidates: str, best: str, lat: Column, lon: Column, ties: Sequence[str]) -> DataFrame:
    """``df`` (with its rows' unit vector) and the best place of the list ``candidates``, null where there is none."""

    def cosine(p: Column) -> Column:  # a coordinate that is no number counts as the far end, as its clamped distance does
        x, y, z = (F.col(u) * p[u] for u in _UNIT)
        return F.nanvl(x + y + z, F.lit(-1.0))

    def key(p: Column) -> Column:
        # a candidate list was joined on bins, so the observation's coordinates are present
        d = rounded_miles(lat, lon, p.lat, p.lon, inputs_present=True)
        return F.struct(d.alias("d"), *[p[t].alias(t) for t in ties], p.lat.alias("lat"), p.lon.alias("lon"))

    df = df.withColumn("__cosines", F.transform(candidates, cosine))
    df = df.withColumn("__least", F.array_max("__cosines") - F.lit(_COSINE_MARGIN))
    near = F.filter(candidates, lambda p, i: F.get("__cosines", i) >= F.col("__least"))
    # __least is tested here too: an expression used once would be inlined, and evaluated for every place
    return df.withColumn(best, F.when(F.col("__least").isNotNull(), F.array_min(F.transform(near, key))))


class CandidateLists(NamedTuple):
    points: DataFrame  # __lat, __lon, __row: one place a point, its tie breakers and its columns (loc)
    grid: DataFrame  # bins, __n places, __g sub-cells a side
    narrow: DataFrame  # bins, __n, __g, cells, __place: tie breakers, coordinates, unit vector
    lists: DataFrame  # bins, cells, __near: the places of the 3x3 block around a sub-cell


def candidate_lists(
    locs: DataFrame, loc_lat: str, loc_lon: str, tie_breakers: Sequence[str] = (), size: float = GRID_BIN_DEGREES, cell_places: float = CELL_PLACES
) -> CandidateLists:
    """The adaptive grid over ``locs`` (rows without coordinates are left out)."""
    bins, cells, ties, loc_cols = list(BIN_COLS), list(CELL_COLS), [f"t{i}" for i in range(len(tie_breakers))], locs.columns
    present = locs.where(F.col(loc_lat).isNotNull() & F.col(loc_lon).isNotNull())
    best_row = F.min(F.struct(*[F.col(f"`{t}`").alias(n) for t, n in zip(tie_breakers, ties)], F.struct(*[F.col(f"`{c}`") for c in loc_cols]).alias("loc")))
    points = present.groupBy(F.col(loc_lat).alias("__lat"), F.col(loc_lon).alias("__lon")).agg(best_row.alias("__row"))
    ensure_checkpoint_dir(points.sparkSession)
    points = points.checkpoint(eager=True)  # the grid, the lists, the whole bins and the winners' columns go on from here
    places = add_bins(points, "__lat", "__lon", size)
    per_side = F.ceil(F.sqrt(F.col("__n") / F.lit(float(cell_places)))).cast("int")
    side = F.when(F.col("__n") <= 9 * cell_places, F.lit(1)).otherwise(F.least(F.lit(MAX_SUBGRID), per_side))
    grid = places.groupBy(*bins).agg(F.count(F.lit(1)).alias("__n")).withColumn("__g", side)

    at = [F.col("__lat").alias("lat"), F.col("__lon").alias("lon"), *_unit_vector(F.col("__lat"), F.col("__lon"))]
    place = F.struct(*[F.col("__row").getField(t).alias(t) for t in ties], *at).alias("__place")
    narrow = places.join(grid, bins).select(*bins, "__g", "__n", *_cell(F.col("__lat"), F.col("__lon"), size), place)
    offsets = F.array(F.lit(-1), F.lit(0), F.lit(1))
    block = F.flatten(F.transform(offsets, lambda i: F.transform(offsets, lambda j: F.struct((F.col(cells[0]) + i).alias("r"), (F.col(cells[1]) + j).alias("c")))))
    inside = F.filter(block, lambda b: (b.r >= 0) & (b.r < F.col("__g")) & (b.c >= 0) & (b.c < F.col("__g")))
    lists = narrow.select(*bins, "__place", F.explode(inside).alias("__b")).groupBy(*bins, F.col("__b.r").alias(cells[0]), F.col("__b.c").alias(cells[1]))
    lists = lists.agg(F.collect_list("__place").alias("__near"))

    return CandidateLists(points, grid, narrow, lists)


def nearest_location(
    obs: DataFrame,
    locs: DataFrame,
    *,
    id_col: str,
    obs_lat: str,
    obs_lon: str,
    loc_lat: str = "geo_lat",
    loc_lon: str = "geo_lon",
    tie_breakers: Sequence[str] = (),
    size: float = GRID_BIN_DEGREES,
    ids_unique: bool = False,
    distance_col: str = "dist_miles",
    broadcast_max_rows: int = DEFAULT_BROADCAST_MAX_ROWS,
    chunk_size: int = DEFAULT_CHUNK_SIZE,
    locs_size: Size | None = None,
    cell_places: float = CELL_PLACES,
) -> DataFrame:
    """Each observation id with its nearest same-bin location.

    Output columns: obs columns, lat_bin, lon_bin, location columns, ``distance_col``.
    ``ids_unique=True`` declares ``id_col`` unique (e.g. the weather id after silver
    de-duplication) and skips the per-id reduction; it is the caller's promise (without it, rows that share an id,
    or have none, are one). ``locs_size`` is a size the caller has already measured; where it is too large to broadcast,
    the places left at one a point are measured. Ties beyond the tie breakers
    go to the least coordinates, then to the least location row.
    """
    loc_cols = list(locs.columns)
    clash = set(obs.columns) & (set(loc_cols) | set(BIN_COLS) | {distance_col})
    if clash:
        raise ValueError(f"observation and location columns overlap: {sorted(clash)}")
    for t in tie_breakers:
        if t not in loc_cols:
            raise ValueError(f"tie breaker {t!r} is not a location column")
    bins, cells, lat, lon = list(BIN_COLS), list(CELL_COLS), F.col(obs_lat), F.col(obs_lon)
    ties = [f"t{i}" for i in range(len(tie_breakers))]

    grids = candidate_lists(locs, loc_lat, loc_lon, tie_breakers, size, cell_places)
    points, grid, narrow, lists = grids.points, grids.grid, grids.narrow, grids.lists

    # the block's winner is final when every candidate outside the block is strictly farther
    scale = float(10 ** DISTANCE_DIGITS)
    bound = _block_lower_bound(lat, lon, size)
    floor = F.floor((bound - F.lit(_BOUND_MARGIN_MILES)) * F.lit(scale)) / F.lit(scale)
    is_final = F.col("__g").isNull() | bound.isNull() | F.coalesce(F.col("__best.d") < floor, F.lit(False))

    ob = add_bins(obs, obs_lat, obs_lon, size)
    obs_cols = list(ob.columns)
    kept = [F.col(f"`{c}`") for c in obs_cols]
    unit = _unit_vector(lat, lon)  # computed below the join with the lists: once an observation

    def small(found: Size) -> bool:
        return found.rows <= broadcast_max_rows and found.fits(copies=LIST_COPIES)

    # what is broadcast is one place a point: places too many to broadcast may stand at few points
    held = points.select(*[F.col("__row.loc").getField(c).alias(c) for c in loc_cols])
    broadcast = (locs_size is not None and small(locs_size)) or (broadcast_max_rows > 0 and small(measure(held)))
    if broadcast:
        first = ob.join(F.broadcast(grid.select(*bins, "__g")), bins, "left").select(*kept, "__g", *unit, *_cell(lat, lon, size))
        first = _with_best(first.join(F.broadcast(lists), bins + cells, "left"), "__near", "__best", lat, lon, ties)
        first = first.select(*kept, *_UNIT, "__best", is_final.alias("__final"))
        # only what is not proven finds its bin here
        whole = narrow.where(F.col("__g") > 1).groupBy(*[F.col(b).alias(f"__{b}") for b in bins]).agg(F.collect_list("__place").alias("__all"))
        open_bin = [F.when(~F.col("__final"), F.col(b)) == F.col(f"__{b}") for b in bins]
        second = first.join(F.broadcast(whole), open_bin, "left")
        second = _with_best(second, "__all", "__found", lat, lon, ties)  # the final ones have no bin here
        out = second.select(*kept, F.when(F.col("__final"), F.col("__best")).otherwise(F.col("__found")).alias("__best"))
    else:
        ensure_checkpoint_dir(ob.sparkSession)
        ob = ob.checkpoint(eager=True)  # read twice from here: with places in their bin and without
        grid_side, grid_small = broadcast_if_small(grid.select(*bins, "__g"), broadcast_max_rows)
        placed = ob.where(F.col(bins[0]).isNotNull() & F.col(bins[1]).isNotNull()) if not grid_small else ob
        placed = placed.join(grid_side, bins, "left").select(*kept, "__g", *unit, *_cell(lat, lon, size))
        alone = placed.where(F.col("__g").isNull()).select(*kept)  # these enter no exchange
        if not grid_small:
            alone = alone.unionByName(ob.where(F.col(bins[0]).isNull() | F.col(bins[1]).isNull()))
        first = placed.where(F.col("__g").isNotNull()).join(lists, bins + cells, "left")
        first = _with_best(first, "__near", "__best", lat, lon, ties).select(*kept, "__best", is_final.alias("__final"))
        nothing = F.lit(None).cast(first.schema["__best"].dataType).alias("__best")
        first = first.unionByName(alone.select(*kept, nothing, F.lit(True).alias("__final")))
        first = first.checkpoint(eager=True)  # both passes go on from here
        chunk = F.pmod(F.xxhash64("__place"), F.ceil(F.col("__n") / F.lit(float(chunk_size)))).cast("int")
        chunks = narrow.where(F.col("__g") > 1).select(*bins, chunk.alias("__chunk"), "__place")
        chunks = chunks.groupBy(*bins, "__chunk").agg(F.collect_list("__place").alias("__all"))
        wide = first.where(~F.col("__final")).select(*kept, *unit).join(chunks, bins, "left")
        searched = _with_best(wide, "__all", "__best", lat, lon, ties).select(*kept, "__best")
        if ids_unique:  # the best of an observation's chunks
            rest = [c for c in obs_cols if c != id_col]
            least = searched.groupBy(id_col).agg(F.min("__best").alias("__best"), *[F.first(c).alias(c) for c in rest])
            searched = least.select(*kept, "__best")
        out = first.where("__final").select(*kept, "__best").unionByName(searched)
    if not ids_unique:
        rest = [c for c in obs_cols if c != id_col and orderable(ob.schema[c].dataType)]
        flat = [F.col("__best").getField(n).alias(f"__{n}") for n in ("d", *ties, "lat", "lon")]
        order = [Order("__d"), *[Order(f"__{t}", nulls_first=True) for t in ties], *[Order(c, nulls_first=True) for c in rest]]
        out = first_by_key(out.select(*kept, *flat), [id_col], order + [Order("__lat"), Order("__lon")])
        out = out.select(*kept, F.col("__d").alias(distance_col), F.col("__lat").alias("__at"), F.col("__lon").alias("__on"))
    else:
        out = out.select(*kept, F.col("__best.d").alias(distance_col), F.col("__best.lat").alias("__at"), F.col("__best.lon").alias("__on"))
    at = (F.col("__at") == F.col("__lat")) & (F.col("__on") == F.col("__lon"))
    columns = [*kept, *[F.col("__row.loc").getField(c).alias(c) for c in loc_cols], distance_col]
    if broadcast:
        return out.join(F.broadcast(points), at, "left").select(*columns)
    matched = out.where(F.col("__at").isNotNull()).join(points, at, "left").select(*columns)
    types = {f.name: f.dataType for f in locs.schema.fields}
    unmatched = [*kept, *[F.lit(None).cast(types[c]).alias(c) for c in loc_cols], distance_col]
    return matched.unionByName(out.where(F.col("__at").isNull()).select(*unmatched))
