"""Bronze / silver / gold layers.

The per-entity transforms are pure DataFrame -> DataFrame functions (usable and testable on
their own); ``Medallion`` runs them against catalog tables:

  bronze(landed_dir, run_ts)  landed payloads (or landed CSV on replay) -> staging -> merge into *_raw
  silver(run_ts)              *_raw newer than the run-log watermark -> cleaned -> merge into *_silver
  gold(snapshot)              *_silver -> location_dimension, attribute_table, dim_date
  record_run(...)             run log append, after gold (ruling D16)
"""

from __future__ import annotations

import datetime as _dt
import threading
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import partial

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geomedallion import schemas as SC
from geomedallion.functions import columns as C
from geomedallion.operators import quality as QC
from geomedallion.operators.calendar import date_dimension
from geomedallion.operators.dedup import dedup_by_key
from geomedallion.operators.extract import RUN_LOG_SCHEMA, extract_since, watermark
from geomedallion.operators.location import location_dimension, location_fact
from geomedallion.operators.merge import merge_upsert
from geomedallion.operators.nearest import nearest_location
from geomedallion.plans import intake as IN
from geomedallion.operators.sizing import Size, measure
from geomedallion.session import ensure_checkpoint_dir
from geomedallion.sinks import tables as K
from geomedallion.sources.csv import bind_by_name, read_csv

ENTITIES = ("usgs", "census", "geocode", "weather")
MIN_MAGNITUDE = 2.0
FEED_FOLDERS = {"usgs": "events", "census": "census", "geocode": "geocode", "weather": "weather"}
LOCATION_TIES = ("geo_lat", "geo_lon", "name_key")


# --- bronze: staging rows of each entity ---------------------------------------------------

NEWEST_FIRST = {"usgs": ("updated",)}


def valid_rows(rows: DataFrame, entity: str) -> DataFrame:
    """The valid rows of an intake in staging columns, one per key."""
    valid = rows.where(F.col("outcome") == IN.VALID).select(*SC.STAGING[entity].fieldNames())
    return dedup_by_key(valid, SC.RAW_KEYS[entity], newest_first=NEWEST_FIRST.get(entity, ()))


def landed_rows(rows: DataFrame, entity: str, *outcomes: str) -> DataFrame:
    """Rows of an intake with these outcomes in staging columns; geocode records are whole-record distinct (A4)."""
    found = rows.where(F.col("outcome").isin(*outcomes)).select(*SC.STAGING[entity].fieldNames())
    return found.distinct() if entity == "geocode" else found


def stage_rows(rows: DataFrame, entity: str, **rules) -> tuple[DataFrame, DataFrame]:
    """Parsed rows of a feed -> (valid staging rows, rejected); ``rules`` as in :func:`intake.row_outcome`."""
    tagged = IN.tag_rows(rows, entity, **rules)
    return valid_rows(tagged, entity), landed_rows(tagged, entity, IN.REJECTED)


def stage_usgs(events: DataFrame, window_start=None, window_end=None, min_mag: float | None = None):
    """Flattened events -> (valid staging rows, rejected). P10 keeps the feed's window and magnitude,
    each where it is given."""
    return stage_rows(events, "usgs", window=None if window_start is None else (window_start, window_end), min_mag=min_mag)


# --- silver: cleaning of each entity ------------------------------------------------------

def silver_usgs(raw: DataFrame) -> DataFrame:
    """P7 on time/updated, F9 on coordinates (before dedup, D21), A3 on (place, time)."""
    ts_type = raw.schema["time"].dataType
    df = raw.withColumns({
        "time": C.fill_epoch("time", ts_type),
        "updated": C.fill_epoch("updated", ts_type),
        "latitude": C.round_coord("latitude"),
        "longitude": C.round_coord("longitude"),
    })
    return dedup_by_key(df, SC.SILVER_KEYS["usgs"], newest_first=["update_tm"])


def silver_weather(raw: DataFrame) -> DataFrame:
    """P7 on date, F9, P4 (Kelvin present and >= 0), F10, A3 on (lat, lon, date)."""
    df = raw.withColumns({
        "date": C.fill_epoch("date", raw.schema["date"].dataType),
        "lat": C.round_coord("lat"),
        "lon": C.round_coord("lon"),
    })
    df = df.where(C.valid_range("temperature_min") & C.valid_range("temperature_max"))
    df = df.withColumns({
        "temperature_min": C.kelvin_to_celsius("temperature_min"),
        "temperature_max": C.kelvin_to_celsius("temperature_max"),
    })
    return dedup_by_key(df, SC.SILVER_KEYS["weather"], newest_first=["update_tm"])


def silver_geocode(raw: DataFrame) -> DataFrame:
    """F9, F1 name_key, A3 on (name_key, lat, lon)."""
    df = raw.withColumns({"lat": C.round_coord("lat"), "lon": C.round_coord("lon"), "name_key": C.name_key("name")})
    df = dedup_by_key(df, SC.SILVER_KEYS["geocode"], newest_first=["update_tm"])
    return bind_by_name(df, SC.SILVER["geocode"])


def silver_census(raw: DataFrame) -> DataFrame:
    """F3 split, F2 county, F1 key (ruling D24), P3 drop hisp/state/county, A3 on name."""
    area, state = C.split_area_state("name")
    df = raw.withColumns({"state_name": state, "name_key": C.name_key(C.county_name(area))})
    df = df.drop("hisp", "state", "county")
    df = dedup_by_key(df, SC.SILVER_KEYS["census"], newest_first=["update_tm"])
    return bind_by_name(df, SC.SILVER["census"])


SILVER_TRANSFORMS = {"usgs": silver_usgs, "census": silver_census, "geocode": silver_geocode, "weather": silver_weather}


# --- gold -----------------------------------------------------------------------------------

# id column, its parts, latitude and longitude of the entities that are matched to places
LOCATED = {"weather": ("weather_id", ["date", "lat", "lon"], "lat", "lon"), "usgs": ("usgs_id", ["time", "latitude", "longitude"], "latitude", "longitude")}


def locate(silver: DataFrame, entity: str, places: DataFrame, places_size: Size | None = None, ids_unique: bool = False) -> DataFrame:
    """Silver rows with their row id (F6/F7) and nearest place."""
    id_col, parts, lat, lon = LOCATED[entity]
    rows = silver.withColumn(id_col, C.row_hash_id(silver, parts))
    return nearest_location(
        rows, places, id_col=id_col, obs_lat=lat, obs_lon=lon, tie_breakers=LOCATION_TIES, ids_unique=ids_unique, locs_size=places_size
    )


def gold_tables(
    weather: DataFrame,
    usgs: DataFrame,
    geocode: DataFrame,
    census: DataFrame,
    *,
    locations: DataFrame | None = None,
    weather_ids_unique: bool = True,
) -> dict[str, DataFrame]:
    """location_dimension, attribute_table (fact) and dim_date from silver frames.

    ``locations`` may be a materialised location dimension (read back from its table); else the
    dimension is computed and checkpointed (shared checkpoint folder) so its three uses and its
    size check read it once. ``weather_ids_unique`` holds for silver input: the weather id
    hashes exactly the silver key (date, lat, lon).
    """
    if locations is None:
        loc = location_dimension(geocode, census, keys=["name_key", "state"])
        ensure_checkpoint_dir(loc.sparkSession)
        loc = loc.checkpoint(eager=True)
    else:
        loc = locations
    # the dimension's size, measured once, decides on both matches; its rows bound the fact's join keys
    size = measure(loc)
    weather_loc = locate(weather, "weather", loc, size, ids_unique=weather_ids_unique)
    usgs_loc = locate(usgs, "usgs", loc, size)
    fact = location_fact(weather_loc, usgs_loc, location_rows_bound=size.rows)
    return {"location_dimension": loc, "attribute_table": fact, "dim_date": date_dimension(fact, "date")}


# --- orchestration over catalog tables -------------------------------------------------------

def _read_or_empty(spark: SparkSession, read, schema: T.StructType) -> DataFrame:
    """A feed that landed nothing this run (its folder is absent) is an empty frame, not an error."""
    try:
        return read()
    except AnalysisException as ex:
        if "PATH_NOT_FOUND" not in str(ex) and "Path does not exist" not in str(ex):
            raise
        return spark.createDataFrame([], schema)


def _side_by_side(*flows: Callable[[], object]) -> list:
    """Run independent flows concurrently (Spark runs jobs from several driver threads side by side);
    the first failure is raised after all flows finish."""
    with ThreadPoolExecutor(max_workers=len(flows)) as pool:
        futures = [pool.submit(f) for f in flows]
    return [f.result() for f in futures]


@dataclass
class Taken:
    """The written intake of one feed."""

    entity: str
    rows: DataFrame
    counts: dict[str, int]  # rows by outcome
    shaped: bool  # some of them tell the broken rules of the feed's shape
    folder: str


@dataclass
class Medallion:
    spark: SparkSession
    database: str
    root: str
    rejected: dict = field(default_factory=dict)
    _merge_of: dict = field(default_factory=dict, repr=False)  # run time -> merge time of its rows
    # Merge times are handed out under this lock, which a merge holds until its tables are swapped: whoever
    # takes a later time sees all that was merged under earlier ones. One process merges into a database at a time.
    _commit: threading.RLock = field(default_factory=threading.RLock, repr=False)
    _newest: int | None = field(default=None, repr=False)  # the newest merge time handed out, in microseconds
    # appends to the shared touched_days table are serialised: concurrent file commits into one
    # table folder would share (and clean up) the same temporary directory
    _record_lock: threading.Lock = field(default_factory=threading.Lock, repr=False)

    def t(self, name: str) -> str:
        return f"{self.database}.{name}"

    def create(self) -> None:
        """K7: staging, raw, silver and run-log tables; time-series raw/silver tables are
        partitioned by ``day`` (catalog-managed partitions)."""
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database} LOCATION '{self.root.rstrip('/')}/_database'")
        K.create_table(self.spark, self.t("run_log"), RUN_LOG_SCHEMA, self.root)
        K.create_table(self.spark, self.t("touched_days"), SC.TOUCHED_DAYS, self.root)
        K.create_table(self.spark, self.t("rejected_payloads"), SC.REJECTED_PAYLOADS, self.root)
        K.create_table(self.spark, self.t("feed_report"), SC.FEED_REPORT, self.root)
        K.create_table(self.spark, self.t("feed_outcomes"), SC.FEED_OUTCOMES, self.root)
        K.create_table(self.spark, self.t("gold_marks"), SC.GOLD_MARKS, self.root)
        K.create_table(self.spark, self.t("gold_places"), SC.GOLD_PLACES, self.root)
        for e in ENTITIES:
            rejected = T.StructType(SC.STAGING[e].fields + [T.StructField("rejected_tm", T.TimestampType())])
            K.create_table(self.spark, self.t(f"{e}_rejected"), rejected, self.root)
            K.create_table(self.spark, self.t(f"{e}_insert"), SC.STAGING[e], self.root)
            K.create_table(self.spark, self.t(f"{e}_silver_insert"), SC.SILVER[e], self.root)
            for layer, schema in (("raw", SC.RAW[e]), ("silver", SC.SILVER[e])):
                if e in SC.PARTITION_SOURCE:
                    schema = T.StructType(schema.fields + [T.StructField(SC.PARTITION_COL, T.DateType())])
                    K.create_table(self.spark, self.t(f"{e}_{layer}"), schema, self.root, partition_by=SC.PARTITION_COL)
                else:
                    K.create_table(self.spark, self.t(f"{e}_{layer}"), schema, self.root)

    def merge_time(self, run_ts: _dt.datetime) -> _dt.datetime:
        """The time that stamps the rows of a run (``update_tm``) and its log entry.

        It is ``run_ts`` (ruling D26), unless a merge with that time or a later one is already on record:
        a rerun, a replay or a backfill is stamped just after the newest, so that the incremental pull
        sees its rows. Merge times thus only grow, whatever the order of the runs' own times.
        """
        log = self.spark.table(self.t("run_log")).where(F.col("status") == "Succeeded").agg(F.max(F.unix_micros("last_updated")))
        days = self.spark.table(self.t("touched_days")).agg(F.max(F.unix_micros("run_ts")))
        with self._commit:
            known = [r[0] for r in (log.first(), days.first())] + [self._newest]
            newest = max((m for m in known if m is not None), default=None)
            micros = C.epoch_micros(run_ts)
            self._newest = micros if newest is None or micros > newest else newest + 1
        return _dt.datetime(1970, 1, 1, tzinfo=_dt.timezone.utc) + _dt.timedelta(microseconds=self._newest)

    def merge_into(self, entity: str, table: str, staging: str | DataFrame, keys, run_ts: _dt.datetime, snapshot: str) -> None:
        """Keyed upsert of a staging table (or written rows) into a layer table; ``run_ts`` stamps its rows.

        Partitioned entities: the days of the staging rows go on record, and a semi join with them prunes the target
        to their partitions, which are merged and written as a new snapshot. Other tables: whole-table snapshot swap.
        """
        src = self.spark.table(staging) if isinstance(staging, str) else staging
        stamp = C.ts_literal(run_ts)
        if entity not in SC.PARTITION_SOURCE:
            K.replace_table(merge_upsert(self.spark.table(table), src, keys, stamp), table, self.root, snapshot)
            return
        if src.isEmpty():
            return
        day, of = SC.PARTITION_COL, SC.PARTITION_SOURCE[entity]
        src = src.withColumn(day, F.to_date(F.col(of)))
        # the days are on record before they change: a crash in between costs a look at unchanged
        # days, never the loss of changed ones
        no_day = F.raise_error(F.lit(f"{entity}: staging rows without a {of} value")).cast("date")
        merge_id = uuid.uuid4().hex
        days = src.select(day).distinct().select(F.coalesce(day, no_day).alias(day))
        record = days.select(F.lit(table).alias("table_name"), day, stamp.alias("run_ts"), F.lit(merge_id).alias("merge_id"))
        with self._record_lock:
            record.coalesce(1).write.insertInto(self.t("touched_days"))
        touched = self.spark.table(self.t("touched_days")).where(F.col("merge_id") == merge_id)
        target = self.spark.table(table)
        target = target.join(touched.select(day), day, "left_semi").select(*target.columns)
        K.replace_partitions(merge_upsert(target, src, keys, stamp), table, self.root, snapshot, day)

    def changed_rows(self, name: str, run_log: DataFrame) -> DataFrame:
        """Rows of a layer table that can be newer than the watermark: for a day-partitioned table
        only the days merged since the watermark (a semi join on the partition column, which Spark
        turns into dynamic partition pruning); other tables whole."""
        df = self.spark.table(self.t(name))
        if SC.PARTITION_COL not in df.columns:
            return df
        wm = watermark(run_log, SC.TOUCHED_DAYS["run_ts"].dataType).select("watermark").scalar()
        touched = self.spark.table(self.t("touched_days"))
        days = touched.where((F.col("table_name") == self.t(name)) & (F.col("run_ts") > wm)).select(SC.PARTITION_COL)
        return df.join(days.distinct(), SC.PARTITION_COL, "left_semi").drop(SC.PARTITION_COL)

    def read(self, name: str) -> DataFrame:
        """A layer table without its storage-only partition column."""
        df = self.spark.table(self.t(name))
        return df.drop(SC.PARTITION_COL) if SC.PARTITION_COL in df.columns else df

    # X1
    def intakes(self, landed_dir: str, source: str = "landed", run_ts: _dt.datetime | None = None, rules: dict | None = None) -> dict[str, DataFrame]:
        """Landed payloads per entity as rows with their outcome; ``source='csv'`` replays landed CSV (S8, ruling D5)."""
        s, d, rules = self.spark, landed_dir.rstrip("/"), rules or {}
        if source == "csv":
            # a replay names the run it repeats: a folder that is not there is an error
            rows = {e: read_csv(s, K.landed_csv_path(d + "/csv", e, run_ts), SC.STAGING[e], multi_line=True) for e in ENTITIES}
            return {e: IN.tag_rows(r, e, **rules.get(e, {})) for e, r in rows.items()}
        return {
            e: _read_or_empty(s, lambda: IN.intake(s.read.text(f"{d}/{FEED_FOLDERS[e]}"), e, **rules.get(e, {})), IN.intake_schema(e))
            for e in ENTITIES
        }

    def take_in(self, entity: str, rows: DataFrame) -> Taken:
        """Write the intake of a feed once; all its sinks read the written rows."""
        folder = f"{self.root.rstrip('/')}/_intake/{entity}-{uuid.uuid4().hex}"
        rows.write.parquet(folder)
        written = self.spark.read.schema(IN.intake_schema(entity)).parquet(folder)
        by_outcome = written.groupBy("outcome").agg(F.count("*").alias("n"), F.count("broken").alias("shaped")).collect()  # a few rows
        return Taken(entity, written, {r["outcome"]: r["n"] for r in by_outcome}, any(r["shaped"] for r in by_outcome), folder)

    def release(self, *taken: Taken) -> None:
        for t in taken:
            K.remove_folder(self.spark, t.folder)

    def report(self, merge_ts: _dt.datetime, *taken: Taken) -> None:
        """Rows by outcome go to ``feed_outcomes``, bad payloads to ``rejected_payloads``, the event feed's shape
        report (A9) to ``feed_report``; rejected rows to the entity's own table. What has no rows is not written."""
        spark, stamp = self.spark, C.ts_literal(merge_ts)
        counts = [(t.entity, o, t.counts.get(o, 0), C.as_utc(merge_ts)) for t in taken for o in IN.OUTCOMES if t.counts]
        with self._record_lock:
            if counts:
                K.append_staging(spark.createDataFrame(counts, SC.FEED_OUTCOMES).coalesce(1), self.t("feed_outcomes"))
            for t in taken:
                if t.counts.get(IN.BAD_PAYLOAD):
                    bad = t.rows.where(F.col("outcome") == IN.BAD_PAYLOAD)
                    K.append_staging(bad.select(F.lit(t.entity).alias("entity"), "payload", stamp.alias("rejected_tm")), self.t("rejected_payloads"))
                if t.shaped:
                    K.append_staging(IN.shape_report(t.rows).withColumn("reported_tm", stamp), self.t("feed_report"))
        for t in taken:
            kept = self.t(f"{t.entity}_rejected")
            if t.counts.get(IN.REJECTED):
                K.append_staging(landed_rows(t.rows, t.entity, IN.REJECTED).withColumn("rejected_tm", stamp), kept)
            self.rejected[f"bronze_{t.entity}"] = spark.table(kept).where(F.col("rejected_tm") == stamp)

    def bronze(self, landed_dir: str, run_ts: _dt.datetime, source: str = "landed", land_csv: bool = True, rules: dict | None = None) -> None:
        """``rules`` by feed as in :func:`intake.row_outcome`; {} takes in every landed row of a backfill."""
        if rules is None:  # P10 / F14: the feed window is the day before the run (midnight to midnight)
            end = C.as_utc(run_ts).astimezone(_dt.timezone.utc).replace(hour=0, minute=0, second=0, microsecond=0)
            rules = {"usgs": {"window": (end - _dt.timedelta(days=1), end), "min_mag": MIN_MAGNITUDE}}
        frames = self.intakes(landed_dir, source, run_ts, rules)
        taken = _side_by_side(*(partial(self.take_in, e, frames[e]) for e in ENTITIES))
        snap = run_ts.strftime("%Y%m%dT%H%M%S")

        def land(t: Taken) -> None:  # the whole feed, before anything is dropped from it
            K.write_landed_csv(landed_rows(t.rows, t.entity, *IN.ROW_OUTCOMES), f"{landed_dir.rstrip('/')}/csv", t.entity, run_ts)

        def load(t: Taken, merge_ts: _dt.datetime) -> None:
            staging = self.t(f"{t.entity}_insert")
            K.load_staging(valid_rows(t.rows, t.entity), staging)  # truncate + load (K5, K4)
            self.merge_into(t.entity, self.t(f"{t.entity}_raw"), staging, SC.RAW_KEYS[t.entity], merge_ts, f"bronze-{snap}")

        csv = [partial(land, t) for t in taken] if land_csv and source == "landed" else []
        try:
            with self._commit:
                merge_ts = self._merge_of[run_ts] = self.merge_time(run_ts)
                _side_by_side(*(partial(load, t, merge_ts) for t in taken), *csv, partial(self.report, merge_ts, *taken))
        finally:
            self.release(*taken)

    def merge_batch(self, entity: str, rows: DataFrame, label: str) -> None:
        """One more lot of a feed (a stream's micro-batch) into its bronze table, beside the runs: its rows are staged
        in a folder of its own, its merge time is taken when they are known, and held until they are in the table."""
        taken = self.take_in(entity, rows)
        staged = f"{taken.folder}-staged"
        try:
            valid_rows(taken.rows, entity).write.parquet(staged)
            with self._commit:
                merge_ts = self.merge_time(_dt.datetime.now(_dt.timezone.utc))
                self.report(merge_ts, taken)
                source = self.spark.read.schema(SC.STAGING[entity]).parquet(staged)
                self.merge_into(entity, self.t(f"{entity}_raw"), source, SC.RAW_KEYS[entity], merge_ts, label)
        finally:
            self.release(taken)
            K.remove_folder(self.spark, staged)

    # X2
    def silver(self, run_ts: _dt.datetime) -> None:
        snap = run_ts.strftime("%Y%m%dT%H%M%S")
        run_log = self.spark.table(self.t("run_log"))
        with self._commit:  # whatever was given an earlier merge time is in the tables
            merge_ts = self._merge_of.setdefault(run_ts, None) or self.merge_time(run_ts)
            self._merge_of[run_ts] = merge_ts

        def clean(e: str) -> None:
            fresh = extract_since(self.changed_rows(f"{e}_raw", run_log), run_log, "update_tm")
            K.load_staging(SILVER_TRANSFORMS[e](fresh), self.t(f"{e}_silver_insert"))
            self.merge_into(e, self.t(f"{e}_silver"), self.t(f"{e}_silver_insert"), SC.SILVER_KEYS[e], merge_ts,
                            f"silver-{snap}")

        _side_by_side(*(partial(clean, e) for e in ENTITIES))

    # X3
    def _days(self, df: DataFrame, days: DataFrame | None, how: str = "left_semi") -> DataFrame:
        """Rows of a day-partitioned table in ``days`` (None: all of them); Spark prunes its partitions by the join."""
        day = SC.PARTITION_COL
        return df if days is None else df.join(days.select(day).distinct(), day, how).select(*df.columns)

    def _put_days(self, df: DataFrame, name: str, snapshot: str) -> None:
        """Replace the day partitions of a gold table that ``df`` holds; the table is made on first use."""
        fields = [f for f in df.schema.fields if f.name != SC.PARTITION_COL] + [T.StructField(SC.PARTITION_COL, T.DateType())]
        K.create_table(self.spark, self.t(name), T.StructType(fields), self.root, partition_by=SC.PARTITION_COL)
        K.replace_partitions(df.select(*[f.name for f in fields]), self.t(name), self.root, snapshot, SC.PARTITION_COL)

    def gold(self, snapshot: str, rebuild: bool = False) -> str:
        """Location dimension, fact and calendar from the silver tables; returns ``full`` or ``delta``.

        The fact pairs every weather day with every quake of its place. After the first run only what changed is
        paired again: the weather days merged into silver since the last gold run with all quakes, and the
        other days at the places of quakes that changed (before or after). A changed location dimension can move
        any match, so all is rebuilt then, as with ``rebuild``. Places whose quakes change are on record before
        those are replaced; a new dimension and the run's mark are set last: a run cut short is made up for by the next.
        """
        tb, day, place = self.spark.table, SC.PARTITION_COL, ["geo_lat", "geo_lon"]
        touched = tb(self.t("touched_days")).where(F.col("table_name").isin(*[self.t(f"{e}_silver") for e in LOCATED]))
        with self._commit:
            mark = touched.agg(F.max(F.unix_micros("run_ts"))).first()[0]
        last = tb(self.t("gold_marks")).agg(F.max("mark")).first()[0]
        loc = location_dimension(self.read("geocode_silver"), self.read("census_silver"), keys=["name_key", "state"])
        known = self.spark.catalog.tableExists(self.t("location_dimension"))
        same = known and loc.exceptAll(tb(self.t("location_dimension"))).isEmpty() and tb(self.t("location_dimension")).exceptAll(loc).isEmpty()
        if not same:  # the small dimension is written once; it feeds both matches and the fact, and is published after it
            K.publish(loc, self.t("location_dimension_next"), self.root, snapshot)
        loc = tb(self.t("location_dimension" if same else "location_dimension_next"))
        size = measure(loc)
        full = rebuild or not same or last is None
        if not full and mark is not None and mark <= last:
            return "delta"  # nothing changed

        def changed(entity: str) -> DataFrame | None:
            since = (F.col("table_name") == self.t(f"{entity}_silver")) & (F.unix_micros("run_ts") > F.lit(last))
            return None if full else touched.where(since).select(day)

        def locate_days(entity: str) -> None:
            rows = self._days(tb(self.t(f"{entity}_silver")), changed(entity))
            self._put_days(locate(rows, entity, loc, size, ids_unique=entity == "weather"), f"{entity}_located", snapshot)

        def record_places() -> None:
            if not full:
                at = self._days(tb(self.t("usgs_located")), changed("usgs")).where(F.col("geo_lat").isNotNull()).select(*place).distinct()
                K.append_staging(at.withColumn("mark", F.lit(mark)), self.t("gold_places"))

        def locate_quakes() -> None:
            record_places()  # as they were, and as they are
            locate_days("usgs")
            record_places()

        _side_by_side(partial(locate_days, "weather"), locate_quakes)
        weather, quakes = tb(self.t("weather_located")), tb(self.t("usgs_located")).drop(day)
        days, kept = changed("weather"), None
        if not full:
            places = tb(self.t("gold_places")).where(F.col("mark") > F.lit(last)).select(*place).distinct()
            others = self._days(weather, days, "left_anti").join(places, place, "left_semi").select(*weather.columns)
            moved = others.select(day).distinct()
            fact = tb(self.t("attribute_table"))
            kept = self._days(fact, moved).join(places, place, "left_anti").select(*fact.columns)
            weather = self._days(weather, days).unionByName(others)
        paired = location_fact(weather.withColumn("__day", F.col(day)).drop(day), quakes, location_rows_bound=size.rows, checkpoint_quakes=False, checkpoint_weather=False)
        paired = paired.withColumnRenamed("__day", day)
        self._put_days(paired if kept is None else paired.unionByName(kept), "attribute_table", snapshot)
        # the calendar reads the written fact instead of recomputing it
        K.publish(date_dimension(self.read("attribute_table"), "date"), self.t("dim_date"), self.root, snapshot)
        if not same:
            K.publish(loc, self.t("location_dimension"), self.root, snapshot)
        if mark is not None:
            K.append_staging(self.spark.createDataFrame([(mark,)], "mark long"), self.t("gold_marks"))
        return "full" if full else "delta"

    # X4
    def record_run(self, job_id: str, run_ts: _dt.datetime, status: str = "Succeeded") -> None:
        if status not in QC.RUN_STATUSES:
            raise ValueError(f"status must be one of {QC.RUN_STATUSES}")
        row = self.spark.createDataFrame([(job_id, C.as_utc(self._merge_of.pop(run_ts, run_ts)), status)], RUN_LOG_SCHEMA)
        row.write.insertInto(self.t("run_log"))

    def remove_stale(self, before: _dt.datetime) -> dict[str, list[str]]:
        """K6 retention over all tables of the database: superseded snapshots last changed before ``before``."""
        names = [t.name for t in self.spark.catalog.listTables(self.database) if not t.isTemporary]
        found = {n: K.remove_stale(self.spark, self.t(n), self.root, before) for n in names}
        return {n: stale for n, stale in found.items() if stale}

    def run(self, landed_dir: str, run_ts: _dt.datetime, job_id: str | None = None, source: str = "landed") -> None:
        """One full run: bronze, silver, gold, then the run-log entry that moves the watermark."""
        self.bronze(landed_dir, run_ts, source)
        self.silver(run_ts)
        self.gold(run_ts.strftime("%Y%m%dT%H%M%S"))
        self.record_run(job_id or run_ts.strftime("%Y%m%dT%H%M%S"), run_ts)
