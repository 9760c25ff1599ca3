"""Property tests against plain-Python models (few examples each: every example runs Spark jobs)."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from geomedallion.operators.dedup import dedup_by_key
from geomedallion.operators.merge import merge_upsert

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
T0 = dt.datetime(2024, 1, 1)
RUN = dt.datetime(2024, 6, 1)

keys = st.one_of(st.none(), st.integers(0, 12))
vals = st.text(alphabet="abc", min_size=0, max_size=2)


@SETTINGS
@given(
    target=st.dictionaries(st.integers(0, 12), vals, max_size=10),
    target_null=st.lists(vals, max_size=2),
    source=st.dictionaries(st.integers(0, 12), vals, max_size=10),
    source_null=st.lists(vals, max_size=2),
)
def test_merge_matches_model(spark, target, target_null, source, source_null):
    t_rows = [(k, v, T0) for k, v in target.items()] + [(None, v, T0) for v in target_null]
    s_rows = [(k, v) for k, v in source.items()] + [(None, v) for v in source_null]
    t = spark.createDataFrame(t_rows, "k int, v string, update_tm timestamp")
    s = spark.createDataFrame(s_rows, "k int, v string")
    got = sorted(map(tuple, merge_upsert(t, s, ["k"], RUN).collect()), key=repr)
    model = [(k, v, RUN) for k, v in s_rows] + [(k, v, ts) for k, v, ts in t_rows if k is None or k not in source]
    assert got == sorted(model, key=repr)


@SETTINGS
@given(rows=st.lists(st.tuples(keys, st.integers(0, 3), st.one_of(st.none(), st.integers(0, 5)), vals), max_size=25))
def test_dedup_matches_model(spark, rows):
    df = spark.createDataFrame(rows, "k int, ts int, a int, b string")
    got = sorted(map(tuple, dedup_by_key(df, ["k"], newest_first=["ts"]).collect()), key=repr)
    best = {}
    for r in rows:
        # newest ts first, then lowest a (nulls last), then lowest b
        rank = (-r[1], r[2] is None, r[2] if r[2] is not None else 0, r[3])
        if r[0] not in best or rank < best[r[0]][0]:
            best[r[0]] = (rank, r)
    assert got == sorted((v[1] for v in best.values()), key=repr)


def _miles(a, b, c, d):
    import math

    from geomedallion.functions.geo import EARTH_RADIUS_KM, KM_PER_MILE

    p1, p2 = math.radians(a), math.radians(c)
    h = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(math.radians(d - b) / 2) ** 2
    return 2 * EARTH_RADIUS_KM / KM_PER_MILE * math.asin(min(1.0, math.sqrt(h)))


coord = st.tuples(st.floats(31.0, 31.69, allow_nan=False), st.floats(-98.69, -98.0, allow_nan=False))


@SETTINGS
@given(obs=st.lists(coord, min_size=1, max_size=15), locs=st.lists(coord, min_size=0, max_size=40))
def test_nearest_matches_brute_force(spark, obs, locs):
    import math

    from geomedallion.operators.nearest import nearest_location

    o = spark.createDataFrame([(i, la, lo) for i, (la, lo) in enumerate(obs)], "obs_id long, lat double, lon double")
    l = spark.createDataFrame([(j, f"p{j}", la, lo) for j, (la, lo) in enumerate(locs)],
                              "loc_id long, loc_name string, geo_lat double, geo_lon double")
    kw = dict(id_col="obs_id", obs_lat="lat", obs_lon="lon", tie_breakers=["loc_id"])
    for plan in ({"cell_places": 0.3}, {"broadcast_max_rows": 0, "chunk_size": 3, "cell_places": 0.3}):
        got = {r.obs_id: (r.loc_id, r.dist_miles) for r in nearest_location(o, l, **kw, **plan).collect()}
        assert sorted(got) == list(range(len(obs)))
        for i, (la, lo) in enumerate(obs):
            same_bin = [(_miles(la, lo, a, b), j) for j, (a, b) in enumerate(locs)
                        if math.floor(a / 0.7) == math.floor(la / 0.7) and math.floor(b / 0.7) == math.floor(lo / 0.7)]
            if not same_bin:
                assert got[i] == (None, None)
                continue
            same_bin.sort()
            assert abs(got[i][1] - same_bin[0][0]) < 1e-3
            if len(same_bin) == 1 or same_bin[1][0] - same_bin[0][0] > 1e-3:
                assert got[i][0] == same_bin[0][1]
