import random


from geomedallion.functions.geo import rounded_miles
from geomedallion.operators.nearest import bin_join, nearest_location


def _frames(spark, n_obs=300, n_loc=200, seed=7):
    rnd = random.Random(seed)
    obs = [(i, round(rnd.uniform(30, 33), 2), round(rnd.uniform(-100, -97), 2)) for i in range(n_obs)]
    obs += [(n_obs, None, -98.0), (n_obs + 1, 31.0, None), (n_obs + 2, 60.0, 10.0)]  # no coords / far away
    locs = [(j, f"place{j}", round(rnd.uniform(30, 33), 2), round(rnd.uniform(-100, -97), 2)) for j in range(n_loc)]
    locs += [(n_loc, "dup-of-0", locs[0][2], locs[0][3])]  # an exact tie with place 0
    o = spark.createDataFrame(obs, "obs_id long, lat double, lon double")
    l = spark.createDataFrame(locs, "loc_id long, loc_name string, geo_lat double, geo_lon double")
    return o, l


def _brute(o, l):
    """Reference answer by brute force: every pair in the same bin, ordered by (dist, loc_id)."""
    c = bin_join(o, l, left_lat="lat", left_lon="lon", right_lat="geo_lat", right_lon="geo_lon")
    best = {}
    for r in c.collect():
        key = (r.dist_miles is None, r.dist_miles, r.loc_id)
        if r.obs_id not in best or key < best[r.obs_id][0]:
            best[r.obs_id] = (key, r.loc_id, r.dist_miles)
    return {k: (v[1], v[2]) for k, v in best.items()}


def _result(df):
    return {r.obs_id: (r.loc_id, r.dist_miles) for r in df.collect()}


def test_broadcast_plan_matches_brute_force(spark):
    o, l = _frames(spark)
    got = nearest_location(o, l, id_col="obs_id", obs_lat="lat", obs_lon="lon", tie_breakers=["loc_id"], ids_unique=True)
    assert got.count() == o.count()
    assert _result(got) == _brute(o, l)


def test_chunked_plan_matches_broadcast_plan(spark):
    o, l = _frames(spark)
    a = nearest_location(o, l, id_col="obs_id", obs_lat="lat", obs_lon="lon", tie_breakers=["loc_id"])
    b = nearest_location(o, l, id_col="obs_id", obs_lat="lat", obs_lon="lon", tie_breakers=["loc_id"],
                         broadcast_max_rows=0, chunk_size=3)
    assert a.columns == b.columns
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_unmatched_rows_survive_with_nulls(spark):
    o, l = _frames(spark)
    got = _result(nearest_location(o, l, id_col="obs_id", obs_lat="lat", obs_lon="lon", tie_breakers=["loc_id"]))
    for i in (300, 301, 302):
        assert got[i] == (None, None)


def test_tie_broken_by_tie_breakers(spark):
    o = spark.createDataFrame([(1, 31.0, -98.2)], "obs_id long, lat double, lon double")
    l = spark.createDataFrame([(5, "b", 31.1, -98.3), (3, "a", 31.1, -98.3)], "loc_id long, loc_name string, geo_lat double, geo_lon double")
    got = nearest_location(o, l, id_col="obs_id", obs_lat="lat", obs_lon="lon", tie_breakers=["loc_id"]).first()
    assert got.loc_id == 3


def test_one_row_per_duplicate_id(spark):
    o = spark.createDataFrame([(1, 31.0, -98.2), (1, 31.05, -98.25), (2, 31.0, -98.2)], "obs_id long, lat double, lon double")
    l = spark.createDataFrame([(7, "p", 31.06, -98.26)], "loc_id long, loc_name string, geo_lat double, geo_lon double")
    for kw in ({}, {"broadcast_max_rows": 0, "chunk_size": 1}):
        got = nearest_location(o, l, id_col="obs_id", obs_lat="lat", obs_lon="lon", tie_breakers=["loc_id"], **kw)
        rows = {r.obs_id: r for r in got.collect()}
        assert got.count() == 2
        assert rows[1].lat == 31.05  # the closer duplicate wins


def test_bin_edge_pairs_do_not_match(spark):
    o = spark.createDataFrame([(1, 0.69, 0.5)], "obs_id long, lat double, lon double")
    l = spark.createDataFrame([(1, "x", 0.71, 0.5)], "loc_id long, loc_name string, geo_lat double, geo_lon double")
    got = nearest_location(o, l, id_col="obs_id", obs_lat="lat", obs_lon="lon").first()
    assert got.loc_id is None and got.dist_miles is None


def test_rounded_distance(spark):
    df = spark.createDataFrame([(31.0, -98.0, 31.1, -98.1)], "a double, b double, c double, d double")
    d = df.select(rounded_miles("a", "b", "c", "d")).first()[0]
    assert d == round(d, 4) and 8 < d < 10


def test_broadcast_plan_has_no_shuffle_on_observations(spark):
    o, l = _frames(spark)
    got = nearest_location(o, l, id_col="obs_id", obs_lat="lat", obs_lon="lon", tie_breakers=["loc_id"], ids_unique=True)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    # every shuffle sits below the broadcast (packing the location side per bin); the
    # observation side is one narrow stage
    below_broadcast = plan[plan.index("BroadcastExchange"):]
    assert plan.count("Exchange hashpartitioning") == below_broadcast.count("Exchange hashpartitioning") >= 1


def test_bin_join_salted_fallback_equals_broadcast(spark):
    o, l = _frames(spark)
    kw = dict(left_lat="lat", left_lon="lon", right_lat="geo_lat", right_lon="geo_lon")
    a = bin_join(o, l, **kw)
    b = bin_join(o, l, broadcast_max_rows=0, **kw)
    assert sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.select(*a.columns).collect()), key=str)


def test_dense_bin_subcell_search_is_exact(spark):
    """Dense bins: the 3x3 sub-cell search (threshold 0 forces it everywhere) gives exactly the
    full-bin scan's answer, including observations whose block is empty or near bin edges."""
    rnd = random.Random(11)
    locs = []
    for j in range(3000):
        if j % 3 == 0:  # a tight cluster
            lat, lon = rnd.gauss(31.2, 0.05), rnd.gauss(-98.3, 0.05)
        else:  # spread over a few bins, with some points right at bin edges
            lat, lon = rnd.uniform(30.8, 32.3), rnd.uniform(-99.4, -97.6)
        locs.append((j, f"p{j}", round(lat, 4), round(lon, 4)))
    obs = [(i, round(rnd.uniform(30.8, 32.3), 4), round(rnd.uniform(-99.4, -97.6), 4)) for i in range(1500)]
    obs += [(2000 + i, 0.7 * k + 0.0001 * i, -98.0) for i, k in enumerate(range(44, 47))]  # on bin edges
    o = spark.createDataFrame(obs, "obs_id long, lat double, lon double")
    l = spark.createDataFrame(locs, "loc_id long, loc_name string, geo_lat double, geo_lon double")
    kw = dict(id_col="obs_id", obs_lat="lat", obs_lon="lon", tie_breakers=["loc_id"], ids_unique=True)
    fast = nearest_location(o, l, cell_places=0.3, **kw)
    full = nearest_location(o, l, cell_places=10**9, **kw)
    assert sorted(map(tuple, fast.collect())) == sorted(map(tuple, full.collect()))
    assert fast.where("loc_id IS NOT NULL").count() > 1400


def test_dense_bin_search_south_west_and_near_pole(spark):
    rnd = random.Random(5)
    centers = [(-45.3, 170.2), (-33.9, -70.6), (85.2, 10.3)]  # negative bins; a near-pole bin
    locs, obs = [], []
    for ci, (la, lo) in enumerate(centers):
        for j in range(400):
            locs.append((ci * 1000 + j, f"p{ci}-{j}", round(la + rnd.uniform(-0.3, 0.3), 4), round(lo + rnd.uniform(-0.3, 0.3), 4)))
        for i in range(300):
            obs.append((ci * 1000 + i, round(la + rnd.uniform(-0.3, 0.3), 4), round(lo + rnd.uniform(-0.3, 0.3), 4)))
    o = spark.createDataFrame(obs, "obs_id long, lat double, lon double")
    l = spark.createDataFrame(locs, "loc_id long, loc_name string, geo_lat double, geo_lon double")
    kw = dict(id_col="obs_id", obs_lat="lat", obs_lon="lon", tie_breakers=["loc_id"], ids_unique=True)
    fast = nearest_location(o, l, cell_places=0.3, **kw)
    full = nearest_location(o, l, cell_places=10**9, **kw)
    assert sorted(map(tuple, fast.collect())) == sorted(map(tuple, full.collect()))


def test_both_plans_agree_on_full_ties(spark):
    locs = spark.createDataFrame([(34.0, -118.0, "a", i % 7, f"place {i % 5}") for i in range(40)], "geo_lat double, geo_lon double, name_key string, pop int, area string")
    obs = spark.createDataFrame([(1, 34.1, -118.1, "x"), (1, 34.1, -118.1, "w"), (2, 34.2, -118.2, None), (None, 34.1, -118.1, "y"), (None, None, None, "z")], "id int, lat double, lon double, note string")
    run = lambda **kw: sorted(map(str, nearest_location(obs, locs, id_col="id", obs_lat="lat", obs_lon="lon", tie_breakers=("geo_lat", "geo_lon", "name_key"), **kw).collect()))
    whole = run()
    assert len(whole) == 3 and run(broadcast_max_rows=0, chunk_size=3) == whole == run(broadcast_max_rows=0, chunk_size=7)


def test_full_bins_in_either_plan(spark):
    from pyspark.sql import functions as F

    obs = spark.range(2000).select(F.col("id").alias("obs_id"), (30.8 + F.rand(3) * 0.7).alias("lat"), (-98.7 + F.rand(4) * 0.7).alias("lon"))
    locs = spark.range(16000).select(F.col("id").alias("loc_id"), (30.8 + F.rand(1) * 0.7).alias("geo_lat"), (-98.7 + F.rand(2) * 0.7).alias("geo_lon"))
    kw = dict(id_col="obs_id", obs_lat="lat", obs_lon="lon", tie_breakers=["loc_id"], ids_unique=True)
    full = sorted(map(str, nearest_location(obs, locs, cell_places=10**9, **kw).collect()))
    assert sorted(map(str, nearest_location(obs, locs, **kw).collect())) == full
    assert sorted(map(str, nearest_location(obs, locs, broadcast_max_rows=0, **kw).collect())) == full


def test_longest_list_stays_short_as_a_bin_fills(spark):
    from pyspark.sql import functions as F

    from geomedallion.operators.nearest import candidate_lists

    longest = {}
    for n in (4000, 32000):
        locs = spark.range(n).select(F.col("id").alias("loc_id"), (30.8 + F.rand(1) * 0.7).alias("geo_lat"), (-98.7 + F.rand(2) * 0.7).alias("geo_lon"))
        lists = candidate_lists(locs, "geo_lat", "geo_lon", ["loc_id"]).lists
        longest[n] = lists.agg(F.max(F.size("__near")), F.avg(F.size("__near"))).first()
    assert longest[32000][0] < 100 and abs(longest[32000][1] - longest[4000][1]) < 5


def test_places_at_one_point_are_one_place(spark):
    from pyspark.sql import functions as F

    locs = spark.range(5000).select(F.col("id").alias("loc_id"), F.concat(F.lit("p"), F.col("id")).alias("loc_name"), F.lit(31.0).alias("geo_lat"), F.lit(-98.2).alias("geo_lon"))
    obs = spark.createDataFrame([(1, 31.1, -98.3)], "obs_id long, lat double, lon double")
    for kw in ({}, {"broadcast_max_rows": 0}):
        got = nearest_location(obs, locs, id_col="obs_id", obs_lat="lat", obs_lon="lon", tie_breakers=["loc_name"], **kw).collect()
        assert [(r.loc_id, r.loc_name) for r in got] == [(0, "p0")]


def test_wide_places_take_the_shuffle_plan_by_their_bytes(spark):
    from pyspark.sql import functions as F

    from geomedallion.operators.sizing import Size

    o, l = _frames(spark)
    kw = dict(id_col="obs_id", obs_lat="lat", obs_lon="lon", tie_breakers=["loc_id"])
    wide = l.withColumn("loc_text", F.repeat(F.lit("w"), 200))
    small = nearest_location(o, wide, **kw)
    large = nearest_location(o, wide, locs_size=Size(l.count(), 1 << 40), **kw)
    assert sorted(map(str, small.collect())) == sorted(map(str, large.collect()))


def test_observations_without_places_enter_no_exchange(spark):
    from pyspark.sql import functions as F
    from test_joins import _shuffled_rows

    o = spark.range(3000).select(F.col("id").alias("obs_id"), F.when(F.col("id") < 1000, 31.0 + F.col("id") / 2000).when(F.col("id") < 2000, 60.0).alias("lat"), F.lit(-98.2).alias("lon"))
    _, l = _frames(spark)
    got = nearest_location(o, l, id_col="obs_id", obs_lat="lat", obs_lon="lon", tie_breakers=["loc_id"], ids_unique=True, broadcast_max_rows=0)
    assert got.count() == 3000 and got.where("loc_id is not null").count() >= 700
    got.collect()
    assert max(_shuffled_rows(got._jdf.queryExecution().executedPlan())) < 3000


def test_places_far_from_the_nearest_are_not_measured(spark):
    from pyspark.sql import functions as F

    from geomedallion.operators.nearest import _COSINE_MARGIN

    o = spark.createDataFrame([(1, 31.1, -98.3)], "obs_id long, lat double, lon double")
    l = spark.range(30).select(F.col("id").alias("loc_id"), (31.0 + F.col("id") / 100).alias("geo_lat"), F.lit(-98.2).alias("geo_lon"))
    got = nearest_location(o, l, id_col="obs_id", obs_lat="lat", obs_lon="lon", tie_breakers=["loc_id"], ids_unique=True)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "array_max(transform" not in plan  # the bound is not worked out again for every place
    assert plan.count("filter(__near") == 1 and plan.count("filter(__all") == 1
    assert [r.loc_id for r in got.collect()] == [10]
    assert 4 * 10 ** -4 / (2 * 3958.76) < _COSINE_MARGIN < 2e-7


def test_ties_and_odd_coordinates_are_ranked_as_before(spark):
    import math
    from pyspark.sql import functions as F

    nan = float("nan")
    # equal when rounded, though not equal: the tie breaker decides; a coordinate that is no number is at the far end
    obs = [(1, 0.1, 0.1), (2, nan, 0.1), (3, 0.1, nan), (5, 0.3, 0.3), (6, None, 0.1), (7, 95.0, 10.0), (8, 0.0, nan)]
    locs = [(9, 0.2, 0.1), (3, 0.2 + 1e-9, 0.1), (5, 0.1, 0.2), (1, nan, 0.1), (2, 0.1, nan), (0, nan, nan), (7, 0.5, 0.5), (11, 95.1, 10.1), (12, 95.0, 10.3)]
    o = spark.createDataFrame(obs, "obs_id long, lat double, lon double")
    l = spark.createDataFrame(locs, "loc_id long, geo_lat double, geo_lon double")
    pairs = bin_join(o, l, left_lat="lat", left_lon="lon", right_lat="geo_lat", right_lon="geo_lon").where("loc_id is not null")
    miles = F.when(F.isnan("dist_miles"), F.lit(12436.0)).otherwise(F.col("dist_miles"))
    want = {}
    for r in pairs.withColumn("m", miles).collect():
        want[r.obs_id] = min(want.get(r.obs_id, (math.inf, 0)), (r.m, r.loc_id))
    kw = dict(id_col="obs_id", obs_lat="lat", obs_lon="lon", tie_breakers=["loc_id"], ids_unique=True)
    for more in ({}, {"broadcast_max_rows": 0}, {"cell_places": 0.3}):
        got = {r.obs_id: r.loc_id for r in nearest_location(o, l, **kw, **more).collect() if r.loc_id is not None}
        assert got == {k: v[1] for k, v in want.items()}, more
    assert want[1][1] == 3
