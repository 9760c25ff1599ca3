"""Bronze -> silver -> gold over hand-written landed payloads; rerun and replay."""

import datetime as dt

import payloads as P
import pytest

from geomedallion.operators.extract import watermark
from geomedallion.plans.layers import Medallion

RUN = dt.datetime(2024, 3, 2, 6, 0, 0)


def _snapshot(spark, m, names):
    return {n: sorted(map(lambda r: tuple(str(v) for v in r), spark.table(m.t(n)).drop("update_tm").collect())) for n in names}


@pytest.fixture(scope="module")
def medallion(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("layers")
    landed = P.write(str(root / "landed"))
    m = Medallion(spark, "gm_test_layers", str(root / "warehouse"))
    m.create()
    m.run(landed, RUN, job_id="run-1")
    return m, landed


def test_bronze_tables(spark, medallion):
    m, _ = medallion
    usgs = spark.table(m.t("usgs_raw"))
    assert sorted(r.mag for r in usgs.collect()) == [2.2, 2.5, 2.6, 3.1]  # window, magnitude, null keys quarantined
    assert {r.update_tm for r in usgs.collect()} == {RUN}
    assert spark.table(m.t("census_raw")).count() == 6
    assert spark.table(m.t("geocode_raw")).count() == 6
    assert spark.table(m.t("weather_raw")).count() == 6
    kept = spark.table(m.t("usgs_rejected"))
    assert m.rejected["bronze_usgs"].count() == kept.count() and {r.rejected_tm for r in kept.collect()} == {RUN}
    assert kept.where("place is null or time is null or mag is null").count() == kept.count() >= 2


def test_silver_tables(spark, medallion):
    m, _ = medallion
    w = spark.table(m.t("weather_silver")).collect()
    assert sorted((r.lat, r.lon) for r in w) == [(34.05, -118.02), (35.21, -120.51), (36.5, -119.5)]
    assert all(abs(r.temperature_min - (r.temperature_max - 10)) < 1e-9 for r in w)
    assert min(r.temperature_min for r in w) < 10  # converted to Celsius
    c = {(r.name_key, r.state_name): r.pop for r in spark.table(m.t("census_silver")).collect()}
    assert c[("orange", "California")] == 3175692 and c[("orange", "Florida")] == 1393452
    assert c[("sanluisobispo", "California")] == 282424 and c[("districtwithoutcomma", None)] == 1000


def test_gold_tables(spark, medallion):
    m, _ = medallion
    loc = {(r.name_key, r.state): r for r in spark.table(m.t("location_dimension")).collect()}
    assert loc[("orange", "Florida")].pop == 1393452 and loc[("orange", "California")].pop == 3175692
    assert loc[("quietvalley", "California")].pop is None and loc[("quietvalley", "California")].area_name == "Quiet Valley"
    fact = spark.table(m.t("attribute_table"))
    pairs = sorted((r.area_name, r.usgs_mag, r.dist_miles) for r in fact.collect())
    assert pairs == [("Obispo Town", 2.5, 0.0), ("Orange", 3.1, 0.0), ("Quiet Valley", 2.6, 0.0)]
    assert not [c for c in fact.columns if fact.columns.count(c) > 1]  # no repeated names (ruling D28)
    dim = spark.table(m.t("dim_date")).collect()
    assert [r.date for r in dim] == [dt.date(2024, 3, 1)]


def test_run_log_moves_watermark(spark, medallion):
    m, _ = medallion
    assert watermark(spark.table(m.t("run_log"))).first()[0] == RUN


def test_rerun_same_input_same_tables(spark, medallion):
    """Only ``update_tm`` moves: a rerun is stamped after the recorded run, so that silver sees its rows."""
    m, landed = medallion
    names = ["usgs_raw", "weather_silver", "census_silver", "location_dimension", "attribute_table", "dim_date"]
    before = _snapshot(spark, m, names)
    m.bronze(landed, RUN)
    m.silver(RUN)
    m.gold("rerun")
    assert _snapshot(spark, m, names) == before


def test_replay_from_landed_csv_equals_fresh(spark, medallion):
    m, landed = medallion
    names = ["usgs_raw", "census_raw", "geocode_raw", "weather_raw", "weather_silver", "usgs_silver", "census_silver", "attribute_table"]
    before = _snapshot(spark, m, names)
    m.run(landed, RUN, job_id="replay", source="csv")
    assert _snapshot(spark, m, names) == before
    assert watermark(spark.table(m.t("run_log"))).first()[0] > RUN


def test_replay_of_an_unknown_run_is_an_error(spark, medallion):
    m, landed = medallion
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        m.bronze(landed, RUN + dt.timedelta(days=400), source="csv")


def test_corrected_replay_reaches_silver_and_gold(spark, tmp_path):
    from pyspark.sql import functions as F

    from geomedallion import schemas as SC
    from geomedallion.sinks import tables as K
    from geomedallion.sources.csv import read_csv

    landed = P.write(str(tmp_path / "landed"))
    m = Medallion(spark, "gm_test_replay", str(tmp_path / "warehouse"))
    m.create()
    m.run(landed, RUN, job_id="run-1")
    path = K.landed_csv_path(f"{landed}/csv", "weather", RUN)
    rows = spark.createDataFrame(read_csv(spark, path, SC.STAGING["weather"], multi_line=True).withColumn("pressure", F.lit(999.0)).collect(), SC.STAGING["weather"])
    K.write_landed_csv(rows, f"{landed}/csv", "weather", RUN)
    m.run(landed, RUN, job_id="run-2", source="csv")
    assert {r.pressure for r in spark.table(m.t("weather_silver")).collect()} == {999.0}
    assert {r.pressure for r in spark.table(m.t("attribute_table")).collect()} == {999.0}


def test_crash_between_record_and_swap_loses_nothing(spark, tmp_path, monkeypatch):
    from geomedallion.sinks import tables as K

    landed = P.write(str(tmp_path / "landed"))
    m = Medallion(spark, "gm_test_crash", str(tmp_path / "warehouse"))
    m.create()
    swap = K.replace_partitions

    def fail(df, table, *args):
        swap(df, table, *args)
        if table.endswith("weather_raw"):
            raise OSError("driver lost")

    monkeypatch.setattr(K, "replace_partitions", fail)
    with pytest.raises(OSError):
        m.bronze(landed, RUN)
    monkeypatch.undo()
    m.run(landed, RUN + dt.timedelta(minutes=5), job_id="next")
    assert spark.table(m.t("weather_silver")).count() == 3


def test_quarantine_keeps_rows_without_time_or_magnitude(spark):
    from geomedallion.plans.layers import stage_usgs

    rows = [("a", dt.datetime(2024, 3, 1, 1), 3.0), ("b", None, 3.0), ("c", dt.datetime(2024, 3, 1, 2), None), ("d", dt.datetime(2024, 3, 5), 3.0), ("e", dt.datetime(2024, 3, 1, 3), 1.0)]
    df = spark.createDataFrame(rows, "place string, time timestamp, mag double")
    valid, rejected = stage_usgs(df, dt.datetime(2024, 3, 1), dt.datetime(2024, 3, 2), min_mag=2.0)
    assert [r.place for r in valid.collect()] == ["a"] and sorted(r.place for r in rejected.collect()) == ["b", "c"]


def _partition_location(spark, table, day):
    db, name = table.split(".")
    info = spark.sql(f"SHOW TABLE EXTENDED IN {db} LIKE '{name}' PARTITION (day='{day}')").first().information
    return [line for line in info.splitlines() if line.startswith("Location")][0]


def test_merge_rewrites_only_touched_partitions(spark, tmp_path):
    from pyspark.sql import functions as F

    m = Medallion(spark, "gm_test_parts", str(tmp_path / "warehouse"))
    m.create()
    staging, raw = m.t("weather_insert"), m.t("weather_raw")
    base = spark.createDataFrame(
        [(1.0, 2.0, dt.datetime(2024, 3, 1), 280.0), (1.0, 2.0, dt.datetime(2024, 3, 2), 281.0)],
        "lat double, lon double, date timestamp, temperature_min double")
    from geomedallion import schemas as SC
    from geomedallion.sinks import tables as K
    from geomedallion.sources.csv import bind_by_name

    base = bind_by_name(base, SC.STAGING["weather"])
    K.load_staging(base, staging)
    m.merge_into("weather", raw, staging, ["lat", "lon", "date"], RUN, "d1")
    day1 = _partition_location(spark, raw, "2024-03-01")
    K.load_staging(base.where(F.col("date") > dt.datetime(2024, 3, 1, 12)).withColumn("temperature_min", F.lit(290.0)), staging)
    m.merge_into("weather", raw, staging, ["lat", "lon", "date"], RUN, "d2")
    assert _partition_location(spark, raw, "2024-03-01") == day1  # untouched partition kept its folder
    got = {r.date.day: r.temperature_min for r in spark.table(raw).collect()}
    assert got == {1: 280.0, 2: 290.0}


def test_missing_feed_folder_is_empty(spark, tmp_path):
    landed = P.write(str(tmp_path / "landed"), skip=("census",))
    m = Medallion(spark, "gm_test_missing", str(tmp_path / "warehouse"))
    m.create()
    m.bronze(landed, RUN, land_csv=False)
    assert spark.table(m.t("census_raw")).count() == 0
    assert spark.table(m.t("weather_raw")).count() == 6


def test_silver_pull_prunes_to_touched_days(spark, medallion):
    from geomedallion.operators.extract import extract_since

    m, _ = medallion
    run_log = spark.table(m.t("run_log"))
    pulled = extract_since(m.changed_rows("weather_raw", run_log), run_log, "update_tm")
    assert pulled.count() == 0  # nothing merged since the recorded run
    plan = pulled._jdf.queryExecution().executedPlan().toString().lower()
    assert "dynamicpruningexpression" in plan


def test_unparsable_payloads_and_the_feed_report_are_kept(spark, tmp_path):
    import os

    landed = P.write(str(tmp_path / "landed"))
    with open(os.path.join(landed, "events", "cut.json"), "w") as fh:
        fh.write('{"type": "FeatureCollection", "features": [{"proper\n\n{"features": []}\n')
    with open(os.path.join(landed, "census", "cut.json"), "w") as fh:
        fh.write('[["NAME", "POP"], ["x"\n')
    m = Medallion(spark, "gm_test_reports", str(tmp_path / "warehouse"))
    m.create()
    m.bronze(landed, RUN, land_csv=False)
    kept = sorted((r.entity, r.payload[:9]) for r in spark.table(m.t("rejected_payloads")).collect())
    assert kept == [("census", '[["NAME",'), ("usgs", '{"type": ')]
    report = {r.rule: r.n_rejected for r in spark.table(m.t("feed_report")).collect()}
    assert report["no_features"] >= 1 and set(report) >= {"no_geometry", "bad_place", "no_time"}


def _second_landing(root):
    """A day later: weather of a new day at known places, a quake at a place that had none, one that moved, a correction."""
    day = 86_400_000
    P.write(root, skip=("events", "weather"))
    weather = [dict(w, date="2024-03-02") for w in P.WEATHER[:3]]
    events = {"type": "FeatureCollection", "features": [
        P.feature(3.3, "New Hill", P.MS + day, [-120.51, 35.21]), P.feature(3.4, "Other Hill", P.MS + day + 1, [-119.5, 36.5]),
        P.feature(2.9, "Nowhere", P.MS + day + 2, [-100.0, 40.0]),
    ]}
    P.write_lines(root, "events", [events])
    P.write_lines(root, "weather", weather)
    return root


def test_second_gold_run_equals_a_rebuild(spark, tmp_path):
    m = Medallion(spark, "gm_test_gold2", str(tmp_path / "warehouse"))
    m.create()
    names = ["attribute_table", "location_dimension", "dim_date"]

    def run(landed, at, rebuild=False):
        m.bronze(landed, at)
        m.silver(at)
        mode = m.gold(at.strftime("%d%H%M"), rebuild)
        m.record_run(str(at), at)
        return mode

    assert run(P.write(str(tmp_path / "one")), RUN) == "full"
    first = spark.table(m.t("attribute_table")).count()
    assert run(_second_landing(str(tmp_path / "two")), RUN + dt.timedelta(days=1)) == "delta"
    assert m.gold("again") == "delta"  # nothing changed
    second = _snapshot(spark, m, names)
    assert len(second["attribute_table"]) > first + 3  # new days, and old days with the new quakes
    assert m.gold("rebuilt", rebuild=True) == "full" and _snapshot(spark, m, names) == second
    # the same quake again with other coordinates: its old and its new place are paired anew, on all days
    moved = {"type": "FeatureCollection", "features": [P.feature(3.3, "New Hill", P.MS + 86_400_000, [-118.02, 34.05])]}
    P.write_lines(str(tmp_path / "three"), "events", [moved])
    assert run(str(tmp_path / "three"), RUN + dt.timedelta(days=1, hours=2)) == "delta"
    third = _snapshot(spark, m, names)
    assert third != second and m.gold("rebuilt2", rebuild=True) == "full" and _snapshot(spark, m, names) == third
    # a place more: any match can change
    P.write_lines(str(tmp_path / "four"), "geocode", [[P.geo("Tiny Place", 36.5, -119.49)]])
    assert run(str(tmp_path / "four"), RUN + dt.timedelta(days=1, hours=3)) == "full"


def test_gold_run_cut_short_is_made_up_for(spark, tmp_path, monkeypatch):
    m = Medallion(spark, "gm_test_gold3", str(tmp_path / "warehouse"))
    m.create()
    m.run(P.write(str(tmp_path / "one")), RUN)
    later = RUN + dt.timedelta(days=1)
    m.bronze(_second_landing(str(tmp_path / "two")), later)
    m.silver(later)
    put = Medallion._put_days

    def fail(self, df, name, snapshot):
        if name == "attribute_table":
            raise OSError("driver lost")
        put(self, df, name, snapshot)

    monkeypatch.setattr(Medallion, "_put_days", fail)
    with pytest.raises(OSError):
        m.gold("cut")
    monkeypatch.undo()
    assert m.gold("next") == "delta"
    after = _snapshot(spark, m, ["attribute_table"])
    m.gold("rebuilt", rebuild=True)
    assert _snapshot(spark, m, ["attribute_table"]) == after


def test_merge_of_a_thousand_days(spark, tmp_path):
    from pyspark.sql import functions as F

    from geomedallion import schemas as SC
    from geomedallion.sinks import tables as K
    from geomedallion.sources.csv import bind_by_name

    m = Medallion(spark, "gm_test_days", str(tmp_path / "warehouse"))
    m.create()
    staging, raw = m.t("weather_insert"), m.t("weather_raw")
    days = spark.range(1100).select(F.lit(1.0).alias("lat"), F.lit(2.0).alias("lon"), F.expr("timestamp '2020-01-01' + make_interval(0, 0, 0, int(id))").alias("date"), F.col("id").cast("double").alias("wind"))
    rows = bind_by_name(days, SC.STAGING["weather"])
    K.load_staging(rows.where("wind < 1000"), staging)
    m.merge_into("weather", raw, staging, ["lat", "lon", "date"], RUN, "d1")
    K.load_staging(rows.where("wind >= 100").withColumn("wind", F.lit(-1.0)), staging)
    m.merge_into("weather", raw, staging, ["lat", "lon", "date"], RUN + dt.timedelta(days=1), "d2")
    got = spark.table(raw)
    assert got.count() == got.select("date").distinct().count() == 1100
    assert got.where("wind < 0").count() == 1000 and got.where("day is null").count() == 0


def test_retention_keeps_what_tables_and_recent_readers_read(spark, medallion, tmp_path):
    landed = P.write(str(tmp_path / "landed"))
    m = Medallion(spark, "gm_test_retention", str(tmp_path / "warehouse"))
    m.create()
    m.run(landed, RUN, job_id="run-1")
    old = spark.read.parquet(spark.table(m.t("weather_silver")).inputFiles()[0].rsplit("/day=", 1)[0])
    rows = old.count()
    m.run(landed, RUN + dt.timedelta(minutes=1), job_id="run-2")
    names = [t.name for t in spark.catalog.listTables(m.database)]
    before = _snapshot(spark, m, [n for n in names if not n.endswith("_insert")])
    assert m.remove_stale(dt.datetime.now(dt.timezone.utc) - dt.timedelta(hours=1)) == {}
    assert old.count() == rows  # a reader of the superseded snapshot
    gone = m.remove_stale(dt.datetime.now(dt.timezone.utc) + dt.timedelta(seconds=5))
    assert "weather_silver" in gone and "census_raw" in gone and "run_log" not in gone
    assert _snapshot(spark, m, list(before)) == before  # a new reader
    with pytest.raises(Exception):
        old.count()
    assert m.remove_stale(dt.datetime.now(dt.timezone.utc) + dt.timedelta(seconds=5)) == {}
