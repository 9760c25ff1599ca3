import json
import os

import payloads as P

from geomedallion.plans.layers import Medallion
from geomedallion.streaming import bronze_streams


def test_stream_merges_each_landed_file_once(spark, tmp_path):
    landed = P.write(str(tmp_path / "landed"))
    m = Medallion(spark, "gm_test_stream", str(tmp_path / "warehouse"))
    m.create()
    ckpt = str(tmp_path / "ckpt")
    bronze_streams(m, landed, ckpt)
    first = spark.table(m.t("usgs_raw")).count()
    # no feed window in streaming mode, but the same magnitude rule as in batch (one feature is below it);
    # the two null-place features are quarantined
    assert first == 5 and min(r.mag for r in spark.table(m.t("usgs_raw")).collect()) >= 2.0
    assert spark.table(m.t("weather_raw")).count() == 6
    assert spark.table(m.t("geocode_raw")).count() == 6

    # a newly landed file: only it is processed; a re-stated feature updates its row
    with open(os.path.join(landed, "events", "part-1.json"), "w") as fh:
        feed = {"type": "FeatureCollection", "features": [P.feature(5.0, "New Place", P.MS + 9000, [-119.0, 36.0]),
                                                          P.feature(2.75, "Quiet Valley", P.MS + 1000, [-118.02, 34.05])]}
        fh.write(json.dumps(feed) + "\n")
    bronze_streams(m, landed, ckpt, entities=("usgs",))
    rows = {r.place: r.mag for r in spark.table(m.t("usgs_raw")).collect()}
    assert len(rows) == first + 1 and rows["New Place"] == 5.0 and rows["Quiet Valley"] == 2.75


def test_stream_keeps_bad_payloads_and_outcomes(spark, tmp_path):
    landed = P.write(str(tmp_path / "landed"))
    with open(os.path.join(landed, "events", "cut.json"), "w") as fh:
        fh.write('{"type": "FeatureCollection", "features": [{"proper\n')
    m = Medallion(spark, "gm_test_stream_bad", str(tmp_path / "warehouse"))
    m.create()
    bronze_streams(m, landed, str(tmp_path / "ckpt"), entities=("usgs",))
    assert [r.entity for r in spark.table(m.t("rejected_payloads")).collect()] == ["usgs"]
    counts = {r.outcome: r.n for r in spark.sql(f"select outcome, sum(n_rows) n from {m.t('feed_outcomes')} group by outcome").collect()}
    assert counts == {"valid": 5, "rejected": 2, "out_of_window": 1, "bad_payload": 1, "empty_payload": 1}
    assert not os.listdir(str(tmp_path / "warehouse" / "_intake"))  # batches leave nothing behind


def test_silver_run_waits_for_a_batch_in_flight(spark, tmp_path, monkeypatch):
    """A batch has taken its merge time and is not yet in the table when a silver run starts: the run must
    not set its watermark past rows that it does not see."""
    import datetime as dt
    import threading

    from geomedallion.plans import intake as IN
    from geomedallion.sinks import tables as K

    landed = P.write(str(tmp_path / "landed"))
    m = Medallion(spark, "gm_test_interleave", str(tmp_path / "warehouse"))
    m.create()
    swapping, go, swap = threading.Event(), threading.Event(), K.replace_partitions

    def slow(df, table, *args):
        if table.endswith("weather_raw"):
            swapping.set()
            assert go.wait(120)
        swap(df, table, *args)

    monkeypatch.setattr(K, "replace_partitions", slow)
    rows = IN.intake(spark.read.text(f"{landed}/weather"), "weather")
    batch = threading.Thread(target=m.merge_batch, args=("weather", rows, "batch"))
    batch.start()
    assert swapping.wait(120)
    at = dt.datetime.now(dt.timezone.utc) + dt.timedelta(seconds=30)  # after the batch's merge time
    silver = threading.Thread(target=m.silver, args=(at,))
    silver.start()
    silver.join(3)
    assert silver.is_alive()  # it waits
    go.set()
    batch.join(120), silver.join(120)
    m.record_run("run", at)
    m.silver(at + dt.timedelta(hours=1))
    assert spark.table(m.t("weather_silver")).count() == 3
    # a batch after the run is newer than its watermark, though the run's own time lay ahead
    m.merge_batch("weather", rows, "batch2")
    newest = spark.table(m.t("weather_raw")).selectExpr("max(unix_micros(update_tm)) as t").first().t
    assert newest > spark.table(m.t("run_log")).selectExpr("max(unix_micros(last_updated)) as t").first().t
