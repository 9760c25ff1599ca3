import datetime as dt

from pyspark.sql import functions as F

from geomedallion.operators import quality as QC
from geomedallion.operators.calendar import DIM_DATE_COLUMNS, date_dimension


def test_date_dimension_gap_free_and_fields(spark):
    df = spark.createDataFrame([(dt.datetime(2019, 12, 30, 8),), (dt.datetime(2020, 1, 5),), (dt.datetime(1970, 1, 1),)],
                               "date timestamp")
    dim = date_dimension(df, "date")
    assert dim.columns == DIM_DATE_COLUMNS
    rows = {r.date: r for r in dim.collect()}
    assert sorted(rows) == [dt.date(2019, 12, 30) + dt.timedelta(days=i) for i in range(7)]  # epoch fill ignored
    jan1 = rows[dt.date(2020, 1, 1)]
    assert (jan1.date_key, jan1.day_of_week, jan1.day_name, jan1.week_of_year, jan1.iso_year) == (20200101, 3, "Wednesday", 1, 2019)
    assert jan1.is_year_start and jan1.is_month_start and not jan1.is_weekend
    assert rows[dt.date(2019, 12, 31)].is_year_end and rows[dt.date(2019, 12, 31)].is_month_end
    assert rows[dt.date(2020, 1, 4)].is_weekend and rows[dt.date(2020, 1, 4)].day_of_week == 6
    assert (jan1.month_name, jan1.month_short, jan1.year_month, jan1.quarter) == ("January", "Jan", "2020-01", 1)


def test_date_dimension_empty_input(spark):
    df = spark.createDataFrame([], "date timestamp")
    assert date_dimension(df, "date").count() == 0


def test_quality_checks(spark):
    df = spark.createDataFrame([(1, "Running", "x" * 21), (1, "Done", "ok"), (None, None, None)], "job int, status string, note string")
    assert [tuple(r) for r in QC.duplicate_keys(df, ["job"]).collect()] == [(1, 2)]
    assert QC.null_key_rows(df, ["job"]).count() == 1
    assert [r.status for r in QC.value_in_set(df, "status", QC.RUN_STATUSES).collect()] == ["Done"]  # null passes
    assert QC.too_long_strings(df, {"note": 20}).count() == 1
    rep = {r.rule: r.n_rejected for r in QC.rule_report(df, {"no_job": F.col("job").isNull(), "long": F.length("note") > 20}).collect()}
    assert rep == {"no_job": 1, "long": 1}
