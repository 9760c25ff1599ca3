from pyspark.sql import functions as F

from geomedallion.operators.joins import ROWS_PER_LIST, _lists, salted_left_join
from geomedallion.operators.sizing import DEFAULT_BROADCAST_MAX_ROWS, broadcast_if_small, measure


def test_salted_left_join_equals_left_join_under_skew(spark):
    left = spark.range(200).select((F.col("id") % 10).alias("k"), F.col("id").alias("l"))
    # key 0 holds most right rows; key 9 has none; a null key never matches
    right = spark.range(3000).select(F.when(F.col("id") < 2500, 0).when(F.col("id") % 9 == 0, None)
                                     .otherwise(F.col("id") % 9).alias("k"), F.col("id").alias("r"))
    want = left.join(right, ["k"], "left")
    got = salted_left_join(left, right, ["k"], rows_per_salt=50)
    assert sorted(map(tuple, got.select(*want.columns).collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    assert got.where("k = 9 AND r IS NULL").count() == 20


def test_unmatched_rows_stay_out_of_the_exchange(spark):
    left = spark.range(4000).select(F.when(F.col("id") < 1000, F.col("id") % 5).when(F.col("id") < 2000, None).otherwise(F.col("id")).alias("k"), F.col("id").alias("l"))
    right = spark.range(300).select((F.col("id") % 5).alias("k"), F.col("id").alias("r"))
    want = sorted(map(tuple, left.join(right, ["k"], "left").collect()), key=str)
    for bound in (DEFAULT_BROADCAST_MAX_ROWS, 0):  # counts broadcast, and joined by a shuffle
        got = salted_left_join(left, right, ["k"], rows_per_salt=10, broadcast_max_rows=bound)
        assert sorted(map(tuple, got.collect()), key=str) == want
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = salted_left_join(left, right, ["k"], key_rows_bound=5)
        got.collect()
        plan = got._jdf.queryExecution().executedPlan()
        sent = _shuffled_rows(plan)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert 1000 <= max(sent) < 1500, sent  # a thousand left rows have a key of the right side


def _shuffled_rows(plan):
    """Rows that each exchange of an executed plan wrote."""
    out, todo = [], [plan]
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            todo.append(node.plan())
        else:
            if name == "ShuffleExchangeExec":
                out.append(node.metrics().apply("shuffleRecordsWritten").value())
            children = node.children()
            todo.extend(children.apply(i) for i in range(children.size()))
    return out


def test_sizes_are_measured_in_rows_and_bytes(spark):
    df = spark.range(100).withColumn("wide", F.repeat(F.lit("x"), 1000)).withColumn("none", F.lit(None).cast("string"))
    size = measure(df)
    assert size.rows == 100 and 100_000 < size.bytes < 120_000
    assert broadcast_if_small(df, 100)[1] and not broadcast_if_small(df, 99)[1] and not broadcast_if_small(df, 0)[1]
    assert not broadcast_if_small(df, 100, max_bytes=50_000)[1] and broadcast_if_small(df.select("id"), 100, max_bytes=50_000)[1]
    assert measure(df.limit(0)).rows == measure(df.limit(0)).bytes == 0


def _joined_rows(plan):
    """Rows that each join of an executed plan made."""
    out, todo = [], [plan]
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            todo.append(node.plan())
        else:
            if name.endswith("JoinExec"):
                out.append(node.metrics().apply("numOutputRows").value())
            children = node.children()
            todo.extend(children.apply(i) for i in range(children.size()))
    return out


def test_pairs_are_made_from_lists_of_right_rows(spark):
    left = spark.range(40).select((F.col("id") % 2).alias("k"), F.col("id").alias("l"))
    right = spark.range(6000).select((F.col("id") % 2).alias("k"), (F.col("id") * 0).alias("r.same"), F.lit(None).alias("none"))  # equal rows share a salt
    got = salted_left_join(left, right, ["k"])
    assert len(got.collect()) == 40 * 3000
    assert max(_joined_rows(got._jdf.queryExecution().executedPlan())) <= 6000  # the join itself made every pair
    assert got.columns == ["k", "l", "r.same", "none"]
    lists = _lists(right.withColumn("__salt", F.lit(0)).withColumn("__hash", F.xxhash64("k")), ["k"], ["r.same", "none"])
    sizes = [r[0] for r in lists.select(F.size("__rows")).collect()]
    assert max(sizes) <= ROWS_PER_LIST and sum(sizes) == 6000


def test_pairs_of_signed_zeros_and_nan(spark):
    left = spark.createDataFrame([(0.0, 1), (-0.0, 2), (float("nan"), 3), (None, 4), (5.0, 5)], "k double, l int")
    right = spark.createDataFrame([(-0.0, 1), (0.0, 2), (float("nan"), 3), (None, 4)], "k double, r int")
    for salt in (1, 100):
        got = salted_left_join(left, right, ["k"], rows_per_salt=salt)
        assert sorted(((r["l"], r["r"]) for r in got.collect()), key=str) == [(1, 1), (1, 2), (2, 1), (2, 2), (3, 3), (4, None), (5, None)]
