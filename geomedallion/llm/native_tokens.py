"""Token counts of a byte-level BPE with DataFrame functions alone.

A text is cut into pre-tokens by the tokenizer's pattern. A pre-token that stands in the vocabulary is one token; the
distinct others are merged pair by pair, in rounds of joins with the vocabulary, as the tokenizer does: in each
round the adjacent pair of least rank, wherever it stands in the pre-token, from the left. Pre-tokens of over
``LONGEST`` bytes count a token a byte, which is never too little.

Scale: the vocabulary is a file of bounded size (some 50,000 rows), so it is broadcast; frequent pre-tokens are in
it. What is merged is each distinct other pre-token, once, for ``LONGEST`` rounds at most.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geomedallion.llm.common import materialise, release

LONGEST = 32


def vocabulary(spark: SparkSession, ranks: bytes) -> DataFrame:
    """``token`` (binary), ``rank`` from the text of a ranks file; a row for each line."""
    lines = spark.range(1).select(F.explode(F.split(F.lit(ranks.decode("ascii").strip()), "\n")).alias("line"))
    parts = F.split("line", " ")
    return materialise(lines.select(F.unbase64(parts[0]).alias("token"), parts[1].cast("int").alias("rank")))


def pre_tokens(text: Column, pattern: str) -> Column:
    """The pre-tokens of a text, as binaries. The pattern's classes are those of Unicode."""
    return F.transform(F.regexp_extract_all(text, F.lit(f"(?U){pattern}"), F.lit(0)), lambda x: x.cast("binary"))


def _merge_all(parts: Column, merged: Column) -> Column:
    """Every adjacent pair that makes ``merged`` replaced by it, from the left."""
    nothing = F.lit(None).cast("binary")
    start = F.struct(F.array().cast("array<binary>").alias("out"), nothing.alias("last"))

    def push(out: Column, last: Column) -> Column:
        return F.when(last.isNull(), out).otherwise(F.concat(out, F.array(last)))

    def step(acc: Column, part: Column) -> Column:
        joins = acc["last"].isNotNull() & (F.concat(acc["last"], part) == merged)
        out = F.when(joins, F.concat(acc["out"], F.array(merged))).otherwise(push(acc["out"], acc["last"]))
        return F.struct(out.alias("out"), F.when(joins, nothing).otherwise(part).alias("last"))

    return F.aggregate(parts, start, step, lambda acc: push(acc["out"], acc["last"]))


def merged_counts(words: DataFrame, vocab: DataFrame) -> DataFrame:
    """``word, n``: tokens of the distinct binaries ``word``, of ``LONGEST`` bytes at most and not in the vocabulary."""
    single = F.transform(F.sequence(F.lit(1), F.octet_length("word")), lambda i: F.substring(F.col("word"), i, F.lit(1)))
    now, done = materialise(words.select("word", single.alias("parts"))), []
    neighbours = F.arrays_zip(F.slice("parts", 1, F.size("parts") - 1).alias("a"), F.slice(F.col("parts"), F.lit(2), F.size("parts") - 1).alias("b"))
    while not now.isEmpty():
        pairs = now.select("word", "parts", F.explode_outer(neighbours).alias("p")).withColumn("token", F.concat("p.a", "p.b"))
        known = pairs.join(F.broadcast(vocab), "token", "left")
        least = known.groupBy("word").agg(F.first("parts").alias("parts"), F.min(F.when(F.col("rank").isNotNull(), F.struct("rank", "token"))).alias("m"))
        after = materialise(least.select("word", F.when(F.col("m").isNull(), F.col("parts")).otherwise(_merge_all(F.col("parts"), F.col("m.token"))).alias("parts"), F.col("m").isNull().alias("done")))
        release(now)
        done.append(after)
        now = materialise(after.filter(~F.col("done")).select("word", "parts"))
    out = words.select("word", F.lit(0).cast("long").alias("n")).limit(0)
    for part in done:
        out = out.unionByName(part.filter("done").select("word", F.size("parts").cast("long").alias("n")))
    return materialise(out)


def token_counts(rows: DataFrame, key: str, text: Column, ranks: bytes, pattern: str) -> DataFrame:
    """``key, tokens`` of every row of ``rows`` (``key`` unique): the tokens of ``text``, 0 where it is null or empty."""
    vocab = vocabulary(rows.sparkSession, ranks)
    words = rows.select(key, F.explode(pre_tokens(text, pattern)).alias("token")).groupBy(key, "token").agg(F.count("*").alias("times"))
    marked = words.join(F.broadcast(vocab), "token", "left")
    known = F.when(F.col("rank").isNotNull(), F.lit(1)).when(F.octet_length("token") > LONGEST, F.octet_length("token"))
    marked = materialise(marked.select(key, F.col("token").alias("word"), "times", known.cast("long").alias("n")))
    others = marked.filter(F.col("n").isNull()).drop("n")
    merged = others.join(merged_counts(others.select("word").distinct(), vocab), "word")
    found = marked.filter(F.col("n").isNotNull()).unionByName(merged)
    sums = found.groupBy(key).agg(F.sum(F.col("times") * F.col("n")).alias("tokens"))
    return rows.select(key).join(sums, key, "left").select(key, F.coalesce("tokens", F.lit(0)).alias("tokens"))
