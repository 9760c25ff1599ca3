"""Operator 7: near-duplicates by b-bit MinHash.

A document is the set of its distinct word shingles. ``BANDS * ROWS`` minima per set give ``BANDS`` band
keys, each a hash of ``ROWS`` minima; documents that share a key are candidates. Of each minimum the
lowest ``BITS`` bits are packed into a signature. Counting equal fields of two signatures, corrected for
chance collisions, estimates the similarity and drops most candidates; the rest is confirmed on the full
sets. Links make components.

Nothing is lost between band and link: documents with equal sets are one node from the start; each
bucket first tests its members against its least and one random member only; what lies in one component
needs no further test. In the next turn, buckets that still hold several components draw a new pivot.
Members of what is left are compared exactly across components by their differences from a pivot, so
every candidate pair is either inside a component or tested. A bucket with a third of all documents
(near copies of one text) thus makes a pair per member and turn, not per pair of members.

Probability of missing a link of similarity 0.8: ``(1 - 0.8**5)**30 = 7e-6`` in the bands, less than 1e-6
by the estimate (five standard deviations); both fall fast above 0.8.

Scale: texts are read twice and never shuffled whole; a document is about 300 bytes in the first
shuffle, its 30 keys 16 bytes each in the second. Full sets travel only for candidates.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geomedallion.llm.common import broadcast_if_small, in_arrow, materialise, steps
from geomedallion.llm.components import merged_components

BANDS, ROWS = 30, 5
BITS = 2
FIELDS = 64 // BITS
LONGS = -(-BANDS * ROWS // FIELDS)
MAX_TURNS = 2
PART_ROWS = 128  # members of a pivot in one part of the last join, about
MARGIN = 0.2  # candidates estimated below the threshold by more than this are dropped
CHUNK = 1_024  # shingles hashed at once, which bounds memory
SEED = 77
WORDS, PERCENT = 5, 80


def words_of(text: str) -> list[bytes]:
    """Runs of other characters than blanks (space, tab to carriage return), with A-Z in lower case."""
    return text.encode("utf-8", "replace").lower().split()


def shingle_set(text: str, n: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles; all words as one if there are fewer than ``n``."""
    words = words_of(text)
    if not words:
        return np.zeros(0, np.uint64)
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = min(n, len(words))
    out = np.full(len(words) - n + 1, n, np.uint64)
    for j in range(n):
        out = (out ^ hashed[j : j + len(out)]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(31)
    return np.unique(out)


class Signer:
    """Minima, band keys and packed signatures; one per task."""

    def __init__(self):
        rng = np.random.default_rng(SEED)
        self.a = rng.integers(1, 2**63, BANDS * ROWS, np.uint64) * np.uint64(2) + np.uint64(1)
        self.b = rng.integers(0, 2**63, BANDS * ROWS, np.uint64)
        self.mix = rng.integers(1, 2**63, (BANDS, ROWS), np.uint64) * np.uint64(2) + np.uint64(1)
        self.band = rng.integers(0, 2**63, BANDS, np.uint64)

    def minima(self, shingles: np.ndarray) -> np.ndarray:
        least = np.full(BANDS * ROWS, 2**64 - 1, np.uint64)
        for i in range(0, len(shingles), CHUNK):
            np.minimum(least, (shingles[i : i + CHUNK, None] * self.a + self.b).min(0), out=least)
        least ^= least >> np.uint64(29)  # spreads the minima over the low bits
        return (least * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(20)

    def bands(self, minima: np.ndarray) -> np.ndarray:
        keys = (minima.reshape(BANDS, ROWS) * self.mix).sum(1, dtype=np.uint64) + self.band
        keys ^= keys >> np.uint64(32)
        return (keys * np.uint64(0x94D049BB133111EB)).view(np.int64)

    def packed(self, minima: np.ndarray) -> np.ndarray:
        low = np.zeros(LONGS * FIELDS, np.uint64)
        low[: len(minima)] = minima & np.uint64(2**BITS - 1)
        shift = np.arange(FIELDS, dtype=np.uint64) * np.uint64(BITS)
        return np.bitwise_or.reduce(low.reshape(LONGS, FIELDS) << shift, axis=1).view(np.int64)


def estimate(a: Column, b: Column) -> Column:
    """Similarity from two packed signatures, corrected for fields that agree by chance."""
    field = sum(1 << (BITS * i) for i in range(FIELDS))
    field = field - 2**64 if field >= 2**63 else field
    differ = F.lit(0)
    for i in range(LONGS):
        x = a[i].bitwiseXOR(b[i])
        for shift in range(1, BITS):
            x = x.bitwiseOR(F.shiftrightunsigned(a[i].bitwiseXOR(b[i]), shift))
        differ = differ + F.bit_count(x.bitwiseAND(F.lit(field)))
    chance = 2.0**-BITS
    return ((1 - differ / (BANDS * ROWS)) - chance) / (1 - chance)


def _text_key(text: Column) -> Column:
    return F.xxhash64(text)


def signatures(docs: DataFrame, n_words: int) -> DataFrame:
    """``doc_id, text_key, n_shingles, set_key, bands, packed`` of rows with columns ``doc_id, text``."""
    schema = T.StructType([
        T.StructField("doc_id", T.LongType()), T.StructField("text_key", T.LongType()), T.StructField("n_shingles", T.LongType()), T.StructField("set_key", T.BinaryType()),
        T.StructField("bands", T.ArrayType(T.LongType())), T.StructField("packed", T.ArrayType(T.LongType())),
    ])

    def lists(rows: list[np.ndarray | None], width: int) -> pa.Array:
        offsets = np.cumsum([0] + [width if r is not None else 0 for r in rows]).astype(np.int32)
        values = [r for r in rows if r is not None]
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(values) if values else np.zeros(0, np.int64)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signer = Signer()
        for batch in batches:
            n, key, bands, packed = [], [], [], []
            for body in batch.column(2):
                shingles = shingle_set(body.as_py() or "", n_words)
                minima = signer.minima(shingles) if len(shingles) else None
                n.append(len(shingles))
                key.append(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest())
                bands.append(None if minima is None else signer.bands(minima))
                packed.append(None if minima is None else signer.packed(minima))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(key, pa.binary()), lists(bands, BANDS), lists(packed, LONGS)], names=schema.names
            )

    return docs.select("doc_id", _text_key(F.col("text")).alias("text_key"), "text").transform(in_arrow, run, schema)


def shingle_arrays(docs: DataFrame, n_words: int) -> DataFrame:
    """``node, shingles`` (the full set) of rows with columns ``doc_id, text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(body.as_py() or "", n_words).view(np.int64) for body in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.list_(pa.int64()))], names=["node", "shingles"])

    return docs.transform(in_arrow, run, "node long, shingles array<long>")


def _ordered(x: Column, y: Column) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def _likely(percent: int) -> Column:
    """Condition on ``n_a, n_b, packed_a, packed_b``: sizes allow a link, and the estimate does."""
    sizes = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent
    return sizes & (estimate(F.col("packed_a"), F.col("packed_b")) >= percent / 100 - MARGIN)


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` whose full sets are similar enough."""
    both = pairs.join(sets.toDF("b", "set_b"), "b").join(sets.toDF("a", "set_a"), "a")
    common = F.size(F.array_intersect("set_a", "set_b"))
    return materialise(both.filter(common * 100 >= (F.size("set_a") + F.size("set_b") - common) * percent).select("a", "b"))


def _mixed(held: DataFrame, labels: DataFrame | None, turn: int) -> tuple[DataFrame, DataFrame]:
    """Buckets' members with their components; the buckets with several, each with a random member as pivot."""
    members = held.withColumn("component", F.col("node"))
    if labels is not None:
        members = held.join(labels, "node", "left").select("key", "node", F.coalesce("component", "node").alias("component"))
    draw = F.xxhash64("node", "key", F.lit(turn))
    buckets = members.groupBy("key").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.min_by("node", draw).alias("pivot"), F.min_by("component", draw).alias("of_pivot")
    )
    return members, buckets.filter(F.col("low") != F.col("high"))


def _linked(nodes: DataFrame, held: DataFrame, sets: DataFrame, percent: int) -> DataFrame | None:
    """``node, component`` of the nodes that have links (None without any)."""
    sizes = nodes.select("node", "n", "packed")
    left, right = sizes.toDF("a", "n_a", "packed_a"), sizes.toDF("b", "n_b", "packed_b")
    tested = links = labels = None
    for turn in range(MAX_TURNS):  # each member against one pivot, as long as that links anything
        members, buckets = _mixed(held, labels, turn)
        across = members.join(buckets, "key").filter(F.col("component") != F.col("of_pivot"))
        pairs = across.select(*_ordered(F.col("node"), F.col("pivot")))
        if turn == 0:
            pairs = pairs.union(across.filter(F.col("node") != F.col("low")).select(*_ordered(F.col("node"), F.col("low"))))
        pairs = pairs.distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = materialise(pairs.join(right, "b").join(left, "a").filter(_likely(percent)).select("a", "b"))
        tested = pairs if tested is None else tested.union(pairs)
        more = _confirmed(pairs, sets, percent)
        if more.isEmpty():
            break
        links = more if links is None else links.union(more)
        labels = merged_components(labels, more)

    more = _links_by_difference(_mixed(held, labels, MAX_TURNS), links, sets, percent)
    if not more.isEmpty():
        labels = merged_components(labels, more)
    return labels


def _links_by_difference(mixed: tuple[DataFrame, DataFrame], links: DataFrame | None, sets: DataFrame, percent: int) -> DataFrame:
    """All links across components within the buckets that still hold several.

    Each bucket has a pivot ``p``, its member with most links, and each member ``x`` is described by its
    difference from it: ``a = |p - x|``, ``b = |x - p|`` and the differing shingles. Two members whose
    differences share ``s`` shingles have ``|p| - a - a' + s`` shingles in common and ``|p| + b + b' - s`` in
    their union, so short arrays decide exactly; no candidate pairs are written. The join compares members
    outside a pivot's largest component with its members. A pivot's members are dealt into parts by their number from
    the start, and its set goes to each part once.
    """
    members, buckets = mixed
    if links is None:
        degree = members.select("node").distinct().withColumn("degree", F.lit(0))
    else:
        degree = links.select(F.col("a").alias("node")).union(links.select(F.col("b").alias("node"))).groupBy("node").agg(F.count("*").alias("degree"))
    held = members.join(buckets.select("key"), "key").join(degree, "node", "left").withColumn("degree", F.coalesce("degree", F.lit(0)))
    # of two members one was the pivot already
    pivots = held.groupBy("key").agg(F.max_by("node", "degree").alias("pivot"), F.count("*").alias("n")).filter(F.col("n") > 2)
    parts = pivots.groupBy("pivot").agg(F.ceil(F.sum("n") / F.lit(PART_ROWS)).cast("int").alias("parts"))
    pivots = broadcast_if_small(materialise(pivots.join(parts, "pivot").select("key", "pivot", "parts")))
    part = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int").alias("part")
    around = held.join(pivots, "key").select("pivot", "parts", part, "node", "component").distinct()
    pivot_sets = parts.join(sets.toDF("pivot", "other"), "pivot").select("pivot", "other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    both = around.join(sets.toDF("node", "own"), "node").join(pivot_sets, ["pivot", "part"])
    gone, new = F.array_except("other", "own"), F.array_except("own", "other")
    described = materialise(
        both.select("pivot", "part", "parts", "node", "component", F.size(gone).alias("a"), F.size(new).alias("b"), F.size("other").alias("p"), F.concat(gone, new).alias("diff"))
    )
    counted = described.groupBy("pivot", "component").agg(F.count("*").alias("n"))
    # a row for each pivot; beyond the bound, Spark splits the hot side of the joins on it
    main = broadcast_if_small(materialise(counted.groupBy("pivot").agg(F.max_by("component", "n").alias("main"))))
    y = described.join(main, "pivot").withColumn("in_main", F.col("component") == F.col("main")).drop("main", "parts")
    x = described.join(main, "pivot").filter(F.col("component") != F.col("main"))
    x = x.select("pivot", "node", "component", "a", "b", "diff", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")).toDF("pivot", "x", "c_x", "a_x", "b_x", "d_x", "part")
    once = F.col("in_main") | (F.col("x") < F.col("node"))
    most = F.least(F.size("d_x"), F.size("diff"))  # bounds what the differences can share, before they are compared
    shared = F.size(F.array_intersect("d_x", "diff"))

    def similar(s: Column) -> Column:
        return (F.col("p") - F.col("a_x") - F.col("a") + s) * 100 >= (F.col("p") + F.col("b_x") + F.col("b") - s) * percent

    # when() keeps the order of the tests: the cheap ones first
    linked = F.when(~once | (F.col("c_x") == F.col("component")) | ~similar(most), False).otherwise(similar(shared))
    found = x.join(y, ["pivot", "part"]).filter(linked)
    return materialise(found.select(*_ordered(F.col("x"), F.col("node"))).distinct())


def near_duplicates(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", n_words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``doc_id, text_key, n_shingles, component_id, kept`` of every row (``text_key`` is a hash of the text).

    Documents are linked when ``100 * common >= percent * union`` of their shingle sets; a component is
    named by its least doc_id, whose row is kept. Null texts and texts without words have no shingles and
    no links. Rows that repeat a doc_id are separate documents; those with equal sets are one node. Ids
    are whole numbers; rows without one are left out. Other columns are not read. An empty table gives
    no rows.
    """
    with steps() as keep:
        docs = documents.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text")).filter(F.col("doc_id").isNotNull())
        signed = materialise(signatures(docs, n_words))
        nodes = materialise(
            signed.filter(F.col("n_shingles") > 0).groupBy("set_key")
            .agg(F.min("doc_id").alias("node"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"), F.first("packed").alias("packed"))
        )
        keys = nodes.select("node", F.explode("bands").alias("key"))
        shared = keys.groupBy("key").agg(F.min("node").alias("least"), F.max("node").alias("most")).filter(F.col("least") != F.col("most"))
        held = materialise(keys.join(shared.select("key"), "key"))  # buckets of two nodes or more
        wanted = broadcast_if_small(materialise(held.select(F.col("node").alias("doc_id")).distinct()))
        sets = materialise(shingle_arrays(docs.join(wanted, "doc_id", "left_semi"), n_words))
        labels = _linked(nodes, held, sets, percent)

        named = signed.select("doc_id", "text_key", "n_shingles", "set_key").join(nodes.select("set_key", "node"), "set_key", "left")
        named = named.withColumn("component", F.col("node")) if labels is None else named.join(labels, "node", "left")
        component = F.coalesce("component", "node", "doc_id")
        return keep(named.select("doc_id", "text_key", "n_shingles", component.alias("component_id"), (F.col("doc_id") == component).alias("kept")))


def keep_one_of_each(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", n_words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``documents`` with one row of each component: that of the least doc_id; rows keep all their columns.

    Of rows that share id and component one stays. Rows without an id cannot be named and all stay.
    """
    found = near_duplicates(documents, doc_id, text, n_words, percent)
    nth = F.row_number().over(Window.partitionBy("doc_id", "component_id").orderBy("text_key"))
    same = found.groupBy("doc_id", "text_key").agg(F.count("*").alias("n"), F.first("component_id").alias("component_id"), F.first("kept").alias("kept"))
    same = same.withColumn("stays", F.col("kept") & (nth == 1)).select(F.col("doc_id").alias("id"), F.col("text_key").alias("key"), "n", "stays")
    same = materialise(same.filter(~F.col("stays") | (F.col("n") > 1)))
    gone = broadcast_if_small(same.filter(~F.col("stays")).select("id", "key"))
    row = F.struct(*(F.col(f"`{c}`") for c in documents.columns)).alias("row")  # no column name can clash
    rows = documents.select(F.col(f"`{doc_id}`").cast("long").alias("id"), _text_key(F.col(f"`{text}`")).alias("key"), row)
    rows = rows.join(gone, ["id", "key"], "left_anti")
    repeated = same.filter("stays").select("id", "key")
    if not repeated.isEmpty():  # rows that agree in id and text: one of them
        several = broadcast_if_small(repeated)
        number = F.row_number().over(Window.partitionBy("id", "key").orderBy(F.to_json("row")))
        one = rows.join(several, ["id", "key"], "left_semi").withColumn("nth", number).filter(F.col("nth") == 1).drop("nth")
        rows = rows.join(several, ["id", "key"], "left_anti").union(one)
    return rows.select("row.*")
