"""Operator 5: packing token sequences by the linear grouping scheme.

Documents are tokenised, ended with an end token and cut to pieces of at most ``capacity`` tokens.
The pieces go into as few sequences as possible:

1. the histogram of piece lengths (at most ``capacity`` rows, whatever the corpus) is counted in Spark;
2. the driver plans on that histogram alone: large lengths are sorted into groups of equal
   cardinality and rounded up to the longest of their group; the few sizes give a configuration
   programme that column generation (knapsack pricing) solves; whole multiples of its configurations
   are filled with the actual lengths, and what is left, with all small lengths, goes in best fit by
   decreasing length into the space really left. A few bounds for "large" are tried (``SCHEMES``) and
   the plan with the fewest sequences is kept;
3. the plan is a short table "pieces number a to b of length l go to sequences s, s+1, ... at offset
   o", joined back to the pieces, which Spark numbers within their length.

Scale: texts never shuffle, a piece is about 40 bytes. A length is numbered in as many parts as its count asks
for (``RANK_ROWS`` each), whose starts come from a prefix sum of the parts' counts. The
plan has a few entries per length, so its broadcast is bounded by ``capacity`` and not by the data.
"""

from __future__ import annotations

import base64
import bisect
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geomedallion.llm.common import in_arrow, materialise, steps

CAPACITY = 1024
END_ID = 2
SCHEMES = ((160, 100), (341, 100), (512, 64))  # (lengths above are large, groups of large lengths)
RANK_ROWS = 250  # pieces of a part, about: parts spread evenly over tasks
PRICING_STEPS = 1500  # column generation ends there or within the gap; both leave a feasible programme
PRICING_GAP = 2e-4

Entry = tuple[int, int, int, int, int, int]  # length, first rank, count, first sequence, pieces a sequence, offset


def byte_bpe(ranks: bytes, pattern: str, added: dict[str, int] | None = None) -> tiktoken.Encoding:
    """Encoder from the text of a ranks file (token in base 64 and its id on each line), and tokens beside it."""
    pairs = (line.split() for line in ranks.splitlines())
    return tiktoken.Encoding("pieces", pat_str=pattern, mergeable_ranks={base64.b64decode(t): int(i) for t, i in pairs}, special_tokens=added or {})


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` tokens; only the first can be short."""
    first = n if n <= capacity else (n % capacity or capacity)
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def token_pieces(
    docs: DataFrame, doc_id: str, text: str, ranks: bytes, pattern: str, added: dict[str, int] | None = None,
    capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False,
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` (and ``ids``) of every piece of every document.

    A null text counts as empty: one piece that holds the end token only. The strings of ``added`` tokens in a
    text become their ids, all others are ordinary text. Texts are encoded whole.
    """
    id_type = docs.schema[doc_id].dataType
    schema = T.StructType([
        T.StructField("doc_id", id_type), T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType()),
    ])
    if with_ids:
        schema = schema.add("ids", T.ArrayType(T.IntegerType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = byte_bpe(ranks, pattern, added)
        for batch in batches:
            row, piece, start, length, crc, kept = [], [], [], [], [], []
            for i, body in enumerate(batch.column(1)):
                ids = np.append(encoder.encode_to_numpy(body.as_py() or "", allowed_special="all"), end_id).astype("<u4")
                for k, (s, n) in enumerate(cut(len(ids), capacity)):
                    row.append(i), piece.append(k), start.append(s), length.append(n)
                    crc.append(zlib.crc32(ids[s : s + n].tobytes()))
                    if with_ids:
                        kept.append(ids[s : s + n].astype(np.int32))
            cols = [batch.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32())]
            cols += [pa.array(x, pa.int64()) for x in (start, length, crc)]
            if with_ids:
                cols.append(pa.array(kept, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(cols, names=schema.names)

    return docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text")).transform(in_arrow, run, schema)


def _best_value(sizes: np.ndarray, values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack: the configuration of greatest total value that fits."""
    use = np.flatnonzero(values > 1e-12)
    best, choice = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    s, v = sizes[use], values[use]
    for c in range(1, capacity + 1):
        best[c] = best[c - 1]
        fits = s <= c
        if fits.any():
            gain = np.where(fits, best[np.maximum(c - s, 0)] + v, -1.0)
            j = int(gain.argmax())
            if gain[j] > best[c] + 1e-12:
                best[c], choice[c] = gain[j], j
    config, c = np.zeros(len(sizes)), capacity
    while c > 0:
        if choice[c] < 0:
            c -= 1
        else:
            config[use[choice[c]]] += 1
            c -= int(s[choice[c]])
    return float(best[capacity]), config


def configurations(sizes: list[int], demand: list[int], capacity: int) -> list[tuple[np.ndarray, float]]:
    """Configurations and how often to use each: the fractional optimum by column generation."""
    k = len(sizes)
    size, need = np.array(sizes), np.array(demand, float)
    basis = np.diag([float(capacity // s) for s in sizes])
    cost = np.ones(k)
    for _ in range(PRICING_STEPS):
        dual = np.linalg.solve(basis.T, cost)
        if (dual < -1e-9).any():  # more of that size than is asked for
            column, price = np.zeros(k), 0.0
            column[int(dual.argmin())] = -1
        else:
            value, column = _best_value(size, dual, capacity)
            price = 1.0
            if value <= 1 + PRICING_GAP:
                break
        amount, step = np.linalg.solve(basis, need), np.linalg.solve(basis, column)
        ratio = np.where(step > 1e-9, amount / np.where(step > 1e-9, step, 1), np.inf)
        out = int(ratio.argmin())
        basis[:, out], cost[out] = column, price
    amount = np.linalg.solve(basis, need)
    return [(basis[:, j], float(amount[j])) for j in range(k) if cost[j] > 0 and amount[j] > 1e-9]


class _Plan:
    """Entries made so far, and the sequences that have space, by space."""

    def __init__(self, capacity: int):
        self.capacity, self.sequences, self.entries = capacity, 0, []
        self.rank: dict[int, int] = defaultdict(int)
        self.space: dict[int, list[tuple[int, int]]] = defaultdict(list)
        self.sorted: list[int] = []

    def place(self, length: int, count: int, sequence: int, each: int, offset: int) -> None:
        self.entries.append((length, self.rank[length], count, sequence, each, offset))
        self.rank[length] += count

    def leave(self, space: int, sequence: int, count: int) -> None:
        if count and space:
            if not self.space[space]:
                bisect.insort(self.sorted, space)
            self.space[space].append((sequence, count))

    def open(self, count: int) -> int:
        self.sequences += count
        return self.sequences - count

    def fill(self, config: np.ndarray, copies: int, groups: list[list[list[int]]]) -> None:
        """``copies`` sequences by a configuration, each slot with the group's actual lengths."""
        runs = [(self.open(copies), copies, 0)]
        for g in np.flatnonzero(config):
            for _ in range(int(round(config[g]))):
                after = []
                for first, n, used in runs:
                    while n and groups[g]:
                        length, left = groups[g][0]
                        take = min(n, left)
                        self.place(length, take, first, 1, used)
                        after.append((first, take, used + length))
                        first, n = first + take, n - take
                        groups[g][0][1] -= take
                        if not groups[g][0][1]:
                            groups[g].pop(0)
                    if n:
                        after.append((first, n, used))
                runs = after
        for first, n, used in runs:
            self.leave(self.capacity - used, first, n)

    def best_fit(self, length: int, count: int) -> None:
        while count:
            at = bisect.bisect_left(self.sorted, length)
            if at < len(self.sorted):
                space = self.sorted[at]
                first, n = self.space[space].pop()
                if not self.space[space]:
                    self.sorted.pop(at)
            else:
                space, each = self.capacity, self.capacity // length
                n = -(-count // each)
                first = self.open(n)
            each, offset = space // length, self.capacity - space
            full = min(n, count // each)
            if full:
                self.place(length, full * each, first, each, offset)
                self.leave(space - each * length, first, full)
                count -= full * each
            if full < n:
                rest = min(count, each)  # below ``each``: the last sequence is not filled up
                if rest:
                    self.place(length, rest, first + full, rest, offset)
                    self.leave(space - rest * length, first + full, 1)
                    count -= rest
                    full += 1
                self.leave(space, first + full, n - full)


def plan_packing(histogram: dict[int, int], capacity: int = CAPACITY, schemes: tuple = SCHEMES) -> tuple[list[Entry], int]:
    """Where the pieces of each length go, and the number of sequences: the best of the ``schemes``."""
    plans = [plan_scheme(histogram, capacity, large_from, n_groups) for large_from, n_groups in schemes]
    return min(plans, key=lambda x: x[1])


def plan_scheme(histogram: dict[int, int], capacity: int, large_from: int, n_groups: int) -> tuple[list[Entry], int]:
    """One run of the linear grouping scheme."""
    plan = _Plan(capacity)
    large = sorted(((n, c) for n, c in histogram.items() if large_from < n < capacity and c), reverse=True)
    total = sum(c for _, c in large)
    groups: list[list[list[int]]] = []
    if total:
        quota = -(-total // n_groups)
        room = 0
        for length, c in large:
            while c:
                if not room:
                    groups.append([])
                    room = quota
                take = min(c, room)
                groups[-1].append([length, take])
                c, room = c - take, room - take
        sizes: dict[int, int] = defaultdict(int)
        owner: dict[int, list[list[int]]] = defaultdict(list)
        for g in groups:  # groups that round up to the same length are one size
            sizes[g[0][0]] += sum(x[1] for x in g)
            owner[g[0][0]] += g
        order = sorted(sizes, reverse=True)
        groups = [owner[s] for s in order]
        for config, amount in configurations(order, [sizes[s] for s in order], capacity):
            if int(amount + 1e-6):
                plan.fill(config, int(amount + 1e-6), groups)
    left: dict[int, int] = defaultdict(int)
    for length, c in histogram.items():
        if length <= large_from or length >= capacity:
            left[length] += c
    for g in groups:
        for length, c in g:
            left[length] += c
    for length in sorted(left, reverse=True):
        plan.best_fit(length, left[length])
    return plan.entries, plan.sequences


def assign(pieces: DataFrame, capacity: int = CAPACITY, schemes: tuple = SCHEMES) -> DataFrame:
    """``pieces`` (of :func:`token_pieces`, materialised) with ``sequence_id`` and ``offset``.

    Pieces of one length are interchangeable; they are taken in the order of a hash, then doc_id,
    piece and content, so only identical rows can change places between runs.
    """
    spark = pieces.sparkSession
    counted = pieces.groupBy("length").agg(F.count("*").alias("n")).collect()  # at most ``capacity`` rows
    histogram = {r["length"]: r["n"] for r in counted}
    split = spark.createDataFrame([(n, -(-c // RANK_ROWS)) for n, c in histogram.items()], "length long, parts long")
    bucket = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.col("parts"))
    ordered = pieces.join(F.broadcast(split), "length").withColumn("bucket", bucket)
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    parts = ordered.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    starts = materialise(parts.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))))
    entries, _ = plan_packing(histogram, capacity, schemes)
    plan = spark.createDataFrame(entries, "length long, first long, n_placed long, sequence long, each long, at long")
    within = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32", "start")
    ranked = (
        ordered.withColumn("nth", F.row_number().over(within).cast("long") - 1)
        .join(starts.select("length", "bucket", "base"), ["length", "bucket"])  # a row for each part, so Spark broadcasts it while small
        .withColumn("rank", F.col("nth") + F.col("base"))
    )
    number = F.col("rank") - F.col("first")
    placed = ranked.join(F.broadcast(plan), "length").filter((number >= 0) & (number < F.col("n_placed")))
    return placed.select(
        *(F.col(c) for c in pieces.columns),
        (F.col("sequence") + F.floor(number / F.col("each"))).cast("long").alias("sequence_id"),
        (F.col("at") + (number % F.col("each")) * F.col("length")).cast("long").alias("offset"),
    )


def pack_documents(
    docs: DataFrame, doc_id: str, text: str, ranks: bytes, pattern: str, added: dict[str, int] | None = None, capacity: int = CAPACITY, with_ids: bool = False
) -> DataFrame:
    """Tokenise and pack: one row per piece with its place. Other columns of ``docs`` are not read.

    Repeated rows are packed once each; an empty table gives no rows.
    """
    with steps() as keep:
        pieces = materialise(token_pieces(docs, doc_id, text, ranks, pattern, added, capacity, with_ids=with_ids))
        return keep(assign(pieces, capacity))


def sequences(packed: DataFrame, pad_to: int | None = None, pad_id: int = 0) -> DataFrame:
    """``sequence_id, input_ids, piece_starts`` from pieces packed ``with_ids``.

    A group is one sequence, so at most ``capacity`` tokens whatever the corpus.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    out = packed.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id", F.flatten(F.col("parts.ids")).alias("input_ids"), F.col("parts.offset").alias("piece_starts")
    )
    if pad_to is not None:
        filler = F.array_repeat(F.lit(pad_id), F.lit(pad_to) - F.size("input_ids"))
        out = out.withColumn("input_ids", F.concat("input_ids", filler))
    return out
