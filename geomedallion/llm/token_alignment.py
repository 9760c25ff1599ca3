"""Operator 13: aligning the tokens of two tokenizers by diagonal run skipping.

Both tokenizers see the same bytes, a space and the text. A group ends where tokens of both end. Most groups hold
one token of each, so the aligner walks along a diagonal of the two arrays of token ends: at the current index
shift it compares stretches of doubling length and jumps over all ends that agree; where they part it steps
through the one irregular group token by token, which also gives the group's overlapping pairs, and goes on with
the shift that results.

Pairs of ids are counted over the corpus: in each task first, then summed by pair. Every document keeps its
distinct pairs with their multiplicity, so that the counts can be looked up without a second tokenisation.

Scale: no task holds more than a batch of documents and a tally of ``TALLY`` pairs. The most frequent pairs, at most
``HOT_PAIRS`` rows by a histogram of the counts, are broadcast; the links of all others are summed by an ordinary
join. The highest count of each id of the second vocabulary has at most as many rows as that vocabulary.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geomedallion.llm.best_fit_packing import byte_bpe
from geomedallion.llm.common import in_arrow, materialise, steps

TALLY = 500_000  # distinct pairs that a task counts before it hands them on
TALLY_ROW = 20_000  # pairs in one row of a tally
HOT_PAIRS = 500_000  # 17 bytes each
PROBE = 8  # ends compared at first
SHORT = 6  # ends compared one by one before that
ONES = [b"\1" * k for k in range(64)]
SHIFT = 32  # a pair is one long: the first id, then the second in so many bits


def one_to_one(a: list[int], b: list[int], i: int, j: int) -> int:
    """How many ends agree from ``i`` and ``j`` on: probes of doubling length, then of halving length."""
    at, step = 0, PROBE
    while a[i + at : i + at + step] == b[j + at : j + at + step] and i + at + step <= len(a) and j + at + step <= len(b):
        at, step = at + step, 2 * step
    while step > 1:
        step //= 2
        if (x := a[i + at : i + at + step]) == b[j + at : j + at + step] and len(x) == step:
            at += step
    return at


def align_ends(a: list[int], b: list[int]) -> tuple[bytearray, bytearray, list[int], list[int]]:
    """Marks of the tokens that end a group, on either side, and the pairs of token indices of irregular groups.

    ``a`` and ``b`` are the ends of non-empty tokens, increasing, with the same last end.
    """
    ends_a, ends_b = bytearray(len(a)), bytearray(len(b))
    left, right = [], []
    i = shift = 0
    while i < len(a):
        j = i + shift
        if a[i] == b[j]:
            run, least = 1, min(len(a) - i, len(b) - j, SHORT)
            while run < least and a[i + run] == b[j + run]:
                run += 1
            if run == SHORT:  # a long stretch
                run += one_to_one(a, b, i + run, j + run)
            ends_a[i : i + run] = ends_b[j : j + run] = ONES[run] if run < len(ONES) else b"\1" * run
            i += run
            continue
        while True:  # an irregular group
            left.append(i), right.append(j)
            if a[i] < b[j]:
                i += 1
            elif a[i] > b[j]:
                j += 1
            else:
                break
        ends_a[i] = ends_b[j] = 1
        shift, i = j - i, i + 1
    return ends_a, ends_b, left, right


class _Sides:
    """Both tokenizers with the bytes and the decimal text of every id."""

    def __init__(self, ranks: bytes, pattern: str, model: bytes):
        self.a = byte_bpe(ranks, pattern)
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        raw = [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode() for p in pieces]
        self.raw_a = _objects([self.a.decode_single_token_bytes(i) for i in range(self.a.n_vocab)])
        self.raw_b = _objects(raw)
        self.len_a, self.len_b = (np.array([len(x) for x in raw]) for raw in (self.raw_a, self.raw_b))
        # an id as the first of its side of a group, and further on as a later one
        self.text_a, self.text_b = (_objects([b"%s%d" % (mark, i) for mark in (first, b",") for i in range(n)]) for first, n in ((b";", len(self.raw_a)), (b"|", len(raw))))

    def encode(self, text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of both sides, or None if there is no text or the tokens do not give it back."""
        if not text:
            return None
        a = np.asarray(self.a.encode_to_numpy(" " + text, disallowed_special=()), np.int64)
        b = np.array(self.b.encode(text, num_threads=1), np.int64)
        whole = (" " + text).encode()
        if b"".join(self.raw_a[a].tolist()) != whole or b"".join(self.raw_b[b].tolist()) != whole:
            return None
        return a, b

    def aligned(self, text: str | None) -> tuple[int, int, int, bytes, np.ndarray, np.ndarray]:
        """Tokens of either side, groups, the groups as text, and the distinct linked pairs with their numbers."""
        if (ids := self.encode(text)) is None:
            return 0, 0, 0, b"", np.empty(0, np.int64), np.empty(0, np.int64)
        a, b = ids
        marks_a, marks_b, left, right = align_ends(np.cumsum(self.len_a[a]).tolist(), np.cumsum(self.len_b[b]).tolist())
        later_a, later_b = (np.frombuffer(b"\1" + m, bool)[:-1] ^ True for m in (marks_a, marks_b))  # not the first of their group
        end_a, end_b = (np.flatnonzero(np.frombuffer(m, bool)) + 1 for m in (marks_a, marks_b))
        size_a, size_b = np.diff(end_a, prepend=0), np.diff(end_b, prepend=0)
        # links: the irregular ones, and those of the groups of one token each
        single = (size_a == 1) & (size_b == 1)
        links = np.concatenate([(a[end_a[single] - 1] << SHIFT) | b[end_b[single] - 1], (a[left] << SHIFT) | b[right]])
        words = np.empty(len(a) + len(b), object)
        words[np.arange(len(a)) + np.repeat(end_b - size_b, size_a)] = self.text_a[a + len(self.raw_a) * later_a]
        words[np.arange(len(b)) + np.repeat(end_a, size_b)] = self.text_b[b + len(self.raw_b) * later_b]
        return len(a), len(b), len(end_a), b"".join(words.tolist())[1:], *np.unique(links, return_counts=True)


def _objects(values: list) -> np.ndarray:
    out = np.empty(len(values), object)
    out[:] = values
    return out


class _Tally:
    """Counts of pairs, merged now and then."""

    def __init__(self):
        self.parts, self.size = [], 0

    def add(self, pairs: np.ndarray, times: np.ndarray) -> None:
        self.parts.append((pairs, times))
        self.size += len(pairs)

    def merge(self) -> tuple[np.ndarray, np.ndarray]:
        pairs, back = np.unique(np.concatenate([p for p, _ in self.parts]), return_inverse=True)
        times = np.zeros(len(pairs), np.int64)
        np.add.at(times, back, np.concatenate([t for _, t in self.parts]))
        self.parts, self.size = [(pairs, times)], len(pairs)
        return pairs, times


COUNTED = ("n_a", "n_b", "n_groups", "n_links")


@lru_cache(maxsize=1)
def _sides(ranks: bytes, pattern: str, model: bytes) -> _Sides:
    return _Sides(ranks, pattern, model)  # once in a Python worker


def align_tokens(docs: DataFrame, doc_id: str, text: str, ranks: bytes, pattern: str, model: bytes, with_groups: bool = False) -> DataFrame:
    """One row per document, and rows without ``row`` that hold tallies of pairs.

    Columns: ``row`` (a number of its own for each row), ``doc_id``, ``COUNTED``, ``groups_sha256``, ``pairs``,
    ``times`` (and ``groups``). ``ranks`` and ``pattern`` are a byte-level BPE (A), ``model`` a piece BPE that adds
    a space itself (B). Special tokens' strings in a text are plain text. Texts that are null or empty, or that the
    tokens of either side do not give back, have no tokens. ``groups`` is ``a1,a2|b1;a3|b2,b3``: each group's ids.
    """
    fields = [T.StructField("row", T.LongType()), T.StructField("doc_id", docs.schema[doc_id].dataType)]
    fields += [T.StructField(c, T.LongType()) for c in COUNTED] + [T.StructField("groups_sha256", T.StringType())]
    fields += [T.StructField(c, T.ArrayType(T.LongType())) for c in ("pairs", "times")] + [T.StructField("groups", T.StringType())] * with_groups
    schema = T.StructType(fields)
    kinds = [*[pa.int64()] * 4, pa.string(), *[pa.list_(pa.int64())] * 2, *[pa.string()] * with_groups]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides, tally = _sides(ranks, pattern, model), _Tally()

        def frame(row: pa.Array, key: pa.Array, rest: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([row, key, *(pa.array(c, k) for c, k in zip(zip(*rest), kinds))], names=schema.names)

        def tallies(id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
            pairs, times = tally.merge()
            for at in range(0, len(pairs), TALLY_ROW):
                part = (*[None] * 5, pairs[at : at + TALLY_ROW], times[at : at + TALLY_ROW], *[None] * with_groups)
                yield frame(pa.nulls(1, pa.int64()), pa.nulls(1, id_type), [part])
            tally.__init__()

        id_type = None
        for batch in batches:
            out, id_type = [], batch.column(1).type
            for body in batch.column(2):
                n_a, n_b, n_groups, groups, pairs, times = sides.aligned(body.as_py())
                digest = hashlib.sha256(groups).hexdigest() if n_a else ""
                out.append((n_a, n_b, n_groups, n_a + n_b - n_groups, digest, pairs, times, *[groups.decode()] * with_groups))
                tally.add(pairs, times)
            if out:
                yield frame(batch.column(0), batch.column(1), out)
            if tally.size >= 4 * TALLY and len(tally.merge()[0]) >= TALLY:
                yield from tallies(id_type)
        if tally.parts:
            yield from tallies(id_type)

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return rows.transform(in_arrow, run, schema)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``pair, n, is_best`` over all tallies; best are the pairs whose count is the highest of their second id."""
    tallies = aligned.filter(F.col("row").isNull()).select(F.explode(F.arrays_zip("pairs", "times")).alias("x"))
    counts = materialise(tallies.groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.times").alias("n")))
    second = F.col("pair").bitwiseAND(F.lit((1 << SHIFT) - 1))
    highest = counts.groupBy(second.alias("second")).agg(F.max("n").alias("highest"))  # at most a row for each id
    joined = counts.join(F.broadcast(highest), second == F.col("second"))
    return materialise(joined.select("pair", "n", (F.col("n") == F.col("highest")).alias("is_best")))


def score_links(aligned: DataFrame, counts: DataFrame, hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """The documents of ``aligned`` with ``n_best`` and ``count_sum`` over their links."""
    spark = aligned.sparkSession
    sizes = counts.groupBy(F.floor(F.log2("n")).cast("int").alias("power")).agg(F.count("*").alias("rows")).collect()  # at most 64 rows
    least, room = 64, hot_pairs
    for r in sorted(sizes, key=lambda r: -r["power"]):
        if r["rows"] > room:
            break
        least, room = r["power"], room - r["rows"]
    is_hot = F.floor(F.log2("n")) >= least
    hot = counts.filter(is_hot).toArrow()  # at most hot_pairs rows
    order = np.argsort(hot.column("pair").to_numpy())
    shared = spark.sparkContext.broadcast(tuple(hot.column(c).to_numpy()[order] for c in ("pair", "n", "is_best")))
    kept = [c for c in aligned.columns if c not in ("pairs", "times")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, n, best = shared.value
        for batch in batches:
            lists, weights = batch.column("pairs"), batch.column("times").flatten().to_numpy()
            keys, doc = lists.flatten().to_numpy(), np.repeat(np.arange(len(batch)), lists.value_lengths().to_numpy())
            at = np.minimum(np.searchsorted(pair, keys), max(len(pair) - 1, 0))
            known = pair[at] == keys if len(pair) else np.zeros(len(keys), bool)
            n_best, count_sum = np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64)
            np.add.at(n_best, doc[known], weights[known] * best[at[known]])
            np.add.at(count_sum, doc[known], weights[known] * n[at[known]])
            split = np.searchsorted(doc[~known], np.arange(len(batch) + 1)).astype(np.int32)
            rest = [pa.ListArray.from_arrays(pa.array(split), pa.array(x[~known])) for x in (keys, weights)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(n_best), pa.array(count_sum), *rest], names=[*kept, "n_best", "count_sum", "pairs", "times"])

    added = [T.StructField(c, T.LongType()) for c in ("n_best", "count_sum")]
    schema = T.StructType([*(aligned.schema[c] for c in kept), *added, aligned.schema["pairs"], aligned.schema["times"]])
    scored = in_arrow(aligned.filter(F.col("row").isNotNull()).select(*kept, "pairs", "times"), run, schema)
    if all(r["power"] >= least for r in sizes):
        return scored.drop("pairs", "times")
    scored = materialise(scored)
    rest = scored.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("x")).join(counts.filter(~is_hot), F.col("x.pairs") == F.col("pair"))
    more = rest.groupBy("row").agg(
        F.sum(F.when(F.col("is_best"), F.col("x.times")).otherwise(0)).alias("more_best"), F.sum(F.col("x.times") * F.col("n")).alias("more_sum")
    )
    summed = [(F.col(c) + F.coalesce(m, F.lit(0))).alias(c) for c, m in (("n_best", "more_best"), ("count_sum", "more_sum"))]
    return scored.join(more, "row", "left").select(*kept, *summed)


def alignment(docs: DataFrame, doc_id: str, text: str, ranks: bytes, pattern: str, model: bytes, with_groups: bool = False, hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, groups_sha256, n_best, count_sum`` (and ``groups``) of every row of ``docs``.

    Links are the pairs of tokens whose bytes overlap; the count of a pair of ids is its number of links in all of
    ``docs``, ``n_best`` the links whose count no other pair of their second id exceeds, ``count_sum`` the counts
    summed over the links. Without tokens (see :func:`align_tokens`) all numbers are 0 and texts empty. Repeated
    rows stay and count each time; ``doc_id`` may be null; other columns are not read; an empty table gives no rows.
    """
    with steps() as keep:
        aligned = materialise(align_tokens(docs, doc_id, text, ranks, pattern, model, with_groups))
        return keep(score_links(aligned, pair_counts(aligned), hot_pairs).drop("row"))
