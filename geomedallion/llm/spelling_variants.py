"""Operator 11: spelling variants by blocked Gram matrices of letter counts.

Two words are near if they differ by exactly one inserted, deleted or replaced code point. One such edit
moves the vector of letter counts by a squared distance of 1 (adjacent lengths) or 2 (equal lengths), so:

1. words are counted in the tasks first and summed by word;
2. every word gets a block key: its length and how many of its letters fall into each of a few letter classes.
   One edit changes the length by one at most and the class counts by one letter, so all near words of a block
   lie in the block itself and in a few adjacent ones, equal in length or one longer;
3. blocks are packed into tiles of at most ``TILE`` words, and each pair of adjacent tiles becomes one row;
4. a NumPy product of the two tiles' letter counts gives all squared distances at once; pairs at two or less
   are verified position by position;
5. each word follows its form, the near word of largest count, to the last by pointer doubling.

Scale: a tile pair is at most ``2 * TILE`` words, whatever the size of a block, so no task holds a block. Blocks
of common keys become more tiles; only adjacent tiles meet. Nothing but the letter classes (one row a letter)
comes to the driver.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geomedallion.llm.common import in_arrow, materialise, steps

MIN_LETTERS, MIN_COUNT, RATIO = 6, 5, 5
CLASSES = 5  # letter classes of the block key
TILE = 2048  # words in a tile
TILE_LETTERS = 1 << 18  # and their letters together, about: tiles of very long words hold fewer
COUNTED = 200_000  # words that a task counts before it hands them on
LATIN = re.compile(rb"[a-z\xc0-\xff]+")  # on Latin-1 bytes in lower case: A-Z, a-z and U+00C0 to U+00FF


def count_words(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_letters: int = MIN_LETTERS, drop_one_in: int | None = None) -> DataFrame:
    """``word, n`` of the runs of Latin letters in whole texts, lower-cased in A-Z only.

    ``drop_one_in`` plants errors: where it divides h, the crc32 of ``<doc_id>:<run>``, the run loses its code
    point ``h % length``. Words under ``min_letters`` code points are left out afterwards. Null texts have no
    words and a null ``doc_id`` counts as an empty one; repeated rows count each time; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[bytes] = Counter()

        def hand_on() -> pa.RecordBatch:
            words = pa.array([w.decode("latin-1") for w in total], pa.string())
            out = pa.RecordBatch.from_arrays([words, pa.array(total.values(), pa.int64())], names=["word", "n"])
            total.clear()
            return out

        for batch in batches:
            for key, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                body = body.as_py()
                if not body:
                    continue
                # letters outside Latin-1 become "?", which is no letter; bytes.lower() maps A-Z alone
                found = Counter(LATIN.findall(body.encode("latin-1", "replace").lower()))
                start = zlib.crc32(f"{'' if key is None else key}:".encode())
                for word, n in found.items():
                    if drop_one_in:
                        h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), start)
                        if h % drop_one_in == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1 :]
                    if len(word) >= min_letters:
                        total[word] += n
                if len(total) >= COUNTED:
                    yield hand_on()
        yield hand_on()

    rows = docs.select(F.col(f"`{doc_id}`").cast("string").alias("key"), F.col(f"`{text}`").alias("text"))
    return rows.transform(in_arrow, run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def letter_classes(words: DataFrame, classes: int = CLASSES) -> list[str]:
    """Letters dealt into classes of about equal weight; letters past the 500 most frequent are in none."""
    letters = words.select(F.explode(F.split("word", "")).alias("letter")).filter(F.col("letter") != "")
    counts = letters.groupBy("letter").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "letter").limit(500).collect()
    weight, out = [0] * classes, [""] * classes
    for r in counts:
        at = weight.index(min(weight))
        weight[at] += r["n"]
        out[at] += r["letter"]
    return out


def _block_key(word: Column, classes: list[str]) -> Column:
    """Length, then the number of letters of each class but the last."""
    inside = [F.length(word) - F.length(F.translate(word, c, "")) if c else F.lit(0) for c in classes[:-1]]
    return F.array(F.length(word), *inside)  # a key is a few small numbers, whatever the word


def _adjacent(key: Column, classes: int) -> Column:
    """Keys that one edit can lead to: equal length with a letter moved between classes (or not), or one letter more.

    Of the two keys of an equal-length pair only the greater lists the lesser, so a pair is met once.
    """
    unit = [[0] * (classes - 1) for _ in range(classes)]
    for c in range(classes - 1):
        unit[c][c] = 1
    steps_ = [[0, *(y - x for x, y in zip(unit[a], unit[b]))] for a in range(classes) for b in range(classes)]
    down = sorted({tuple(s) for s in steps_ if tuple(s) <= tuple([0] * classes)})
    up = sorted({(1, *u) for u in unit})
    return F.array(*(F.array(*(key[i] + F.lit(v) for i, v in enumerate(s))) for s in [*down, *up]))


def _codes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points in one row per word, filled with zeros, and the lengths."""
    length = np.array([len(w) for w in words])
    table = np.zeros((len(words), length.max() + 1), np.uint32)
    table[np.arange(table.shape[1]) < length[:, None]] = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    return table, length


def _counts(table: np.ndarray, letters: np.ndarray) -> np.ndarray:
    at = np.searchsorted(letters, table)
    n = len(letters)
    flat = np.bincount((at + n * np.arange(len(table))[:, None]).ravel(), minlength=n * len(table))
    exact = np.float32 if table.shape[1] < 4000 else np.float64  # squares stay below 2**24, or 2**53
    return flat.reshape(len(table), n).astype(exact)[:, 1:]  # without the filling, the first letter


def near_pairs(left: list[str], right: list[str] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the near pairs of two tiles (or inside one): words of one length each, the right equal or one longer."""
    a, a_len = _codes(left)
    b, b_len = (a, a_len) if right is None else _codes(right)
    letters = np.unique(np.concatenate([a.ravel(), b.ravel()]))
    x, y = _counts(a, letters), _counts(b, letters)
    distance = (x * x).sum(1)[:, None] + (y * y).sum(1)[None, :] - 2 * (x @ y.T)
    close = distance <= 2.5
    i, j = np.nonzero(np.triu(close, 1) if right is None else close)
    if not len(i):
        return i, j
    a, b = a[i, : a_len[0]], b[j, : b_len[0]]
    if a_len[0] == b_len[0]:
        good = (a != b).sum(1) == 1
    else:  # all before some point agrees, and all after it agrees one place later
        before = np.cumprod(a == b[:, :-1], axis=1).sum(1)
        after = np.cumprod((a == b[:, 1:])[:, ::-1], axis=1).sum(1)
        good = before + after >= a_len[0]
    return i[good], j[good]


def near_words(words: DataFrame, classes: int = CLASSES, tile: int = TILE) -> DataFrame:
    """``word, near, near_n``: both directions of all near pairs of the distinct ``words`` (``word, n``; materialised)."""
    spread = letter_classes(words, classes)
    keyed = words.filter(F.length("word") > 0).select("word", "n", _block_key(F.col("word"), spread).alias("key"))
    room = F.greatest(F.lit(1), F.least(F.lit(tile), F.floor(F.lit(TILE_LETTERS) / F.col("key")[0])))
    sizes = keyed.groupBy("key").agg(F.count("*").alias("n")).select("key", F.ceil(F.col("n") / room).cast("int").alias("parts"))
    # the parts of a block differ in size by chance, so a tile can hold a little over ``tile`` words
    part = F.pmod(F.xxhash64("word"), F.col("parts")).cast("int")
    tiles = materialise(
        keyed.join(sizes, "key").groupBy("key", part.alias("part"))
        .agg(F.collect_list("word").alias("words"), F.collect_list("n").alias("ns"))
    )
    names = tiles.select("key", "part")
    other = names.toDF("key2", "part2")
    met = names.withColumn("key2", F.explode(_adjacent(F.col("key"), classes))).join(other, "key2")
    met = met.filter((F.col("key") != F.col("key2")) | (F.col("part2") <= F.col("part")))
    pairs = met.join(tiles, ["key", "part"]).join(tiles.toDF("key2", "part2", "words2", "ns2"), ["key2", "part2"])
    same = ((F.col("key") == F.col("key2")) & (F.col("part") == F.col("part2"))).alias("same")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for same_, words1, ns1, words2, ns2 in zip(*(c for c in batch.columns)):
                w1, n1, w2, n2 = (np.array(v.as_py(), t) for v, t in ((words1, object), (ns1, np.int64), (words2, object), (ns2, np.int64)))
                i, j = near_pairs(list(w1), None if same_.as_py() else list(w2))
                if len(i):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate([w1[i], w2[j]]), pa.string()), pa.array(np.concatenate([w2[j], w1[i]]), pa.string()),
                         pa.array(np.concatenate([n2[j], n1[i]]))], names=["word", "near", "near_n"])

    return pairs.select(same, "words", "ns", "words2", "ns2").transform(in_arrow, run, "word string, near string, near_n long", rows=16)


def last_forms(forms: DataFrame, keep) -> DataFrame:
    """``word, root`` of every row of ``forms`` (``word, form``): the end of its chain, by pointer doubling.

    Every form's count is a multiple of its word's, so chains are short and never close.
    """
    now = keep(forms.select("word", F.col("form").alias("root")))
    while True:
        step = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        after = keep(now.join(step, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        if after.filter("moved").isEmpty():
            return after.select("word", "root")
        now = after.select("word", "root")


def variants(words: DataFrame, ratio: int = RATIO, classes: int = CLASSES, tile: int = TILE) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every distinct word of ``words`` (``word, n``).

    The form is the near word of largest count (ties: the least in code-point order) if that count is at least
    ``ratio`` times the word's, else null; the root is the end of the chain of forms, the word itself without one.
    Repeated words add up; null words are left out, a null count is 0; an empty table gives no rows.
    """
    with steps() as keep:
        clean = words.filter(F.col("word").isNotNull()).groupBy("word").agg(F.sum(F.coalesce("n", F.lit(0))).alias("n"))
        words = materialise(clean)
        best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form"))).alias("best")
        near = near_words(words, classes, tile).groupBy("word").agg(F.count("*").alias("n_near"), best)
        known = words.join(near, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(-F.col("best.less") >= ratio * F.col("n"), F.struct(F.col("best.form").alias("form"), (-F.col("best.less")).alias("form_n"))).alias("up"),
        )
        known = materialise(known.select("word", "n", "n_near", F.col("up.form").alias("form"), F.col("up.form_n").alias("form_n")))
        roots = last_forms(known.filter(F.col("form").isNotNull()), materialise)
        out = known.join(roots, "word", "left").select(
            "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", F.col("form_n").cast("long").alias("form_n")
        )
        return keep(out)
