"""Operator 9: benchmark decontamination by pigeonhole edit matching.

An item of ``n`` characters may differ from a passage by ``k = ERROR_RATE * n`` edits. Cut into
``k + 1`` pieces, at least one piece of it must stand in the passage unchanged. One Aho-Corasick
automaton finds all pieces of all items in a text; around each hit, Myers' bit-parallel distance
decides whether the whole item is there within its budget.

Items of under ``MIN_ITEM_CHARS`` characters have no budget: they match unchanged and as whole words. In
scripts written without blanks any two characters are a word boundary.

Texts and items are compared in lower case with everything but letters, digits and underscores
collapsed to one space, so line breaks and punctuation cost no edits.

Scale: one pass over the whole texts, no shuffle. Items travel with the tasks in blocks of about
``BLOCK_CHARS`` characters; a larger benchmark means more passes, not a larger broadcast.
"""

from __future__ import annotations

import bisect
import re
from collections import defaultdict
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geomedallion.llm.common import fresh_name, in_arrow, materialise

ERROR_RATE = 0.06
MIN_ITEM_CHARS = 20  # shorter items (normalised) match unchanged and as whole words
BLOCK_CHARS = 8_000_000
WORD = r"\w+"
# Thai, Lao, Myanmar, Khmer; kana; Han with its extensions.
UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3040-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff]")


def normalise(text: str) -> str:
    return " ".join(re.findall(WORD, text.lower()))


def error_budget(n: int) -> int:
    return int(ERROR_RATE * n) if n >= MIN_ITEM_CHARS else 0


def at_boundary(text: str, at: int) -> bool:
    """Whether no word of a normalised text runs across the place before character ``at``."""
    if not 0 < at < len(text):
        return True
    pair = text[at - 1 : at + 1]
    return " " in pair or UNSPACED.search(pair) is not None


def pieces(item: str) -> list[tuple[int, str]]:
    """(offset, piece) of the budget-plus-one nearly equal pieces of an item."""
    parts = error_budget(len(item)) + 1
    cuts = [len(item) * i // parts for i in range(parts + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def bit_masks(pattern: str) -> dict[str, int]:
    masks: dict[str, int] = defaultdict(int)
    for i, c in enumerate(pattern):
        masks[c] |= 1 << i
    return dict(masks)


def myers(masks: dict[str, int], m: int, text: str, anchored: bool = False) -> Iterator[int]:
    """After each character of ``text``: the fewest edits between the pattern and what ends there.

    The match may begin anywhere, or at the start of ``text`` if ``anchored``.
    """
    full, high = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score, carry = full, 0, m, int(anchored)
    for c in text:
        eq = masks.get(c, 0)
        xv = eq | minus
        xh = (((eq & plus) + plus) ^ plus) | eq
        up = minus | (full & ~(xh | plus))
        down = plus & xh
        if up & high:
            score += 1
        elif down & high:
            score -= 1
        up, down = (up << 1) | carry, down << 1
        plus = (down | ~(xv | up)) & full
        minus = up & xv & full
        yield score


class ItemMatcher:
    """Finds the items of one block in texts."""

    def __init__(self, items: list[str]):
        self.items = items
        self.masks = [bit_masks(x) for x in items]
        self.automaton = ahocorasick.Automaton()
        where: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for i, item in enumerate(items):
            for offset, piece in pieces(item):
                where[piece].append((i, offset))
        for piece, places in where.items():
            self.automaton.add_word(piece, (len(piece), places))
        self.automaton.make_automaton()

    def find(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item, edits, start, end) of each item's best passage in a normalised text."""
        if not self.items:
            return []
        starts: dict[int, set[int]] = defaultdict(set)
        for end, (length, places) in self.automaton.iter(text):
            for item, offset in places:
                starts[item].add(end + 1 - length - offset)
        out = []
        for item, places in starts.items():
            if best := self._verify(item, sorted(places), text):
                out.append((item, *best))
        return out

    def _verify(self, item: int, places: list[int], text: str) -> tuple[int, int, int] | None:
        pattern, masks = self.items[item], self.masks[item]
        m, k = len(pattern), error_budget(len(pattern))
        if m < MIN_ITEM_CHARS:  # one piece: the item stands at every place
            return next(((0, a, a + m) for a in places if at_boundary(text, a) and at_boundary(text, a + m)), None)
        best: tuple[int, int, int] | None = None
        i = 0
        while i < len(places) and (best is None or best[0] > 0):
            begin, last = places[i], places[i]
            while i < len(places) and places[i] <= last + m:  # places that share a window are searched at once
                last = places[i]
                i += 1
            a, b = max(0, begin - k), last + m + k
            window = text[a:b]
            at = window.find(pattern)
            if at >= 0:
                return 0, a + at, a + at + m
            least, end = min(((s, j) for j, s in enumerate(myers(masks, m, window))), default=(k + 1, 0))
            if least <= k and (best is None or least < best[0]):
                back = myers(bit_masks(pattern[::-1]), m, window[: end + 1][::-1], anchored=True)
                length = next(j + 1 for j, s in enumerate(back) if s == least)
                best = (least, a + end + 1 - length, a + end + 1)
        return best


def _original_span(text: str, start: int, end: int) -> tuple[int, int]:
    """The span of ``text`` that a span of its normal form stands for (whole words of it)."""
    lower = text.lower()
    words = list(re.finditer(WORD, lower))
    at, places = 0, []
    for w in words:
        places.append(at)
        at += w.end() - w.start() + 1
    first = words[bisect.bisect_right(places, start) - 1].start()
    last = words[bisect.bisect_right(places, max(end - 1, start)) - 1].end()
    if len(lower) == len(text):
        return first, last
    source = [i for i, c in enumerate(text) for _ in c.lower()]  # a capital can become two characters
    return source[first], source[last - 1] + 1


def item_blocks(benchmark: DataFrame, item_id: str, text: str, block_chars: int = BLOCK_CHARS) -> Iterator[tuple[dict[str, list], bool]]:
    """Blocks of {normalised text: item ids}, and whether there are several; the driver collects one at a time, of
    about ``block_chars`` characters."""
    items = benchmark.filter(F.col(f"`{text}`").isNotNull()).select(F.col(f"`{item_id}`").alias("item"), F.col(f"`{text}`").alias("text"))
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = int(total // block_chars) + 1
    for b in range(n):
        block: dict[str, list] = {}
        for r in items.filter(F.pmod(F.xxhash64("text"), F.lit(n)) == b).collect():  # about block_chars characters
            key = normalise(r["text"])
            if key:
                block.setdefault(key, []).append(r["item"])
        if block:
            yield block, n > 1


def find_leaks(documents: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``doc_id, item_id, edits, start, end`` for every document and item it holds a passage of.

    The passage is the best one (fewest edits, then the first); its span is in code points of the
    text. Null and empty texts hold nothing, items without a letter or digit match nothing. Items with the same normal form are all reported.
    Repeated rows are reported each; without items or documents there are no rows.
    """
    schema = T.StructType([
        T.StructField("doc_id", documents.schema[doc_id].dataType), T.StructField("item_id", benchmark.schema[item_id].dataType),
        T.StructField("edits", T.IntegerType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
    ])
    docs = documents.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    out = documents.sparkSession.createDataFrame([], schema)
    item_type = pa.int64() if isinstance(schema["item_id"].dataType, T.LongType) else pa.int32() if isinstance(schema["item_id"].dataType, T.IntegerType) else pa.string()
    for block, several in item_blocks(benchmark, item_id, item_text, block_chars):

        def run(batches: Iterator[pa.RecordBatch], block: dict = block) -> Iterator[pa.RecordBatch]:
            matcher, ids = ItemMatcher(list(block)), list(block.values())
            for batch in batches:
                row, item, edits, start, end = [], [], [], [], []
                for i, body in enumerate(batch.column(1)):
                    body = body.as_py() or ""
                    for k, e, a, b in matcher.find(normalise(body)):
                        a, b = _original_span(body, a, b)
                        for x in ids[k]:
                            row.append(i), item.append(x), edits.append(e), start.append(a), end.append(b)
                columns = [batch.column(0).take(pa.array(row, pa.int64())), pa.array(item, item_type), pa.array(edits, pa.int32()), pa.array(start, pa.int64()), pa.array(end, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "item_id", "edits", "start", "end"])

        found = docs.transform(in_arrow, run, schema)
        out = out.union(materialise(found) if several else found)  # written: the plan then holds no block
    return out


def drop_leaks(documents: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``documents`` without those that hold a passage of an item; rows keep all their columns."""
    flag = fresh_name(documents.columns, "text_to_match")
    for block, several in item_blocks(benchmark, item_id, item_text, block_chars):

        def run(batches: Iterator[pa.RecordBatch], block: dict = block) -> Iterator[pa.RecordBatch]:
            matcher = ItemMatcher(list(block))
            for batch in batches:
                clean = [not matcher.find(normalise(body.as_py() or "")) for body in batch.column(batch.num_columns - 1)]
                kept = batch.filter(pa.array(clean, pa.bool_()))
                yield kept.select(range(batch.num_columns - 1))

        clean = documents.withColumn(flag, F.col(f"`{text}`")).transform(in_arrow, run, documents.schema)
        documents = materialise(clean) if several else clean
    return documents
