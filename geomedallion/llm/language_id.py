"""Operator 10: language identification by cross-parsing.

A bounded sample of labelled text per language becomes a suffix automaton, which accepts exactly the
substrings of that text. A text is parsed against it: from each place the longest match is one phrase
(at least one symbol). A phrase costs ``log2`` of the sample's length, the price of a pointer into it;
the language with the least cost per symbol wins.

Symbols are lower-case letters, with every run of other characters as one blank. The whole text is
parsed, in segments of ``SEGMENT`` symbols which numpy advances side by side through all automata.

Each language has an alphabet of its own, its ``MAX_LETTERS`` most frequent letters; what is in none of a
language's sample is unseen to it, whatever other languages hold.

Scale: one pass over the whole texts without a shuffle. The model has ``FIT_SYMBOLS`` symbols per
language (fewer beyond ``MAX_SYMBOLS`` in all), so its size does not depend on the corpus. The automata are built once,
on the driver, from the sample, and broadcast as one table of two states a symbol at most.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geomedallion.llm.common import in_arrow

DOCS_PER_LANG = 400
FIT_SYMBOLS = 40_000
MAX_SYMBOLS = 400_000
MAX_LETTERS = 120  # of each language, by frequency in its sample
SEGMENT = 256
ROWS_AT_ONCE = 16_384  # segments advanced together, which bounds memory
BLANK, FIRST = 0, 1
UNKNOWN = "und"


def letter_table(letters: str) -> np.ndarray:
    """Code of every code point: 0 for what is no letter, 1.. for ``letters``, the last for others."""
    table = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000).astype(np.int32)
    table *= len(letters) + 1
    for i, c in enumerate(letters):
        table[ord(c)] = FIRST + i
    return table


def encode(text: str, table: np.ndarray) -> np.ndarray:
    """Symbols of a text; runs of blanks are one, none at the ends."""
    codes = table[np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)]
    if not len(codes):
        return codes
    keep = codes != BLANK
    keep[1:] |= codes[:-1] != BLANK
    codes = codes[keep]
    return codes[int(len(codes) > 0 and codes[0] == BLANK) : len(codes) - int(len(codes) > 1 and codes[-1] == BLANK)]


def suffix_automaton(symbols: np.ndarray) -> list[dict[int, int]]:
    """Transitions of the automaton of all substrings: row 0 is dead, row 1 the root."""
    size = 2 * len(symbols) + 2
    to = [{}, {}] + [None] * size
    link, length = [0] * (size + 2), [0] * (size + 2)
    last, count = 1, 2
    for c in symbols.tolist():
        cur = count
        count += 1
        to[cur], length[cur] = {}, length[last] + 1
        p = last
        while p and c not in to[p]:
            to[p][c] = cur
            p = link[p]
        if not p:
            link[cur] = 1
        else:
            q = to[p][c]
            if length[q] == length[p] + 1:
                link[cur] = q
            else:
                clone = count
                count += 1
                to[clone], length[clone], link[clone] = dict(to[q]), length[p] + 1, link[q]
                while p and to[p].get(c) == q:
                    to[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    return to[:count]


class LanguageModel:
    """The automata of all languages in one table, and the alphabets.

    ``letters`` are those of any language, the symbols of a text; ``local`` has the code of each symbol in each
    language: 0 for a blank, the last for a letter that the language does not have.
    """

    def __init__(self, langs: list[str], alphabets: list[str], samples: list[np.ndarray], letters: str | None = None):
        self.langs = langs
        self.letters = "".join(sorted(set("".join(alphabets)))) if letters is None else letters
        place = {c: i for i, c in enumerate(self.letters)}
        width = max(map(len, alphabets), default=0) + 2
        self.local = np.full((len(langs), len(self.letters) + 2), width - 1, np.int32)
        self.local[:, BLANK] = BLANK
        for k, alphabet in enumerate(alphabets):
            for i, c in enumerate(alphabet):
                self.local[k, FIRST + place[c]] = FIRST + i
        rows: list[dict[int, int]] = []
        self.root = np.zeros(len(langs), np.int32)
        starts, cells = [], []
        for k, sample in enumerate(samples):  # one after the other: each is far larger as dictionaries than as a table
            automaton = suffix_automaton(self.local[k][sample])
            base = sum(starts)
            self.root[k] = base + 1
            table = np.zeros((len(automaton), width), np.int32)
            for state, edges in enumerate(automaton):
                for c, x in edges.items():
                    table[state, c] = x + base
            starts.append(len(automaton))
            cells.append(table)
        self.to = np.concatenate(cells) if cells else np.zeros((0, width), np.int32)
        self.to[:, width - 1] = 0
        self.price = np.log2([len(s) + 1 for s in samples]) if samples else np.zeros(0)


class Parser:
    """Phrase counts of many segments against all languages; one per task."""

    def __init__(self, model: LanguageModel):
        self.table, self.local = letter_table(model.letters), model.local
        self.root, self.to, self.price = model.root, model.to, model.price
        first = self.to[self.root[:, None], self.local]  # (language, symbol)
        self.unseen = first == 0
        self.restart = np.where(self.unseen, self.root[:, None], first).astype(np.int32)

    def phrases(self, segments: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """(language, segment) phrase counts; rows of ``segments`` from the longest to the shortest."""
        n = len(lengths)
        root = self.root[:, None]
        state = np.repeat(root, n, axis=1)
        count = np.zeros((len(self.root), n), np.int32)
        active = np.searchsorted(-lengths, -np.arange(segments.shape[1]), side="left")  # rows longer than t
        for t in range(segments.shape[1]):
            k = int(active[t])
            if not k:
                break
            s, now = segments[:k, t], state[:, :k]
            after = self.to[now, self.local[:, s]]
            ended = after == 0
            count[:, :k] += ended & (now != root)
            count[:, :k] += self.unseen[:, s]
            state[:, :k] = np.where(ended, self.restart[:, s], after)
        return count + (state != root)

    def costs(self, texts: list[str]) -> np.ndarray:
        """(text, language) cost per symbol; rows of texts without letters are nan."""
        out = np.zeros((len(texts), len(self.root)))
        total = np.zeros(len(texts))
        waiting: list[np.ndarray] = []
        owner: list[int] = []

        def flush() -> None:
            if waiting:
                lengths = np.array([len(w) for w in waiting])
                order = np.argsort(-lengths, kind="stable")
                lengths = lengths[order]
                block = np.zeros((len(waiting), lengths[0]), np.int32)
                for i, j in enumerate(order):
                    block[i, : lengths[i]] = waiting[j]
                np.add.at(out, np.array(owner)[order], self.phrases(block, lengths).T * self.price)
                waiting.clear()
                owner.clear()

        for i, text in enumerate(texts):
            codes = encode(text, self.table)
            total[i] = len(codes) if (codes != BLANK).any() else 0
            for a in range(0, len(codes) if total[i] else 0, SEGMENT):
                waiting.append(codes[a : a + SEGMENT])
                owner.append(i)
                if len(waiting) == ROWS_AT_ONCE:
                    flush()
        flush()
        with np.errstate(invalid="ignore", divide="ignore"):
            return out / np.where(total > 0, total, np.nan)[:, None]


def fit(rows: DataFrame, lang: str = "lang", text: str = "text", doc_id: str = "doc_id") -> LanguageModel:
    """Learn from a sample of at most ``DOCS_PER_LANG`` different texts per language, by a hash of the id.

    Rows without language or text are left out; repeated rows weigh once; ties of frequent letters go by code point. The sample of a language is cut at its share of
    symbols, in equal parts per document first, so that many documents are represented.
    """
    known = rows.filter(F.col(lang).isNotNull() & F.col(text).isNotNull())
    order = Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id")
    ids = known.select(F.col(doc_id).alias("id"), F.col(lang).alias("lang")).withColumn("n", F.row_number().over(order)).filter(F.col("n") <= DOCS_PER_LANG)
    texts = known.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    part = F.substring("text", 1, FIT_SYMBOLS)  # of the sample only: no more can be used of one document
    sample = texts.join(F.broadcast(ids.select("id", "lang")), "id").select("lang", part.alias("text")).distinct()  # few rows per language
    size = {r["lang"]: r["n"] for r in known.groupBy(F.col(lang).alias("lang")).agg(F.count("*").alias("n")).collect()}  # a row per language
    by_lang: dict[str, list[str]] = {}
    for r in sorted(sample.collect(), key=lambda r: (r["lang"], r["text"])):
        by_lang.setdefault(r["lang"], []).append(r["text"])
    share = min(FIT_SYMBOLS, MAX_SYMBOLS // max(len(by_lang), 1))
    order_of = sorted(by_lang.items(), key=lambda x: (-size[x[0]], x[0]))
    alphabets = []
    for _, ts in order_of:
        seen = Counter(c for t in ts for c in t.lower() if c.isalpha())
        alphabets.append("".join(sorted(c for c, _ in sorted(seen.items(), key=lambda x: (-x[1], x[0]))[:MAX_LETTERS])))
    letters = "".join(sorted(set("".join(alphabets))))
    table, blank = letter_table(letters), np.zeros(1, np.int32)
    langs, own, samples = [], [], []
    for (name, ts), alphabet in zip(order_of, alphabets):
        codes = [c for c in (encode(t, table) for t in ts) if (c != BLANK).any()]
        if codes:
            each = max(share // len(codes), 64)
            while sum(min(len(c), each) for c in codes) < share and each < max(len(c) for c in codes):
                each *= 2
            langs.append(name), own.append(alphabet)
            samples.append(np.concatenate([x for c in codes for x in (c[:each], blank)])[:share])
    return LanguageModel(langs, own, samples, letters)


def predict(documents: DataFrame, model: LanguageModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score`` of every row.

    ``und`` with score 0 for null texts, texts without a letter, and when no language was learned.
    ``score`` is the runner-up's share of the two least costs: 0.5 for a tie (the more frequent language wins),
    towards 1 the clearer the text; 1 if only one language is known. Repeated rows are scored one by one;
    an empty table gives no rows; other columns are not read.
    """
    schema = T.StructType([T.StructField("doc_id", documents.schema[doc_id].dataType), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        parser = Parser(model) if model.langs else None
        for batch in batches:
            lang, score = [UNKNOWN] * batch.num_rows, [0.0] * batch.num_rows
            if parser and batch.num_rows:
                costs = parser.costs([x.as_py() or "" for x in batch.column(1)])
                for i in np.flatnonzero(~np.isnan(costs[:, 0])):
                    order = np.argsort(costs[i], kind="stable")
                    lang[i] = model.langs[order[0]]
                    best, second = costs[i][order[0]], costs[i][order[1]] if len(order) > 1 else np.inf
                    score[i] = 1.0 if np.isinf(second) else float(second / (best + second))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64())], names=schema.names)

    return documents.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text")).transform(in_arrow, run, schema)
