"""Operator 1: toxicity by a lexicon that tolerates misspelling, read in context.

Learning (on a bounded sample of labelled rows, ``FIT_DOCS``): document frequencies of whole words
and word beginnings (stems) by label give a lexicon of terms with log-odds weights. The terms form a
trie; the Levenshtein automaton of every term, intersected with the trie, is run as one automaton
whose deterministic states are made when a text first needs them. It reads each distinct word once
and gives the closest term within that term's edit budget (stems allow no edits).

Every hit has a context window of ``CONTEXT`` words on either side. Quotation marks around the hit, or a cue in
the window, make it a mention. Cues are learned: words that stand near hits in clean rows of the sample and hardly
in toxic ones. Sums of the weights of uses, misspelled uses and mentions are the inputs of a logistic regression, so
the labels also decide what a mention counts.

Scale: scoring is one pass over the whole texts, without a shuffle; the model (a few hundred terms)
travels with the tasks. Learning reads at most ``FIT_DOCS`` documents.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geomedallion.llm.common import fresh_name, in_arrow, materialise, steps

FIT_DOCS = 12_000
MAX_TERMS = 400
MIN_DOCS = 4  # toxic documents of the sample that hold a term, at least
MIN_SHARE = 0.015  # and this share of the toxic documents
MIN_WEIGHT = 2.0
STEMS = (4, 5, 6, 7)
CONTEXT = 6
MEMO_WORDS = 200_000
WORD = r"[^\W_]+"

MAX_CUES = 200
MIN_CUE_DOCS = 4  # clean documents of the sample with the cue near a hit, at least
MIN_CUE_SHARE = 0.05  # and this share of the clean documents that have hits
MIN_CUE_WEIGHT = 2.0

# Quotation marks.
OPEN_CLOSE = {'"': '"', "“": "”", "„": "“", "«": "»", "‹": "›", "‘": "’"}

HITS = "array<struct<start:bigint,end:bigint,term:string,edits:int,mention:boolean>>"


def edit_budget(term: str) -> int:
    """Edits allowed in a whole word; short words have too many neighbours."""
    return 0 if term.endswith("*") or len(term) < 5 else 1 if len(term) < 9 else 2


class LexiconAutomaton:
    """Levenshtein automata of all terms, intersected with the trie of the terms.

    A state is a set of (trie node, edits spent). Deterministic states are numbered as they are met.
    """

    def __init__(self, terms: list[str]):
        self.children: list[dict[str, int]] = [{}]
        self.word: dict[int, int] = {}  # node -> term that ends there
        self.stem: dict[int, int] = {}
        self.most = [0]  # greatest budget below a node
        self.budget = [edit_budget(t) for t in terms]
        for i, term in enumerate(terms):
            node, path = 0, [0]
            for c in term.rstrip("*"):
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.most.append(0)
                node = self.children[node][c]
                path.append(node)
            (self.stem if term.endswith("*") else self.word)[node] = i
            for n in path:
                self.most[n] = max(self.most[n], self.budget[i])
        self.numbers: dict[frozenset, int] = {}
        self.sets: list[dict[int, int]] = []
        self.next: list[dict[str, int]] = []
        self.final: list[tuple[int, int] | None] = []
        self.prefix: list[int | None] = []
        self.start = self._state({0: 0})

    def _state(self, nodes: dict[int, int]) -> int:
        """Number of a state, after letters of the terms that the text leaves out. -1: dead."""
        todo = list(nodes.items())
        while todo:
            node, e = todo.pop()
            if nodes[node] == e:
                for child in self.children[node].values():
                    if e + 1 <= self.most[child] and nodes.get(child, 99) > e + 1:
                        nodes[child] = e + 1
                        todo.append((child, e + 1))
        if not nodes:
            return -1
        key = frozenset(nodes.items())
        if key not in self.numbers:
            self.numbers[key] = len(self.sets)
            self.sets.append(nodes)
            self.next.append({})
            ends = [(e, self.word[n]) for n, e in nodes.items() if n in self.word and e <= self.budget[self.word[n]]]
            self.final.append(min(ends) if ends else None)
            self.prefix.append(next((self.stem[n] for n, e in nodes.items() if e == 0 and n in self.stem), None))
        return self.numbers[key]

    def _step(self, state: int, c: str) -> int:
        after: dict[int, int] = {}
        for node, e in self.sets[state].items():
            for x, child in self.children[node].items():
                cost = e + (x != c)
                if cost <= (self.most[child] if cost else 9) and after.get(child, 99) > cost:
                    after[child] = cost
            if e + 1 <= self.most[node] and after.get(node, 99) > e + 1:
                after[node] = e + 1
        return self._state(after)

    def match(self, word: str) -> tuple[int, int] | None:
        """(edits, term) of the closest term: a stem the word begins with, or a whole word."""
        state, stem = self.start, None
        for c in word:
            to = self.next[state].get(c)
            if to is None:
                to = self.next[state][c] = self._step(state, c)
            state = to
            if state < 0:
                break
            if self.prefix[state] is not None:
                stem = self.prefix[state]
        end = self.final[state] if state >= 0 else None
        if end is not None and (end[0] == 0 or stem is None):
            return end
        return (0, stem) if stem is not None else None


def _quoted(text: str, spans: list[tuple[int, int]]) -> list[bool]:
    """Whether each span lies between quotation marks of its line."""
    out, line_of = [], {}
    for a, b in spans:
        begin = text.rfind("\n", 0, a) + 1
        if begin not in line_of:
            end = text.find("\n", a)
            line = text[begin : end if end >= 0 else len(text)]
            ranges, closing, opened = [], None, 0
            for i, c in enumerate(line):
                if closing is None and c in OPEN_CLOSE:
                    closing, opened = OPEN_CLOSE[c], i
                elif c == closing:
                    ranges.append((begin + opened, begin + i))
                    closing = None
            line_of[begin] = ranges
        out.append(any(x < a and b <= y for x, y in line_of[begin]))
    return out


class Scanner:
    """Finds the hits of whole texts; one per task."""

    def __init__(self, terms: list[str], cues: list[str] | None = None):
        self.automaton = LexiconAutomaton(terms)
        self.cues = frozenset(cues or ())
        self.pattern = re.compile(WORD)
        self.memo: dict[str, tuple[int, int] | None] = {}

    def hits(self, text: str, near_words: set[str] | None = None) -> tuple[int, list[tuple[int, int, int, int, bool]]]:
        """Number of words; (start, end, term, edits, mention) of each hit. ``near_words`` gets the words of all windows
        outside quotation marks."""
        words = self.pattern.findall(text.lower())
        found, memo = {}, self.memo
        if len(memo) > MEMO_WORDS:
            memo.clear()
        for w in set(words):
            hit = memo.get(w, 0)
            if hit == 0:
                hit = memo[w] = self.automaton.match(w)
            if hit is not None:
                found[w] = hit
        if not found:
            return len(words), []
        tokens = [(m.start(), m.end(), m.group().lower()) for m in self.pattern.finditer(text)]
        at = [i for i, t in enumerate(tokens) if t[2] in found]
        quoted = _quoted(text, [tokens[i][:2] for i in at])
        out = []
        for i, q in zip(at, quoted):
            near = tokens[max(0, i - CONTEXT) : i] + tokens[i + 1 : i + 1 + CONTEXT]
            edits, term = found[tokens[i][2]]
            out.append((tokens[i][0], tokens[i][1], term, edits, q or any(t[2] in self.cues for t in near)))
            if near_words is not None and not q:
                near_words.update(t[2] for t in near if t[2] not in found)
        return len(words), out


@dataclass
class ToxicityModel:
    """Terms with their weights (exact and misspelled), the cues of a mention, and the regression over the hit sums."""

    terms: list[str] = field(default_factory=list)
    weight: list[float] = field(default_factory=list)
    fuzzy: list[float] = field(default_factory=list)
    beta: list[float] = field(default_factory=lambda: [-6.0] + [0.0] * 5)
    cues: list[str] = field(default_factory=list)

    def features(self, n_words: int, hits: dict[tuple[int, bool, bool], int]) -> list[float]:
        """``hits``: how often each (term, misspelled, mention) occurs."""
        use = near = mention = most = 0.0
        for (term, misspelled, quoted), n in hits.items():
            w = self.fuzzy[term] if misspelled else self.weight[term]
            if quoted:
                mention += w * n
            elif misspelled:
                near += w * n
            else:
                use += w * n
            if not quoted:
                most = max(most, w)
        return [1.0, float(np.log1p(use)), float(np.log1p(near)), float(np.log1p(mention)), most, (use + near) / (n_words + 20) ** 0.5]

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(x @ np.array(self.beta), -30, 30)))


def _summary(hits: list[tuple[int, int, int, int, bool]]) -> Counter:
    return Counter((term, edits > 0, mention) for _, _, term, edits, mention in hits)


def fit_rows(documents: DataFrame, labels: DataFrame, n: int = FIT_DOCS, label: str = "toxic") -> DataFrame:
    """``text, y`` of at most ``n`` labelled documents, spread by a hash of doc_id; copies count once.

    A document labelled more than once counts as toxic if one label says so; null labels are left out.
    """
    chosen = (
        labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
    )
    texts = documents.filter(F.col("text").isNotNull()).select(F.col("doc_id").alias("id"), "text")
    return texts.join(F.broadcast(chosen), F.col("id") == F.col("doc_id")).select("text", "y").dropDuplicates(["text"])  # <= n label rows


def _candidates(rows: DataFrame, n_toxic: int, n_clean: int) -> list[tuple[str, int, int]]:
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}\p{N}]+"), F.lit(0)))

    def stems_of(k: int) -> Column:
        return F.transform(F.filter(words, lambda w: F.length(w) >= k), lambda w: F.concat(F.substring(w, 1, k), F.lit("*")))

    terms = F.array_distinct(F.concat(F.filter(words, lambda w: F.length(w) >= 3), *(stems_of(k) for k in STEMS)))
    least = max(MIN_DOCS, int(np.ceil(MIN_SHARE * n_toxic)))
    weight = F.log((F.col("p") + 0.5) / (n_toxic + 1)) - F.log((F.col("n") + 0.5) / (n_clean + 1))
    found = (
        rows.select("y", F.explode(terms).alias("term")).groupBy("term")
        .agg(F.sum("y").alias("p"), F.sum(1 - F.col("y")).alias("n"))
        .filter((F.col("p") >= least) & (weight >= MIN_WEIGHT))
        .orderBy(F.desc(F.col("p") * weight), "term").limit(20 * MAX_TERMS)
    )
    return [(r["term"], r["p"], r["n"]) for r in found.collect()]  # at most 20 * MAX_TERMS rows


def choose_terms(candidates: list[tuple[str, int, int]], n_toxic: int, n_clean: int) -> tuple[list[str], list[float]]:
    """Best terms first.

    A stem gives way to a word or longer stem that is in nearly as many toxic documents (words tolerate
    misspelling, longer stems meet fewer clean words); a term that a chosen stem covers as surely is left out.
    """
    def log_odds(p: int, n: int) -> float:
        return float(np.log((p + 0.5) / (n_toxic + 1)) - np.log((n + 0.5) / (n_clean + 1)))

    chosen: dict[str, float] = {}
    purity = {t: p / (p + n) for t, p, n in candidates}
    best_below: dict[str, int] = defaultdict(int)  # most toxic documents of any longer term, by beginning
    for term, p, _ in candidates:
        bare = term.rstrip("*")
        for k in range(min(STEMS), len(bare) + (not term.endswith("*"))):
            best_below[bare[:k]] = max(best_below[bare[:k]], p)
    for term, p, n in candidates:
        bare = term.rstrip("*")
        if term.endswith("*") and best_below[bare] >= 0.95 * p:
            continue
        covers = [bare[:k] + "*" for k in range(min(STEMS), len(bare) + 1)]
        if any(c in chosen and c != term and purity[c] >= purity[term] - 0.02 for c in covers):
            continue
        chosen[term] = log_odds(p, n)
        if len(chosen) == MAX_TERMS:
            break
    return list(chosen), list(chosen.values())


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 30) -> np.ndarray:
    """Newton's method; the intercept is not penalised."""
    beta = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[0] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        grad = x.T @ (y - p) - penalty * beta
        hess = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        delta = np.linalg.solve(hess, grad)
        beta += delta
        if np.abs(delta).max() < 1e-8:
            break
    return beta


def mention_cues(rows: DataFrame, terms: list[str]) -> list[str]:
    """Words near hits that tell clean rows (``text, y``) from toxic ones, the most frequent first, at most ``MAX_CUES``."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(terms)
        for batch in batches:
            labels, near = [], []
            for y, text in zip(batch.column("y").to_pylist(), batch.column("text")):
                words: set[str] = set()
                if scanner.hits(text.as_py(), words)[1]:
                    labels.append(y), near.append(sorted(words))
            yield pa.RecordBatch.from_arrays([pa.array(labels, pa.int32()), pa.array(near, pa.list_(pa.string()))], names=["y", "near"])

    hit = materialise(rows.transform(in_arrow, scan, "y int, near array<string>"))
    total = {r["y"]: r["n"] for r in hit.groupBy("y").agg(F.count("*").alias("n")).collect()}
    n_toxic, n_clean = total.get(1, 0), total.get(0, 0)
    weight = F.log((F.col("n") + 0.5) / (n_clean + 1)) - F.log((F.col("p") + 0.5) / (n_toxic + 1))
    counts = hit.select("y", F.explode("near").alias("word")).groupBy("word").agg(F.sum("y").alias("p"), F.sum(1 - F.col("y")).alias("n"))
    least = max(MIN_CUE_DOCS, MIN_CUE_SHARE * n_clean)
    cues = counts.filter((F.col("n") >= least) & (weight >= MIN_CUE_WEIGHT)).orderBy(F.desc("n"), "word").limit(MAX_CUES)
    return [r["word"] for r in cues.collect()]


def fit(documents: DataFrame, labels: DataFrame, n: int = FIT_DOCS) -> ToxicityModel:
    """Learn terms, weights and regression. Without toxic or without clean rows: a constant model."""
    with steps():
        return _fit(materialise(fit_rows(documents, labels, n)))


def _fit(rows: DataFrame) -> ToxicityModel:
    count = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count("*").alias("n")).collect()}
    n_toxic, n_clean = count.get(1, 0), count.get(0, 0)
    if not n_toxic or not n_clean:
        return ToxicityModel(beta=[6.0 if n_toxic else -6.0] + [0.0] * 5)
    terms, weight = choose_terms(_candidates(rows, n_toxic, n_clean), n_toxic, n_clean)

    cues = mention_cues(rows, terms)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(terms, cues)
        for batch in batches:
            n_words, summaries = [], []
            for text in batch.column("text"):
                k, hits = scanner.hits(text.as_py())
                n_words.append(k)
                summaries.append([{"term": t, "misspelled": f, "mention": q, "n": c} for (t, f, q), c in _summary(hits).items()])
            kind = pa.list_(pa.struct([("term", pa.int32()), ("misspelled", pa.bool_()), ("mention", pa.bool_()), ("n", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch.column("y"), pa.array(n_words, pa.int64()), pa.array(summaries, kind)], names=["y", "n_words", "hits"])

    sample = rows.transform(in_arrow, scan, "y int, n_words long, hits array<struct<term:int,misspelled:boolean,mention:boolean,n:bigint>>").collect()  # <= n rows
    near: dict[int, list[int]] = defaultdict(lambda: [0, 0])
    for r in sample:
        for term in {h["term"] for h in r["hits"] if h["misspelled"]}:
            near[term][r["y"]] += 1
    fuzzy = [0.0] * len(terms)
    for term, (clean, toxic) in near.items():
        fuzzy[term] = max(0.0, float(np.log((toxic + 0.5) / (n_toxic + 1)) - np.log((clean + 0.5) / (n_clean + 1))))
    for term in range(len(terms)):
        if term not in near:  # no clean text comes near the term
            fuzzy[term] = 0.7 * weight[term]
    model = ToxicityModel(terms, weight, fuzzy, cues=cues)
    x = np.array([model.features(r["n_words"], {(h["term"], h["misspelled"], h["mention"]): h["n"] for h in r["hits"]}) for r in sample])
    model.beta = [float(b) for b in fit_logistic(x, np.array([r["y"] for r in sample], float))]
    for j in range(1, 6):  # a hit never speaks for a clean text
        if j != 3:
            model.beta[j] = max(model.beta[j], 0.0)
    return model


def score_documents(documents: DataFrame, model: ToxicityModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, score, hits`` of every row; ``hits`` has spans in code points.

    Null and empty texts have no hits and get the model's base score. Repeated rows are scored one by
    one, an empty table gives no rows, other columns are not read.
    """
    schema = T.StructType([T.StructField("doc_id", documents.schema[doc_id].dataType), T.StructField("score", T.DoubleType()), T.StructField("hits", T.DataType.fromDDL(HITS))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(model.terms, model.cues)
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("term", pa.string()), ("edits", pa.int32()), ("mention", pa.bool_())]))
        for batch in batches:
            x, spans = [], []
            for text in batch.column(1):
                n_words, hits = scanner.hits(text.as_py() or "")
                x.append(model.features(n_words, _summary(hits)))
                spans.append([{"start": a, "end": b, "term": model.terms[t], "edits": e, "mention": q} for a, b, t, e, q in hits])
            score = model.score(np.array(x).reshape(-1, 6))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score, pa.float64()), pa.array(spans, kind)], names=schema.names)

    return documents.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text")).transform(in_arrow, run, schema)


def drop_toxic(documents: DataFrame, model: ToxicityModel, text: str = "text", reject_from: float = 0.5) -> DataFrame:
    """``documents`` without those that score ``reject_from`` or more; rows keep all their columns."""
    body = fresh_name(documents.columns, "text_to_score")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(model.terms, model.cues)
        for batch in batches:
            x = []
            for text in batch.column(batch.num_columns - 1):
                n_words, hits = scanner.hits(text.as_py() or "")
                x.append(model.features(n_words, _summary(hits)))
            clean = model.score(np.array(x).reshape(-1, 6)) < reject_from
            yield batch.filter(pa.array(clean, pa.bool_())).select(range(batch.num_columns - 1))

    return documents.withColumn(body, F.col(f"`{text}`")).transform(in_arrow, run, documents.schema)
