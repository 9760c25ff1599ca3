"""Operator 4: quality by ordinal cumulative-link regression on graded ratings.

``P(grade <= j) = logistic(threshold_j - w . x)``: one weight vector over hashed text features, shared by
all grades, and ordered thresholds between them. The expected grade ranks documents; the tail
probability (of the best grade, or of any grade and above) selects them.

Features: hashed words, hashed word shapes (letters, digits and marks by class, runs shortened) as a share of
the words, and bucketed ratios of the whole text (repeated neighbours, distinct words, repeated lines,
length). Fitting uses at most ``FIT_DOCS`` rated documents; scoring is one pass over the whole texts
without a shuffle.
"""

from __future__ import annotations

import operator
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geomedallion.llm.common import in_arrow

FIT_DOCS = 8_000
DIMS = 1 << 15
RATIOS = 64  # places kept at the end for bucketed ratios
STEPS, RATE, RIDGE = 250, 0.05, 2e-4
MEMO_WORDS = 200_000
CLASSES = ((re.compile(r"[^\W\d_]+"), "a"), (re.compile(r"\d+"), "0"), (re.compile(r"([^\w\s])\1+"), r"\1+"))


def shape(word: str) -> str:
    """``Word12!!!`` -> ``a0!+``; words in capitals are told apart."""
    upper = len(word) > 1 and word.isupper()
    for pattern, mark in CLASSES:
        word = pattern.sub(mark, word)
    return ("A" if upper else "") + word[:12]


class Features:
    """Sparse features of texts; one per task."""

    def __init__(self):
        self.memo: dict[str, tuple[int, int]] = {}

    def of(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        words = text.split()
        counts = Counter(words)
        n = len(words)
        if len(self.memo) > MEMO_WORDS:
            self.memo.clear()
        at = np.empty((len(counts), 2), np.int64)
        for i, w in enumerate(counts):
            places = self.memo.get(w)
            if places is None:
                bare = w.strip(".,;:!?\"'()").lower()
                places = self.memo[w] = (zlib.crc32(b"w" + bare.encode()) % (DIMS - RATIOS), zlib.crc32(b"s" + shape(w).encode()) % (DIMS - RATIOS))
            at[i] = places
        count = np.fromiter(counts.values(), float, len(counts))
        word, inverse = np.unique(at[:, 0], return_inverse=True)
        word_value = np.log1p(np.bincount(inverse, count, len(word)))
        form, inverse = np.unique(at[:, 1], return_inverse=True)
        form_value = 2 * np.sqrt(np.bincount(inverse, count, len(form)) / max(n, 1))
        if len(word):
            word_value /= np.sqrt((word_value**2).sum())
        lines = [x for x in text.split("\n") if x.strip()]
        ratios = (
            sum(map(operator.eq, words, words[1:])) / n if n else 0.0,
            len(counts) / n if n else 0.0,
            1 - len(set(lines)) / len(lines) if lines else 0.0,
            min(np.log10(len(text) + 1) / 6, 1.0),
        )
        bucket = [DIMS - RATIOS + 16 * i + min(int(r * 15), 15) for i, r in enumerate(ratios)]
        return np.concatenate([word, form, bucket]), np.concatenate([word_value, form_value, np.ones(len(bucket))])


@dataclass
class OrdinalModel:
    """Shared weights and ordered thresholds; ``grades`` are the grade values in order."""

    grades: list[int]
    thresholds: np.ndarray = field(default_factory=lambda: np.zeros(0))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(DIMS))

    def probabilities(self, score: np.ndarray) -> np.ndarray:
        """(text, grade) probabilities."""
        below = 1 / (1 + np.exp(-np.clip(self.thresholds[None, :] - score[:, None], -30, 30)))
        edges = np.concatenate([np.zeros((len(score), 1)), below, np.ones((len(score), 1))], axis=1)
        return np.diff(edges, axis=1)


def loss_and_gradient(params: np.ndarray, index: np.ndarray, value: np.ndarray, owner: np.ndarray, y: np.ndarray, k: int) -> tuple[float, np.ndarray]:
    """Mean negative log-likelihood with the ridge term, and its gradient.

    ``params``: ``DIMS`` weights, the first of the ``k`` thresholds, the logarithms of the steps to the others. Row
    ``owner`` has ``value`` at ``index`` and the grade number ``y``.
    """
    sigmoid = lambda x: 1 / (1 + np.exp(-np.clip(x, -30, 30)))
    w, steps = params[:DIMS], np.exp(params[DIMS + 1 :])
    theta = params[DIMS] + np.concatenate([[0.0], np.cumsum(steps)])
    score = np.bincount(owner, value * w[index], len(y))
    edge = sigmoid(np.concatenate([theta, [np.inf]])[y] - score)
    under = np.where(y > 0, sigmoid(theta[np.maximum(y - 1, 0)] - score), 0.0)
    p = np.maximum(edge - under, 1e-9)
    up, down = edge * (1 - edge) / p, under * (1 - under) / p  # by the upper and the lower threshold
    g_score = (up - down) / len(y)
    grad = np.zeros_like(params)
    grad[:DIMS] = np.bincount(index, value * g_score[owner], DIMS) + RIDGE * w
    g_theta = (np.bincount(y, down, k + 1)[1:] - np.bincount(y, up, k + 1)[:k]) / len(y)
    grad[DIMS] = g_theta.sum()
    if k > 1:
        grad[DIMS + 1 :] = np.cumsum(g_theta[::-1])[::-1][1:] * steps
    return float(-np.log(p).mean() + RIDGE / 2 * (w @ w)), grad


def fit_ordinal(rows: list[tuple[np.ndarray, np.ndarray]], grade: np.ndarray, grades: list[int]) -> OrdinalModel:
    """Maximum likelihood by Adam on all rows; thresholds are a first one and positive steps."""
    y = np.searchsorted(grades, grade)
    k = len(grades) - 1
    owner = np.repeat(np.arange(len(rows)), [len(i) for i, _ in rows])
    index, value = np.concatenate([i for i, _ in rows]), np.concatenate([v for _, v in rows])
    share = np.cumsum(np.bincount(y, minlength=k + 1))[:-1] / len(y)
    first = np.log(np.clip(share, 1e-3, 1 - 1e-3) / (1 - np.clip(share, 1e-3, 1 - 1e-3)))
    params = np.concatenate([np.zeros(DIMS), first[:1], np.log(np.maximum(np.diff(first), 1e-2))])
    m, v = np.zeros_like(params), np.zeros_like(params)
    for step in range(1, STEPS + 1):
        _, grad = loss_and_gradient(params, index, value, owner, y, k)
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        params = params - RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    theta = params[DIMS] + np.concatenate([[0.0], np.cumsum(np.exp(params[DIMS + 1 :]))])
    return OrdinalModel(list(grades), theta, params[:DIMS])


def fit(documents: DataFrame, ratings: DataFrame, n: int = FIT_DOCS) -> OrdinalModel:
    """Fit on at most ``n`` rated documents (``doc_id, grade``), by a hash of doc_id.

    Several ratings of a document count as their lower median; null grades are left out, null texts
    count as empty. With a single grade the model is constant, without any it has the one grade 0.
    """
    chosen = (
        ratings.filter(F.col("grade").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id")
        .agg(F.percentile_approx(F.col("grade").cast("int"), 0.5).alias("grade")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
    )
    texts = documents.select(F.col("doc_id").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = texts.join(F.broadcast(chosen), F.col("id") == F.col("doc_id")).select("grade", "text")  # <= n ratings

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in batches:
            found = [features.of(t.as_py()) for t in batch.column("text")]
            index = pa.array([i.astype(np.int32) for i, _ in found], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column("grade"), index, pa.array([v.astype(np.float32) for _, v in found], pa.list_(pa.float32()))], names=["grade", "i", "v"])

    table = rows.transform(in_arrow, run, "grade int, i array<int>, v array<float>").toArrow()  # <= n rows, sparse
    grade = np.array(table["grade"].to_pylist(), int)
    grades = sorted(set(grade.tolist()))
    if len(grades) < 2:
        return OrdinalModel(grades or [0])
    sparse = [(np.asarray(i.values), np.asarray(v.values, float)) for i, v in zip(table["i"], table["v"])]
    return fit_ordinal(sparse, grade, grades)


def score_documents(documents: DataFrame, model: OrdinalModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, expected_grade, predicted_grade, tails`` of every row.

    ``tails[j]`` is the probability of grade ``model.grades[j]`` or better. Null and empty texts are scored
    as texts without words. Repeated rows are scored one by one; an empty table gives no rows; other columns
    are not read.
    """
    schema = T.StructType([
        T.StructField("doc_id", documents.schema[doc_id].dataType), T.StructField("expected_grade", T.DoubleType()),
        T.StructField("predicted_grade", T.IntegerType()), T.StructField("tails", T.ArrayType(T.DoubleType())),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, grades = Features(), np.array(model.grades)
        for batch in batches:
            score = np.zeros(batch.num_rows)
            for i, body in enumerate(batch.column(1)):
                index, value = features.of(body.as_py() or "")
                score[i] = (model.weights[index] * value).sum()
            p = model.probabilities(score)
            tails = np.minimum(np.cumsum(p[:, ::-1], axis=1)[:, ::-1], 1.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(p @ grades, pa.float64()), pa.array(grades[p.argmax(1)], pa.int32()), pa.array(list(tails), pa.list_(pa.float64()))], names=schema.names
            )

    return documents.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text")).transform(in_arrow, run, schema)
