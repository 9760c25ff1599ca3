import random

import numpy as np
from pyspark.sql import functions as F

from geomedallion.llm.quality_classifier import DIMS, OrdinalModel, fit, fit_ordinal, loss_and_gradient, score_documents, shape


def test_shapes():
    assert shape("Word12!!!") == "a0!+" and shape("ABC") == "Aa" and shape("%%%") == "%+"


def test_thresholds_are_ordered_and_grades_recovered():
    rng = np.random.default_rng(1)
    x = rng.standard_normal(3000)
    latent = 2 * x + rng.logistic(size=3000)
    grade = np.digitize(latent, [-2.0, 0.0, 1.5])
    rows = [(np.array([0, 1]), np.array([max(v, 0), max(-v, 0)])) for v in x]
    model = fit_ordinal(rows, grade, [0, 1, 2, 3])
    assert (np.diff(model.thresholds) > 0).all()
    assert np.abs(model.thresholds - [-2.0, 0.0, 1.5]).max() < 0.35 and abs(model.weights[0] - 2) < 0.4 and abs(model.weights[1] + 2) < 0.4
    p = model.probabilities(np.array([-5.0, 0.0, 5.0]))
    assert np.allclose(p.sum(1), 1) and (p >= 0).all()


def texts(rng, grade):
    good = ["house", "river", "green", "walk", "seven", "paper"]
    junk = ["%%%", "buy!!!", "zz", "|", "$$$"]
    return " ".join(rng.choice(good if rng.random() < (0.15, 0.55, 0.98)[grade] else junk) for _ in range(40))


def test_held_out_grades_and_rows_of_every_kind(spark):
    rng = random.Random(3)
    rows = [(i, texts(rng, i % 3)) for i in range(450)]
    rows += [(900, None), (901, ""), (902, "river " * 100_000), (903, "x"), (903, "x")]
    ratings = [(i, i % 3) for i in range(450) if i % 5] + [(1, 1), (7, None), (900, 0), (901, 0)]
    d = spark.createDataFrame(rows, "doc_id long, text string").withColumn("grade", F.lit("x")).withColumn("i", F.lit(0))
    model = fit(d, spark.createDataFrame(ratings, "doc_id long, grade int"))
    got = {}
    for r in score_documents(d, model).collect():
        assert 0 <= r.expected_grade <= 2 and len(r.tails) == 3 and abs(r.tails[0] - 1) < 1e-9 and r.tails[1] >= r.tails[2]
        got[r.doc_id] = r
    test = [i for i in range(450) if i % 5 == 0]
    assert sum(got[i].predicted_grade == i % 3 for i in test) >= 0.9 * len(test)
    assert got[900].expected_grade == got[901].expected_grade
    assert score_documents(d.limit(0), model).count() == 0


def test_constant_models(spark):
    d = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, grade int")
    assert score_documents(d, fit(d, none)).first().expected_grade == 0
    one = spark.createDataFrame([(1, 3)], "doc_id long, grade int")
    assert score_documents(d, fit(d, one)).first().expected_grade == 3
    assert OrdinalModel([0, 1], np.array([0.0])).probabilities(np.array([0.0])).tolist() == [[0.5, 0.5]]


def test_gradient_against_finite_differences():
    rng = np.random.default_rng(5)
    n, k = 60, 3
    owner = np.repeat(np.arange(n), 4)
    index, value, y = rng.integers(0, 12, 4 * n), rng.standard_normal(4 * n), rng.integers(0, k + 1, n)
    params = np.concatenate([np.zeros(DIMS), [-1.0], rng.standard_normal(k - 1) * 0.3])
    params[:12] = rng.standard_normal(12) * 0.5
    _, grad = loss_and_gradient(params, index, value, owner, y, k)
    for i in [*range(12), 500, DIMS, DIMS + 1, DIMS + 2]:
        up, down = params.copy(), params.copy()
        up[i] += 1e-5
        down[i] -= 1e-5
        slope = (loss_and_gradient(up, index, value, owner, y, k)[0] - loss_and_gradient(down, index, value, owner, y, k)[0]) / 2e-5
        assert abs(slope - grad[i]) < 1e-6, i
