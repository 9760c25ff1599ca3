"""Each query that no other test calls, on small tables: columns, types, splits and rows of its contract."""

import zlib

import numpy as np
from pyspark.sql import functions as F
from test_pipeline import fixture

from geomedallion.llm import queries as Q


def tables(spark, folder):
    docs, labels, bench = fixture()
    d = str(folder)
    spark.createDataFrame([tuple(x) for x in docs], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return docs, labels, bench, d


def held(i, n, r):
    return zlib.crc32(str(i).encode()) % n == r


def test_toxicity(spark, tmp_path):
    docs, labels, _, d = tables(spark, tmp_path)
    out = Q.op1_toxicity(spark, d)
    assert out.dtypes[:4] == [("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"), ("predicted", "int")]
    rows = out.collect()
    assert len(rows) == len(docs) and all(r.held_out == held(r.doc_id, 5, 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    got, truth = {r.doc_id: r.predicted for r in rows}, {i: t for i, _, t in labels}
    test = [i for i in truth if held(i, 5, 0)]
    assert sum(got[i] == truth[i] for i in test) >= 0.95 * len(test)


def test_quality(spark, tmp_path):
    docs, _, _, d = tables(spark, tmp_path)
    out = Q.op4_quality_classifier(spark, d)
    assert out.columns == ["doc_id", "held_out", "expected_grade", "predicted_grade", "tail_probability", "selected"]
    rows = out.collect()
    assert len(rows) == len(docs) and all(r.held_out == held(r.doc_id, 5, 0) and r.selected == (r.tail_probability >= 0.5) for r in rows)


def test_nearest_neighbours(spark, tmp_path):
    rng = np.random.default_rng(2)
    vectors = {i: rng.standard_normal(24).astype(np.float32) for i in range(350)}
    vectors[13] = vectors[100].copy()
    rows = [(i, v.tolist(), 0) for i, v in vectors.items()] + [(400, None, 0), (500, [0.0] * 24, 0), (600, [float("nan")] * 24, 0)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    out = Q.op6_nearest_neighbours(spark, str(tmp_path))
    assert out.dtypes[:4] == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "double")]
    got = {}
    for r in out.collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert sorted(got) == [0, 100, 200, 300]
    for q, found in got.items():
        v = vectors[q].astype(float)
        want = sorted((float(np.sqrt(((v - x.astype(float)) ** 2).sum())), i) for i, x in vectors.items() if i != q)[:10]
        assert [(k, i) for k, i, _ in sorted(found)] == [(k + 1, i) for k, (_, i) in enumerate(want)]
        assert np.allclose([s for _, _, s in sorted(found)], [s for s, _ in want])


def test_minhash(spark, tmp_path):
    docs, _, _, d = tables(spark, tmp_path)
    sets = {}
    for i, text, *_ in docs:
        w = (text or "").lower().split()
        sets[i] = set(zip(w, w[1:])) if len(w) > 1 else {tuple(w)} if w else set()
    out = Q.op7_minhash_near_dedup(spark, d)
    assert out.dtypes[:4] == [("doc_id", "bigint"), ("n_shingles", "bigint"), ("component_id", "bigint"), ("kept", "boolean")]
    rows = out.collect()
    top = {i: i for i in sets}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                top[y] = x
    assert len(rows) == len(docs)
    assert all((r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), find(r.doc_id), find(r.doc_id) == r.doc_id) for r in rows)


def test_decontamination(spark, tmp_path):
    docs, _, bench, d = tables(spark, tmp_path)
    out = Q.op9_benchmark_decontamination(spark, d)
    assert set(out.columns) >= {"doc_id", "item_id"}
    normal = lambda t: " ".join((t or "").lower().split())
    want = {(i, k) for i, text, *_ in docs for k, item in bench if item and normal(item) in normal(text)}
    assert {(r.doc_id, r.item_id) for r in out.select("doc_id", "item_id").collect()} == want and want
