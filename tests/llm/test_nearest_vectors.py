import numpy as np
from pyspark.sql import functions as F

from geomedallion.llm.nearest_vectors import KdTree, cell_of, chi2_quantile, nearest_neighbours, top_tree


def brute(rows, k, is_query):
    by_id = {}
    for i, v in rows:
        if i is not None and v and None not in v and np.isfinite(v).all() and any(v):
            by_id[i] = min(by_id.get(i, v), v)
    ids, x = np.array(list(by_id)), np.array(list(by_id.values()))
    out = {}
    for j in np.flatnonzero([is_query(i) for i in ids]):
        d = np.sqrt(((x - x[j]) ** 2).sum(1))
        d[j] = np.inf
        order = np.lexsort((ids, d))[: min(k, len(ids) - 1)]
        out[int(ids[j])] = [(int(ids[o]), d[o]) for o in order]
    return out


def answers(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
    return out


def test_chi_square_quantile():
    assert abs(chi2_quantile(0.95, 8) - 15.507) < 0.01 and abs(chi2_quantile(0.99, 2) - 9.210) < 0.01


def test_tree_leaves_come_in_order_and_hold_every_row():
    points = np.random.default_rng(1).standard_normal((900, 8))
    points[:200] = points[0]
    leaves = list(KdTree(points).leaves(points[5]))
    assert sorted(np.concatenate([rows for _, rows in leaves])) == list(range(900))
    reach = [r for r, _ in leaves]
    assert reach == sorted(reach)
    tree = top_tree(points, 3)
    assert set(cell_of(points, tree)) <= set(range(8)) and cell_of(points, top_tree(points, 0)).max() == 0


def test_recall_and_exact_distances_over_cells_parts_and_blocks(spark):
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((12, 24)) * 2
    rows = [(i, (centres[i % 12] + rng.standard_normal(24)).tolist()) for i in range(1500)]
    rows += [(2000 + i, rows[0][1]) for i in range(400)]  # one very common vector
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("v", F.lit(0)).withColumn("cell", F.lit("x"))
    got = answers(nearest_neighbours(df, F.col("vec_id") % 25 == 0, k=10, cell_rows=200, query_block=16))
    want = brute(rows, 10, lambda i: i % 25 == 0)
    assert set(got) == set(want)
    hits = sum(len({a for a, _ in got[q]} & {a for a, _ in want[q]}) for q in want)
    assert hits >= 0.97 * sum(map(len, want.values()))
    exact = {i: np.array(v) for i, v in rows}
    assert all(abs(np.sqrt(((exact[a] - exact[q]) ** 2).sum()) - s) < 1e-12 for q in got for a, s in got[q])
    assert [a for a, _ in got[0]] == list(range(2000, 2010))  # ties to the smaller id


def test_unusable_vectors_few_candidates_and_empty_table(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (100, [0.0, 0.0]), (200, None), (300, [1.0, None]), (400, [nan, 1.0]), (500, [inf, 1.0]), (600, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (7, [0.0, 1.0]), (7, [0.0, 1.0]), (700, []), (1, [1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = answers(nearest_neighbours(df, F.col("vec_id") % 100 == 0, k=10))
    assert got == {0: [(1, 0.0), (7, 2**0.5)]}
    assert nearest_neighbours(df.limit(0), F.col("vec_id") % 100 == 0).count() == 0
