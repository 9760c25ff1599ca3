import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from geomedallion.llm.components import connected_components, merged_components
from geomedallion.llm.minhash_dedup import keep_one_of_each, near_duplicates


def shingles(text, n):
    w = (text or "").encode().lower().split()
    n = min(n, len(w))
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if w else frozenset()


def brute(rows, n, percent=80):
    sets = [shingles(t, n) for _, t in rows]
    top = list(range(len(rows)))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                top[find(i)] = find(j)
    least = defaultdict(lambda: 1 << 60)
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(least[find(i)], d)
    return sorted((d, len(sets[i]), least[find(i)]) for i, (d, _) in enumerate(rows))


def corpus(seed=0, family=150):
    """Texts alone, exact copies, and families of copies with more and more changes around one text."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)] + ["Ünï", "THE", "the", "a\x0bb", "x\x85y"]
    text = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    rows, ids = [], list(range(1000))
    rng.shuffle(ids)
    for base in (text(60), text(150)):
        for _ in range(family):
            w = list(base)
            for _ in range(rng.choice([0, 1, 2, 3, 4, 5, 6, 8])):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
            rows.append((ids.pop(), " ".join(w)))
    for _ in range(60):
        rows.append((ids.pop(), " ".join(text(rng.choice([1, 2, 3, 8, 40])))))
    rows += [(ids.pop(), t) for t in (None, "", " \t\n", "one", "ONE", "one ", "one two", "two one", "q " * 20_000, "q " * 15_000)]
    return rows + [rows[0], rows[1]]


@pytest.mark.parametrize("n_words", [2, 5])
def test_components_against_brute_force(spark, n_words):
    rows = corpus(n_words)
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("node", F.lit(1)).withColumn("key", F.lit("k"))
    got = near_duplicates(df, n_words=n_words, percent=80).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute(rows, n_words)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_keep_one_keeps_columns_and_one_of_each(spark):
    rows = corpus(9, family=40)
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("row", F.lit(1)).withColumn("id", F.lit("i")).withColumn("key", F.lit(2))
    extra = spark.createDataFrame([(None, "no id"), (None, "no id")], "doc_id long, text string").withColumn("row", F.lit(1)).withColumn("id", F.lit("i")).withColumn("key", F.lit(2))
    out = keep_one_of_each(df.union(extra), n_words=2)
    assert out.columns == df.columns
    kept = sorted(r.doc_id for r in out.collect() if r.doc_id is not None)
    assert kept == sorted({c for _, _, c in brute(rows, 2)})
    assert out.filter("doc_id is null").count() == 2


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert near_duplicates(df).count() == 0 and keep_one_of_each(df).count() == 0


def test_connected_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(101, 160)] + [(300, 299), (299, 300), (7, 7)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{x: 100 for x in range(100, 160)}, 299: 299, 300: 299}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_merged_components_agree_with_all_links_at_once(spark):
    rng = random.Random(4)
    links = [(rng.randrange(120), rng.randrange(120)) for _ in range(90)]
    frame = lambda x: spark.createDataFrame(x, "a long, b long")
    whole = {r.node: r.component for r in connected_components(frame(links)).collect()}
    parts = merged_components(connected_components(frame(links[:40])), frame(links[40:] + [(5, 5)]))
    got = {r.node: r.component for r in parts.collect()}
    assert {n: c for n, c in got.items() if n in whole} == whole and all(n == c for n, c in got.items() if n not in whole)
