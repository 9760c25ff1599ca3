import random
import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from geomedallion.llm import spelling_variants
from geomedallion.llm.queries import op11_spelling_variants
from geomedallion.llm.spelling_variants import count_words, near_pairs, variants


def is_near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(words, ratio=5):
    form, out = {}, {}
    for w, n in words.items():
        near = [v for v in words if is_near(w, v)]
        top = min(near, key=lambda v: (-words[v], v), default=None)
        form[w] = (top if top is not None and words[top] >= ratio * n else None, len(near))
    for w in words:
        root = w
        while form[root][0] is not None:
            root = form[root][0]
        f, k = form[w]
        out[w] = (f, root, words[w], k, words[f] if f is not None else None)
    return out


def collected(df):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("abé", min_size=3, max_size=3), min_size=1, max_size=12, unique=True), st.lists(st.text("abé", min_size=4, max_size=4), min_size=1, max_size=12, unique=True))
def test_near_pairs_of_tiles(short, long):
    found = {(short[i], long[j]) for i, j in zip(*near_pairs(short, long))}
    assert found == {(a, b) for a in short for b in long if is_near(a, b)}
    found = [frozenset((short[i], short[j])) for i, j in zip(*near_pairs(short))]
    assert len(found) == len(set(found)) and set(found) == {frozenset((a, b)) for a in short for b in short if is_near(a, b)}


@pytest.mark.parametrize("tile", [4, 2048])
def test_forms_and_roots_against_brute_force(spark, tile):
    rng = random.Random(3)
    stems = ["".join(rng.choice("abcdé") for _ in range(rng.randint(2, 8))) for _ in range(60)]
    words = Counter()
    for s in stems:
        words[s] += 5 ** rng.randint(1, 6)
        for _ in range(rng.randint(0, 6)):  # chains of errors, each rarer
            at = rng.randrange(len(s))
            s = rng.choice([s[:at] + s[at + 1 :], s[:at] + rng.choice("abcdé") + s[at:], s[:at] + rng.choice("abcdé") + s[at + 1 :]]) or "a"
            words[s] += rng.randint(1, 30)
    words["x" * 5000], words["x" * 4999], words["日本語"], words["日本人"] = 9, 50, 3, 3
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    assert collected(variants(df, tile=tile)) == brute(words)


def test_ties_nulls_repeated_rows_and_empty_tables(spark):
    rows = [("abcdef", 5), ("abcdeg", 25), ("abcdeh", 25), (None, 9), ("", 4), ("zzzzzz", None), ("abcdef", 0)]
    got = collected(variants(spark.createDataFrame(rows, "word string, n long")))
    assert got == {"abcdef": ("abcdeg", "abcdeg", 5, 2, 25), "abcdeg": (None, "abcdeg", 25, 2, None), "abcdeh": (None, "abcdeh", 25, 2, None),
                   "": (None, "", 4, 0, None), "zzzzzz": (None, "zzzzzz", 0, 0, None)}
    assert variants(spark.createDataFrame([], "word string, n long")).count() == 0


def words_by_hand(rows, drop_one_in=None):
    out = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if drop_one_in and h % drop_one_in == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 6:
                out[run] += 1
    return out


def test_words_of_whole_texts(spark, monkeypatch):
    monkeypatch.setattr(spelling_variants, "COUNTED", 3)  # handed on after every few words
    rng = random.Random(5)
    pieces = ["Straße", "STRASSE", "ÉCOLES", "écoles", "naïveté", "x", "日本語abcdefg", "a-bcdefgh", "ÿÿÿÿÿÿ", "Ÿabcdef", "×÷×÷×÷", "\n", "12abcdef34"]
    rows = [(i, " ".join(rng.choice(pieces) for _ in range(rng.choice([0, 3, 40])))) for i in range(80)]
    rows += [(None, "Abcdef abcdef"), (7, None), (8, ""), (9, "longer " * 50_000 + "w" * 100_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("word", F.lit(1)).withColumn("n", F.lit(2)).withColumn("key", F.lit(3))
    for drop in (None, 3):
        assert {r.word: r.n for r in count_words(df, drop_one_in=drop).collect()} == words_by_hand(rows, drop)
    assert count_words(df.limit(0)).count() == 0


def test_the_query_keeps_its_contract(spark, tmp_path):
    rows = [(i, f"Correct correct straßen Straßen {'corrcet ' * (i == 3)}") for i in range(400)] + [(900, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    out = op11_spelling_variants(spark, str(tmp_path))
    assert dict(out.dtypes) == {"word": "string", "form": "string", "root": "string", "n": "bigint", "n_near": "bigint", "form_n": "bigint"}
    assert collected(out) == brute({w: n for w, n in words_by_hand(rows, 199).items() if n >= 5})
