import random
import zlib

import numpy as np

from geomedallion.llm.language_id import SEGMENT, LanguageModel, Parser, encode, fit, letter_table, predict
from geomedallion.llm.queries import op10_language_id


def phrases(symbols, sample):
    """Brute force: longest matches from left to right, in segments."""
    text, n = bytes(sample.tolist()), 0
    for a in range(0, len(symbols), SEGMENT):
        s = bytes(symbols[a : a + SEGMENT].tolist())
        i = 0
        while i < len(s):
            j = i + 1
            while j < len(s) and s[i : j + 1] in text and s[i : i + 1] in text:
                j += 1
            i, n = j, n + 1
    return n


def test_parser_counts_longest_matches():
    rng = random.Random(1)
    letters = "abcdeé"
    table = letter_table(letters)
    samples = [encode("".join(rng.choice(pool) for _ in range(900)), table) for pool in ("abc ", "bcde ", "é ab")]
    model = LanguageModel(["x", "y", "z"], [letters, "bcde", "aéb"], samples, letters)
    texts = ["".join(rng.choice("abcdeé ,ZQ1") for _ in range(n)) for n in (1, 5, 255, 256, 257, 1500)] + ["a b", "QQ", "é"]
    costs = Parser(model).costs(texts)
    for i, t in enumerate(texts):
        symbols = encode(t, table)
        if not (symbols > 0).any():
            assert np.isnan(costs[i]).all()
            continue
        for j, s in enumerate(samples):
            assert abs(costs[i, j] - phrases(symbols, s) * np.log2(len(s) + 1) / len(symbols)) < 1e-9


def test_encode_collapses_blanks():
    table = letter_table("ab")
    assert encode("  A1..b\n", table).tolist() == [1, 0, 2] and encode("123", table).tolist() in ([], [0]) and encode("", table).tolist() == []


def language(rng, syllables, n):
    return " ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(n))


def test_held_out_accuracy_and_rows_of_every_kind(spark):
    rng = random.Random(2)
    kinds = {"aa": ["ka", "lo", "mi", "su"], "bb": ["sch", "ung", "ein", "ber"], "cc": ["eau", "oi", "mi", "lle"]}
    rows = [(i, language(rng, kinds[k], rng.randint(8, 60)), k) for i in range(300) for k in [rng.choice(list(kinds))]]
    rows += [(900, None, "aa"), (901, "", "aa"), (902, "12 ...", None), (903, language(rng, kinds["bb"], 40_000), None), (0, "kalo", "aa")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = fit(df.filter("doc_id % 3 != 0"))
    assert sorted(model.langs) == ["aa", "bb", "cc"]
    got = {}
    for r in predict(df, model).collect():
        assert 0 <= r.score <= 1
        got.setdefault(r.doc_id, r.lang_pred)
    assert got[900] == got[901] == got[902] == "und" and got[903] == "bb"
    test = [(i, k) for i, _, k in rows if i < 300 and i % 3 == 0]
    assert sum(got[i] == k for i, k in test) >= 0.97 * len(test)
    assert predict(df.limit(0), model).count() == 0


def test_without_labels_and_with_one_language(spark):
    df = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    assert predict(df, fit(df)).first().lang_pred == "und"
    one = spark.createDataFrame([(1, "some text", "en"), (2, None, "de")], "doc_id long, text string, lang string")
    assert [(r.lang_pred, r.score) for r in predict(one, fit(one)).orderBy("doc_id").collect()] == [("en", 1.0), ("und", 0.0)]


def test_many_languages_of_large_alphabets(spark, monkeypatch):
    """Twenty languages of 400 letters each, most of them shared by none: every one keeps an alphabet of its own."""
    rng = random.Random(6)
    alphabets = {f"l{k:02}": [chr(0x4E00 + 400 * k + i) for i in range(400)] for k in range(20)}
    word = lambda k: "".join(rng.choice(alphabets[k][:60]) if rng.random() < 0.8 else rng.choice(alphabets[k]) for _ in range(rng.randint(1, 4)))
    rows = [(i, " ".join(word(k) for _ in range(30)), k) for i in range(400) for k in [f"l{i % 20:02}"]]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = fit(df.filter("doc_id % 40 < 20"))
    assert len(model.langs) == 20 and all((model.local[k] < model.to.shape[1] - 1).sum() == 121 for k in range(20))
    assert model.to.nbytes < 400e6
    got = {r.doc_id: r.lang_pred for r in predict(df, model).collect()}
    assert all(got[i] == k for i, _, k in rows)


def test_ties_go_to_the_more_frequent_language(spark):
    rows = [(i, "kalo mi kalo", "bb" if i % 3 else "aa") for i in range(9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert {(r.lang_pred, r.score) for r in predict(df, fit(df)).collect()} == {("bb", 0.5)}


def test_the_query_keeps_its_contract(spark, tmp_path):
    rng = random.Random(3)
    kinds = {"aa": ["ka", "lo", "mi", "su"], "bb": ["sch", "ung", "ein", "ber"]}
    rows = [(i, language(rng, kinds[k], 30), k) for i in range(120) for k in [rng.choice(list(kinds))]] + [(500, None, "aa"), (501, "..", "bb")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    out = op10_language_id(spark, str(tmp_path))
    assert out.dtypes == [("doc_id", "bigint"), ("held_out", "boolean"), ("lang_pred", "string"), ("score", "double")]
    got = {r.doc_id: r for r in out.collect()}
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) and got[i].lang_pred == (k if i < 500 else "und") for i, _, k in rows)
