import random

from pyspark.sql import functions as F

from geomedallion.llm.toxicity import LexiconAutomaton, Scanner, ToxicityModel, drop_toxic, edit_budget, fit, score_documents

MODEL = ToxicityModel(["moron", "disgusting", "vile*", "scum"], [5.0] * 4, [4.0] * 4, [-5.0, 3.0, 2.0, 0.1, 0.5, 1.0])


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_automaton_agrees_with_the_edit_distance():
    rng = random.Random(3)
    terms = ["moron", "morose", "disgusting", "clown", "clo", "vile*", "abc*"]
    automaton = LexiconAutomaton(terms)
    words = ["".join(rng.choice("moronclwdisgutve") for _ in range(rng.randint(1, 11))) for _ in range(1500)]
    for t in terms:  # and words near the terms
        for _ in range(200):
            w = list(t.rstrip("*"))
            for _ in range(rng.randint(0, 3)):
                k = rng.randrange(len(w) + 1)
                w[k : k + rng.randint(0, 1)] = rng.choice(["", "x", "o"])
            words.append("".join(w))
    for w in words:
        near = [(distance(w, t), i) for i, t in enumerate(terms) if not t.endswith("*") and distance(w, t) <= edit_budget(t)]
        stems = [i for i, t in enumerate(terms) if t.endswith("*") and w.startswith(t[:-1])]
        got = automaton.match(w)
        if near and (min(near)[0] == 0 or not stems):
            assert got is not None and got[0] == min(near)[0]
        elif stems:
            assert got is not None and got[0] == 0 and got[1] in stems
        else:
            assert got is None, (w, got)


def test_quotation_is_told_from_abuse():
    _, hits = Scanner(MODEL.terms).hits('you moron! then they wrote nothing for a long while until "scum" was read aloud\nand much later in the day a scum')
    assert [(h[3], h[4]) for h in hits] == [(0, False), (0, True), (0, False)]


def test_rows_nulls_long_texts_and_spans(spark):
    rows = [(1, "such a m0ron"), (2, None), (3, ""), (4, "clean words " * 50_000), (5, "a b " * 30_000 + "scum scum disgustin"), (5, "a b " * 30_000 + "scum scum disgustin"), (None, "vileness")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("x")).withColumn("hits", F.lit(0))
    got = score_documents(df, MODEL).collect()
    assert len(got) == 7
    by = {r.doc_id: r for r in got}
    assert [(h.term, h.edits) for h in by[1].hits] == [("moron", 1)] and "such a m0ron"[by[1].hits[0].start : by[1].hits[0].end] == "m0ron"
    assert by[2].score == by[3].score < 0.01 and by[4].score == by[3].score
    assert len(by[5].hits) == 3 and by[5].score > 0.5 and by[None].hits[0].term == "vile*"
    assert score_documents(df.limit(0), MODEL).count() == 0
    kept = drop_toxic(df, MODEL)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [2, 3, 4]


def test_learning_finds_words_and_stems(spark):
    rng = random.Random(5)
    syllables = ["lo", "mi", "ra", "tu", "pe", "sen", "gor", "bal", "nek", "hul"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 4)))
    docs, labels = [], []
    for i in range(600):
        words = [word() for _ in range(40)]
        toxic = i % 5 == 0
        if toxic:
            words[rng.randrange(40)] = rng.choice(["blasted", "rotten", "zzurk" + rng.choice(syllables) + rng.choice(syllables)])
        docs.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    docs += [(9000, None)]
    labels += [(9000, 1), (0, None), (1, 0)]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    lab = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = fit(d, lab.filter("doc_id < 400"))
    assert "blasted" in model.terms and any(t.startswith("zzur") and t.endswith("*") for t in model.terms)
    got = {r.doc_id: r.score >= 0.5 for r in score_documents(d, model).collect()}
    wrong = [i for i, y in labels if 400 <= i < 600 and got[i] != bool(y)]
    assert len(wrong) <= 2


def test_learning_without_labels_gives_a_constant(spark):
    d = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert score_documents(d, fit(d, none)).first().score < 0.5
    ones = spark.createDataFrame([(1, 1)], "doc_id long, toxic int")
    assert score_documents(d, fit(d, ones)).first().score > 0.5


def test_learned_cues_tell_mentions_and_misspelled_uses_apart(spark):
    """Clean documents mention the terms after words of an invented language; toxic ones use them, also misspelled."""
    rng = random.Random(8)
    syllables = ["lo", "mi", "ra", "tu", "pe", "sen", "gor", "bal", "nek", "hul"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 4)))
    slurs, cues = ["blastedly", "rottenish"], ["vrakti", "ozumel"]

    def misspelled(w):
        k = rng.randrange(1, len(w) - 1)
        return w[:k] + rng.choice(["x", ""]) + w[k + 1 :]

    docs, labels, kind = [], [], {}
    for i in range(2400):
        words, k = [word() for _ in range(40)], i % 30
        at = rng.randrange(2, 38)
        if k < 6:
            words[at], kind[i] = rng.choice(slurs), "use"
        elif k < 9:
            words[at], kind[i] = misspelled(rng.choice(slurs)), "misspelled"
        elif k == 9:
            words[at], words[at - 1 - rng.randrange(2)], kind[i] = rng.choice(slurs), rng.choice(cues), "mention"
        elif k == 10 and i % 60 == 10:
            words[at], kind[i] = f'"{rng.choice(slurs)}"', "quoted"
        docs.append((i, " ".join(words)))
        labels.append((i, int(k < 9)))
    d, lab = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    model = fit(d, lab.filter("doc_id < 1600"))
    assert set(model.cues) == set(cues)
    got = {r.doc_id: (r.score >= 0.5, r.hits) for r in score_documents(d, model).collect()}
    for i in range(1600, 2400):
        toxic, hits = got[i]
        if kind.get(i) in ("mention", "quoted"):
            assert any(h.mention and docs[i][1][h.start : h.end] in slurs for h in hits)
    assert any(h.edits > 0 for i in range(1600, 2400) if kind.get(i) == "misspelled" for h in got[i][1])
    right = {k: [got[i][0] == (k in ("use", "misspelled")) for i in range(1600, 2400) if kind.get(i) == k] for k in ("use", "misspelled", "mention", "quoted", None)}
    assert all(sum(r) >= 0.95 * len(r) for r in right.values()), {k: sum(r) / len(r) for k, r in right.items()}
