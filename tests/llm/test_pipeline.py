import random
from collections import defaultdict

import public_tokenizers
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline

WORDS = [f"{a}{b}{c}" for a in "bdglmn" for b in "aeiou" for c in ("ra", "ti", "lo", "shen", "por")]
HEADER = "welcome to the site of many words"


def fixture():
    """Documents with toxic words, boilerplate, near copies, benchmark passages and odd rows."""
    rng = random.Random(11)
    line = lambda n: " ".join(rng.choice(WORDS) for _ in range(n))
    bench = [(i, line(30)) for i in range(5)] + [(9, None)]
    docs, labels = [], []
    for i in range(240):
        lines = [line(rng.randint(8, 30)) for _ in range(rng.randint(2, 6))]
        toxic = i % 6 == 0
        if toxic:
            lines[0] += " you " + rng.choice(["blasted", "rotten"])
        if i % 4 == 1:
            lines.insert(0, HEADER)
        if i % 20 == 3 and i < 100:  # five of some 140 pages, more than 1 percent and fewer than 5
            lines.append("this line is seen on few pages of the host")
        if i % 20 == 7:
            lines.insert(1, "so " + bench[i // 20 % 5][1] + " end")
        docs.append([i, "\n".join(lines), "en", f"s{i % 2}", 0])
        labels.append((i, 1, int(toxic)))
    # copies with at most one changed word; none of benchmark passages, which brute() only knows unchanged
    sources = [d for d in docs if d[0] % 6 and d[0] % 20 != 7 and len(d[1].split()) > 60]
    for i in range(240, 300):
        source = rng.choice(sources)
        words = source[1].split(" ")
        if i % 3:
            words[rng.randrange(len(words))] = rng.choice(WORDS)
        docs.append([i, " ".join(words), "en", source[3], 0])
    docs += [[400, None, None, None, None], [401, "", "en", "s0", 0], [402, "short", "en", "s1", 5], [402, "short", "en", "s1", 5]]
    docs += [[403, f"{HEADER}\nfew own words here\n{HEADER}", "en", "s1", 0]]  # loses more than half
    for d in docs:
        d[4] = len(d[1]) if d[1] is not None else None
    return docs, labels, bench


def brute(docs, bench):
    """The stages in plain Python: which documents stay, with which text."""
    rows = [(d[0], d[1], d[3]) for d in docs if not {"blasted", "rotten"} & set((d[1] or "").split())]
    cut = []
    for i, text, host in rows:
        if text is None:
            cut.append((i, text))
            continue
        own = [{x.strip() for x in (t or "").split("\n") if x.strip()} for t in {t for _, t, h in rows if h == host}]
        lines = text.split("\n")
        kept = [x for x in lines if not x.strip() or (n := sum(x.strip() in o for o in own)) < 5 or n <= 0.01 * len(own)]
        cut.append((i, "\n".join(kept) if any(map(str.strip, kept)) else text))
    sets = []
    for _, text in cut:
        w = (text or "").lower().split()
        n = min(5, len(w))
        sets.append({tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if w else set())
    top = list(range(len(cut)))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a in range(len(cut)):
        for b in range(a):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                if cut[y][0] <= cut[x][0]:
                    top[x] = y
                else:
                    top[y] = x
    stay = [c for k, c in enumerate(cut) if find(k) == k]
    normal = lambda t: " ".join((t or "").lower().split())
    return {i: t for i, t in stay if not any(b and b in normal(t) for _, b in bench)}


def test_pipeline_against_brute_force(spark, tmp_path):
    docs, labels, bench = fixture()
    d = str(tmp_path / "sf")
    spark.createDataFrame([tuple(x) for x in docs], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    want = brute(docs, bench)
    rows = corpus_pipeline.run(spark, d).collect()
    length, bins = defaultdict(int), defaultdict(list)
    for r in rows:
        length[r.doc_id] += r.length
        bins[r.sequence_id].append((r.offset, r.length))
    tokens = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert dict(length) == {i: len(tokens.encode(t or "", add_special_tokens=False).ids) + 1 for i, t in want.items()}
    for b in bins.values():
        at = 0
        for offset, n in sorted(b):
            assert offset == at
            at += n
        assert at <= 1024
    assert {400, 401, 402} <= set(length)
    assert not any(i % 6 == 0 or i % 20 == 7 for i in length if i < 240)  # toxic, leaked


def test_stages_keep_the_columns(spark, tmp_path):
    docs, labels, bench = fixture()
    d = str(tmp_path / "sf")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    frame = spark.createDataFrame([tuple(x) for x in docs], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, frame, d).columns == frame.columns
        assert stage(spark, frame.limit(0), d).count() == 0


def test_queries_are_registered_once_each():
    names = __spark_entry__.queries()
    for n in range(1, 14):
        assert len([x for x in names if x.startswith(f"op{n}_")]) == 1
    assert "pipeline" in names
