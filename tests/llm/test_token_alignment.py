import hashlib
import random
from collections import Counter

import pytest
import public_tokenizers
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from geomedallion.llm import token_alignment
from geomedallion.llm.common import piece_model, tokenizer
from geomedallion.llm.queries import op13_token_alignment
from geomedallion.llm.token_alignment import align_ends, alignment


@settings(max_examples=300, deadline=None)
@given(st.integers(1, 80).flatmap(lambda n: st.tuples(st.just(n), st.sets(st.integers(1, n)), st.sets(st.integers(1, n)), st.booleans())))
def test_ends_against_sets(case):
    n, a, b, alike = case
    a, b = sorted(a | {n}), sorted((a ^ {x for x in b if x % 17 == 0}) | {n} if alike else b | {n})
    ends_a, ends_b, left, right = align_ends(a, b)
    common = sorted(set(a) & set(b))
    assert [e for e, m in zip(a, ends_a) if m] == common == [e for e, m in zip(b, ends_b) if m]
    spans = lambda ends: list(zip([0, *ends], ends))
    links = {(i, j) for i, (s, e) in enumerate(spans(a)) for j, (t, f) in enumerate(spans(b)) if max(s, t) < min(e, f)}
    single = {(a.index(e), b.index(e)) for k, e in enumerate(common) if (s := [0, *common][k]) in (0, *a) and a.index(e) == (a.index(s) + 1 if s else 0) and b.index(e) == (b.index(s) + 1 if s else 0)}
    assert len(left) == len(set(zip(left, right))) and set(zip(left, right)) | single == links and not single & set(zip(left, right))


def sides():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [x for x in range(256) if x not in keep]
    byte = {chr(x): x for x in keep} | {chr(256 + k): x for k, x in enumerate(rest)}
    raw_a = {i: bytes(byte[c] for c in t) for t, i in a.get_vocab().items() if t != "<|endoftext|>"}
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    raw_b = {i: bytes([int(p[3:5], 16)]) if len(p := b.id_to_piece(i)) == 6 and p.startswith("<0x") else p.replace("▁", " ").encode() for i in range(32000)}
    return a, raw_a, b, raw_b


def brute(rows):
    enc_a, raw_a, enc_b, raw_b = sides()
    docs, count = [], Counter()
    for key, text in rows:
        a = enc_a.encode(" " + (text or ""), add_special_tokens=False).ids if text else []
        b = enc_b.encode(text) if text else []
        whole = (" " + (text or "")).encode()
        if not text or b"".join(raw_a[x] for x in a) != whole or b"".join(raw_b[x] for x in b) != whole:
            docs.append((key, 0, 0, [], []))
            continue
        owner = lambda ids, raw: [k for k, x in enumerate(ids) for _ in raw[x]]
        at_a, at_b = owner(a, raw_a), owner(b, raw_b)
        links = [(a[i], b[j]) for i, j in sorted(set(zip(at_a, at_b)))]
        cuts = [k for k in range(1, len(whole) + 1) if k == len(whole) or (at_a[k] != at_a[k - 1] and at_b[k] != at_b[k - 1])]
        groups = ["|".join(",".join(str(ids[i]) for i in dict.fromkeys(at[s:e])) for ids, at in ((a, at_a), (b, at_b))) for s, e in zip([0, *cuts], cuts)]
        count.update(links)
        docs.append((key, len(a), len(b), groups, links))
    top = Counter()
    for (_, y), n in count.items():
        top[y] = max(top[y], n)
    return sorted(((key, n_a, n_b, len(groups), len(links), sum(count[x] == top[x[1]] for x in links), sum(count[x] for x in links),
                    hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "") for key, n_a, n_b, groups, links in docs), key=str)


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def fixture():
    rng = random.Random(8)
    words = ["the", "ünïcode", "x" * 30, "42", "\n\n", "<|endoftext|>", "<s>", "</s>", "<unk>", "日本語", "  ", "naïveté", "🙂", " ", "don't", "Thlyouble", "\t", "é́"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.choice([1, 4, 60, 300])))) for i in range(60)]
    return rows + [(60, None), (61, ""), (62, "with ▁ inside"), (63, " "), (None, "no id"), (5, "the same id"), (5, "the same id"), (64, "long words " * 20_000)]


@pytest.mark.parametrize("hot,tally", [(500_000, 500_000), (40, 10), (0, 10)])
def test_documents_against_brute_force(spark, monkeypatch, hot, tally):
    monkeypatch.setattr(token_alignment, "TALLY", tally)
    rows = fixture()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).withColumn("row", F.lit(1)).withColumn("pairs", F.lit("x")).withColumn("n_a", F.lit(2))
    out = alignment(df, "doc_id", "text", *tokenizer("byte_bpe_50k.tiktoken"), piece_model("piece_bpe_32k.model"), hot_pairs=hot)
    assert sorted((tuple(r[c] for c in COLUMNS) for r in out.collect()), key=str) == brute(rows)


def test_groups_as_text_and_empty_table(spark):
    df = spark.createDataFrame([(1, "Thlyouble words")], "doc_id long, text string")
    args = (*tokenizer("byte_bpe_50k.tiktoken"), piece_model("piece_bpe_32k.model"))
    row = alignment(df, "doc_id", "text", *args, with_groups=True).first()
    assert hashlib.sha256(row.groups.encode()).hexdigest() == row.groups_sha256 and len(row.groups.split(";")) == row.n_groups
    assert alignment(df.limit(0), "doc_id", "text", *args).count() == 0


def test_the_query_keeps_its_contract(spark, tmp_path):
    rows = fixture()[:20]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    out = op13_token_alignment(spark, str(tmp_path))
    assert {c: t for c, t in out.dtypes} == {c: "string" if c == "groups_sha256" else "bigint" for c in COLUMNS}
    assert sorted((tuple(r[c] for c in COLUMNS) for r in out.collect()), key=str) == brute(rows)
