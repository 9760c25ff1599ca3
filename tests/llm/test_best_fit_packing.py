import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from geomedallion.llm import best_fit_packing
from geomedallion.llm.best_fit_packing import cut, pack_documents, plan_packing, sequences
from geomedallion.llm.common import added_tokens, tokenizer
from geomedallion.llm.queries import op5_best_fit_packing


def best_fit_decreasing(histogram):
    space = []
    for length in sorted((x for x, n in histogram.items() for _ in range(n)), reverse=True):
        fits = [s for s in space if s >= length]
        if fits:
            space.remove(min(fits))
        space.append((min(fits) if fits else 1024) - length)
    return len(space)


def test_plans_place_every_piece_once_without_overlap():
    rng = random.Random(4)
    for n, draw in ((1, lambda: 5), (40, lambda: rng.randint(1, 1024)), (2000, lambda: rng.randint(200, 600)), (2000, lambda: rng.randint(1, 1024)), (999, lambda: 512)):
        histogram = defaultdict(int)
        for _ in range(n):
            histogram[draw()] += 1
        entries, count = plan_packing(dict(histogram))
        ranks, bins = defaultdict(list), defaultdict(list)
        for length, first, placed, sequence, each, at in entries:
            for i in range(placed):
                ranks[length].append(first + i)
                bins[sequence + i // each].append((at + i % each * length, length))
        assert all(sorted(ranks[x]) == list(range(histogram[x])) for x in histogram)
        for b in bins.values():
            at = 0
            for offset, length in sorted(b):
                assert offset == at
                at += length
            assert at <= 1024
        assert len(bins) == count <= best_fit_decreasing(histogram)


def test_cut():
    assert cut(1, 4) == [(0, 1)] and cut(4, 4) == [(0, 4)] and cut(9, 4) == [(0, 1), (1, 4), (5, 4)]


def test_pieces_round_trip_and_match_the_other_tokenizer(spark):
    rng = random.Random(6)
    texts = {i: " ".join(rng.choice(["the", "ünï", "x" * 30, "42", "\n\n", "<|endoftext|>", "日本"]) for _ in range(rng.choice([0, 1, 50, 900, 4000]))) for i in range(60)}
    texts[60], texts[61] = None, ""
    rows = list(texts.items()) + [(61, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("length", F.lit("clash")).withColumn("piece", F.lit(1))
    packed = pack_documents(df, "doc_id", "text", *tokenizer("byte_bpe_50k.tiktoken"), added_tokens("byte_bpe_50k.json"), with_ids=True)
    got = defaultdict(list)
    bins = defaultdict(list)
    for r in packed.collect():
        assert r.length == len(r.ids) and zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32
        got[r.doc_id].append((r.piece, r.start, r.ids))
        bins[r.sequence_id].append((r.offset, r.length))
    other = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for i, text in texts.items():
        pieces = sorted(got[i]) if i != 61 else sorted(got[i])[:1]
        ids = [x for _, _, p in pieces for x in p]
        assert ids == other.encode(text or "", add_special_tokens=False).ids + [2]
        assert all(len(p) == 1024 for _, _, p in pieces[1:]) and [s for _, s, _ in pieces] == [s for s, _ in cut(len(ids), 1024)]
    assert len(got[61]) == 2  # the repeated row is packed too
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= 1024
    whole = sequences(packed, pad_to=1024, pad_id=-1).collect()
    assert len(whole) == len(bins) and all(len(r.input_ids) == 1024 for r in whole)


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert pack_documents(empty, "doc_id", "text", *tokenizer("byte_bpe_50k.tiktoken")).count() == 0


def test_many_pieces_of_one_length_are_numbered_in_parts(spark, monkeypatch):
    monkeypatch.setattr(best_fit_packing, "RANK_ROWS", 7)
    df = spark.createDataFrame([(i // 2, "word " * (i % 3)) for i in range(300)], "doc_id long, text string")
    packed = pack_documents(df, "doc_id", "text", *tokenizer("byte_bpe_50k.tiktoken"), capacity=8).collect()
    places = {(r.sequence_id, r.offset + k) for r in packed for k in range(r.length)}
    assert len(packed) == 300 and len(places) == sum(r.length for r in packed) and max(at for _, at in places) < 8


def test_the_query_keeps_its_contract(spark, tmp_path):
    rows = [(1, "a <|endoftext|> b"), (2, None), (3, "word " * 3000)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    out = op5_best_fit_packing(spark, str(tmp_path))
    kinds = {"piece": "int"}
    assert dict(out.dtypes) == {c: kinds.get(c, "bigint") for c in ("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")}
    tokens = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in out.collect()}
    for i, text in rows:
        ids = tokens.encode(text or "", add_special_tokens=False).ids + [2]
        assert [got.pop((i, k)) for k in range(len(cut(len(ids), 1024)))] == [(s, n, zlib.crc32(np.array(ids[s : s + n], "<u4").tobytes())) for s, n in cut(len(ids), 1024)]
    assert not got and 50256 in tokens.encode(rows[0][1], add_special_tokens=False).ids
