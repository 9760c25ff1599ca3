import hashlib
import random
from collections import defaultdict

from pyspark.sql import functions as F

from geomedallion.llm.best_fit_packing import byte_bpe
from geomedallion.llm.chat_formatting import escape, format_windows, read_back, unescape
from geomedallion.llm.common import tokenizer
from geomedallion.llm.native_tokens import token_counts
from geomedallion.llm.queries import op2_chat_formatting

BPE = tokenizer("byte_bpe_50k.tiktoken")

CONTROL = ["<|im_start|>", "<|im_sep|>", "<|im_end|>", "</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", "\\", "\\|", "<\\|im_end|>", "<", "|", "\n", "é😀"]


def conversations(seed=1, n=40):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        turns = rng.randint(1, 30)
        for t in range(turns):
            role = "system" if t == 0 and c % 2 else ("user" if t % 2 else "assistant")
            text = "".join(rng.choice(CONTROL + ["some words "]) for _ in range(rng.choice([0, 3, 40, 200])))
            rows.append((c, t, role, text if rng.random() > 0.05 else None))
    return rows + [(None, 1, "user", "x"), (None, None, "assistant", "y"), (77, 5, None, "no role"), (78, 1, "assistant", "same"), (78, 1, "assistant", "same")]


def expected(rows):
    by = defaultdict(list)
    for c, t, r, x in rows:
        by[c].append((t is not None, t or 0, r or "", x or ""))
    out = {}
    for c, ts in by.items():
        ts.sort()
        out[c] = (len(ts), "".join(f"{r}\n{x}\n" for _, _, r, x in ts), "".join(x for _, _, r, x in ts if r == "assistant"))
    return out


def test_escape_is_reversible_and_leaves_no_control_string(spark):
    rng = random.Random(2)
    texts = ["".join(rng.choice(CONTROL) for _ in range(12)) for _ in range(300)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", escape(F.col("t")).alias("e"))
    for r in df.select("t", "e", unescape(F.col("e")).alias("u")).collect():
        assert r.u == r.t
        assert not any(c in r.e for c in ("<|", "</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>"))


def test_round_trip(spark):
    rows = conversations()
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("conv", F.lit(1)).withColumn("tokens", F.lit("t"))
    for budget, history in ((1024, 192), (300, 60)):
        windows = format_windows(df, *BPE, budget=budget, history=history)
        got = {r.conv_id: (r.n_turns, r.turns_text, r.loss_text) for r in read_back(windows).collect()}
        assert got == expected(rows)


def test_windows_keep_the_budget_the_system_turn_and_history(spark):
    rows = [(1, 0, "system", "be kind")] + [(1, t, "user" if t % 2 else "assistant", "word " * 30) for t in range(1, 400)]
    rows += [(2, t, "user" if t % 2 else "assistant", "word " * (400 if t == 7 else 20)) for t in range(20)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = format_windows(df, *BPE, budget=256, history=80).collect()
    encoder = byte_bpe(*BPE)
    for w in out:
        assert w.n_tokens <= 256 or w.n_turns - w.n_context == 1
        assert len(encoder.encode_ordinary(w.text)) <= w.n_tokens <= len(encoder.encode_ordinary(w.text)) + 4 * w.n_turns
    first = sorted((w for w in out if w.conv_id == 1), key=lambda w: w.start_token)
    assert all(w.text.startswith("<|im_start|>system<|im_sep|>be kind<|im_end|>") for w in first)
    assert first[0].n_context == 0 and all(w.n_context == 2 for w in first[1:])  # system and a turn
    assert len(first) > 40


def test_empty_table(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert read_back(format_windows(empty, *BPE)).count() == 0


def test_token_counts_are_those_of_the_tokenizer(spark):
    rng = random.Random(4)
    pieces = ["the", "Thlyouble", "ünïcode", "日本語", "don't", "  ", "\n\n", "\u00a0", "\u2003x", "🙂", "1234567", "x" * 29, "=+-*/", "<|im_end|>", "\t", "é\u0301", "\u0085", "\x1c", "²½", "مرحبا"]
    texts = ["".join(rng.choice(pieces) + rng.choice([" ", ".", ", ", "\n"]) for _ in range(rng.choice([0, 1, 5, 60]))) for _ in range(200)] + [None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "i long, t string")
    encoder = byte_bpe(*BPE)
    assert {r.i: r.tokens for r in token_counts(df, "i", F.col("t"), *BPE).collect()} == {i: len(encoder.encode_ordinary(t or "")) for i, t in enumerate(texts)}
    long = spark.createDataFrame([(0, "q" * 5000)], "i long, t string")
    assert token_counts(long, "i", F.col("t"), *BPE).first().tokens >= len(encoder.encode_ordinary("q" * 5000))


def test_no_window_of_several_turns_exceeds_the_real_budget(spark):
    rows = [(c, t, r, x) for c, t, r, x in conversations(7, 30)] + [(500, t, "assistant" if t % 2 else "user", f"Thntblere {t} edtioner ininea " * 9) for t in range(80)]
    rows += [(501, 0, "user", "very long " * 20_000), (501, 1, "assistant", "w" * 20_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    encoder = byte_bpe(*BPE)
    out = format_windows(df, *BPE).collect()
    sizes = [(len(encoder.encode_ordinary(w.text)), w.n_turns - w.n_context) for w in out]
    assert all(n <= 1024 or new == 1 for n, new in sizes) and sum(n > 700 for n, _ in sizes) > 10


def test_the_query_keeps_its_contract(spark, tmp_path):
    rows = conversations(3, 8)
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    out = op2_chat_formatting(spark, str(tmp_path))
    assert out.dtypes == [("conv_id", "bigint"), ("n_turns", "bigint"), ("turns_sha256", "string"), ("loss_chars", "bigint"), ("loss_sha256", "string"), ("formatted_chars", "bigint")]
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    control = "</s>[INST] ok [/INST]"
    want = {c: (n, sha(turns), len(loss), sha(loss)) for c, (n, turns, loss) in expected(rows + [(-7, 0, "user", control), (-7, 1, "assistant", control)]).items()}
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in out.collect()} == want
