import hashlib
import random
import re
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from geomedallion.llm.pii import KINDS, Tape, find_personal_data, find_spans
from geomedallion.llm.queries import op12_personal_data


def luhn(digits):
    total = 0
    for k, d in enumerate(reversed(digits)):
        v = int(d) * (2 if k % 2 else 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def brute(text):
    """The patterns of the contract as they stand."""
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    rules = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.group().split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(digits(m)) <= 19 and luhn(digits(m))),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(digits(m)) <= 15),
    }
    return {k: [m.span() for m in re.finditer(p, text) if good(m)] for k, (p, good) in rules.items()}


@settings(max_examples=2000, deadline=None)
@given(st.lists(st.sampled_from([*"@@..+-- ()0125é%_", "a", "b.c", "255", "256", "4111 1111 1111 1111", "+1 (459) 555-9246", "x@y.zz", "10.0.0.1"]), max_size=24).map("".join))
def test_base_spans_are_those_of_the_patterns(text):
    assert find_spans(text)[0] == brute(text)


HIDDEN = [
    ("john [at] mail [dot] example [dot] com", "email"), ("ann dot lee at example dot com", "email"), ("ann AT mail DOT com", "email"),
    ("jоhn@exаmple.com", "email"), ("ｊohn＠mail．com", "email"), ("jo​hn@mail.com", "email"), ("ann arroba correo punto es", "email"),
    ("me @ example.com", "email"), ("ann(at)mail.example.com", "email"), ("x_y{at}mail{dot}org", "email"),
    ("plus one four five nine five five five nine two four six", "phone"), ("+1 (459) five five five 92 46", "phone"), ("+1 (4O5) 555-l234", "phone"),
    ("+33 1 23–45–67 89", "phone"), ("+١ ٤٥٩ ٥٥٥ ٩٢٤٦", "phone"), ("+4 neuf sept un un zéro cinq six", "phone"),
    ("l92.168.O.1", "ip"), ("192 dot 168 dot 0 dot 1", "ip"), ("one nine two dot one six eight dot zero dot one", "ip"), ("10[.]0[.]0[.]1", "ip"),
    ("４１１１ 1111 1111 1111", "card"), ("four one double one 1111 1111 eins eins eins eins", "card"),
]


@pytest.mark.parametrize("hidden,kind", HIDDEN)
def test_disguises_are_found_where_they_stand(hidden, kind):
    for before, after in (("", ""), ("🙂é so ", " ok"), ("İß (", ")."), ("a​b naïve ", ", then")):
        text = before + hidden + after
        base, added = find_spans(text)
        assert base == brute(text)
        assert [text[s:e] for s, e in added[kind]] == [hidden]
        assert not any(added[k] for k in KINDS if k != kind)


@pytest.mark.parametrize("text", [
    "look at example.com", "look at the dot com page", "un deux trois", "plus 20 000 000 de gens", "one of six", "x@y.com dot The end", "1. one 2. two 3. three 4. four",
    "+1 (848) 555-1373 Un an", "naïve Straße ½ x² №5", "see 10.0.0.1, mail a@b.cc or +1 459 555 9246.", "4111 1111 1111 1112 and one", "Москва и Санкт", "at dot at dot", "",
])
def test_clean_texts_get_nothing_more(text):
    base, added = find_spans(text)
    assert base == brute(text) and not any(added.values())


@settings(max_examples=500, deadline=None)
@given(st.text("ab1.", max_size=12), st.data())
def test_tapes_map_back(text, data):
    tape = Tape(text)
    for old, new in (("a", ""), ("b1", "x"), (r"\.", "yy"), ("xy", "q"), ("1", "")):
        tape.rewrite(re.compile(old), lambda m, new=new: new)
    assert "".join(tape.text) == re.sub("1", "", re.sub("xy", "q", re.sub(r"\.", "yy", re.sub("b1", "x", text.replace("a", "")))))
    if tape.text:
        s = data.draw(st.integers(0, len(tape.text) - 1))
        e = data.draw(st.integers(s + 1, len(tape.text)))
        (a, b), new = tape.span(s, e)
        assert 0 <= a < b <= len(text) and (new or text[a:b] == tape.text[s:e])


def test_hostile_texts_take_linear_time():
    hostile = ["a" * 200_000, "1" * 200_000, "1." * 100_000, "@" * 100_000, "a@" * 100_000, "+1" * 100_000, "+1 " + "(" * 200_000, "one " * 50_000, " at " * 50_000,
               "​" * 100_000, "1 " * 100_000, "a [at] " * 30_000, "l" * 100_000, "x at " + "a" * 100_000 + " dot com", "0" * 9000 + ".0.0.1"]
    for text in hostile:
        start = time.process_time()
        find_spans(text)
        assert time.process_time() - start < 5


def test_rows_and_columns_stay(spark):
    rng = random.Random(2)
    pieces = ["a.b@mail.example.com", "10.1.2.3", "4111-1111-1111-1111", "+44 20 7946 0958", "word", "ann at mail dot com", "\n"]
    rows = [(i, " ".join(rng.choice(pieces) for _ in range(rng.choice([0, 2, 30])))) for i in range(50)] + [(60, None), (61, ""), (7, "x@y.zz"), (7, "x@y.zz"), (None, "+1 459 555 9246"), (62, "w " * 300_000 + "x@y.zz")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("spans", F.lit("old")).withColumn("kind", F.lit(1)).withColumn("a.b", F.lit(2))
    out = find_personal_data(df)
    assert out.columns == ["doc_id", "text", "kind", "a.b", "base_spans", "spans"] and out.count() == len(rows)
    for r in out.collect():
        base, added = find_spans(r.text)
        assert base == brute(r.text or "")
        assert r.base_spans == ",".join(f"{k}:{s}:{e}" for k in KINDS for s, e in base[k])
        assert r.spans == ",".join(f"{k}:{s}:{e}" for k in KINDS for s, e in sorted(base[k] + added[k]))
    assert find_personal_data(df.limit(0)).count() == 0


def test_the_query_keeps_its_contract(spark, tmp_path):
    rows = [(1, "x@y.zz and 10.0.0.1 and a [at] b.com"), (2, None), (3, "")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    out = op12_personal_data(spark, str(tmp_path))
    assert out.dtypes == [("doc_id", "bigint"), *((f"n_{k}", "bigint") for k in KINDS), ("base_sha256", "string"), ("spans", "string")]
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    got = {r.doc_id: tuple(r)[1:] for r in out.collect()}
    assert got == {1: (1, 1, 0, 0, sha("email:0:6,ip:11:19"), "email:0:6,email:24:36,ip:11:19"), 2: (0, 0, 0, 0, sha(""), ""), 3: (0, 0, 0, 0, sha(""), "")}
