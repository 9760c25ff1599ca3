from pyspark.sql import functions as F

from geomedallion.llm.line_dedup import drop_boilerplate_lines
from geomedallion.llm.queries import op3_line_dedup

HEAD = "home about contact"


def pages(spark, n=20):
    rows = [(i, "a.org", f"{HEAD}\nbody of page {i} is long enough to stay\n\nmore of {i}") for i in range(n)]
    rows += [(100 + i, "b.org", f"{HEAD}\nonly {i} words here and a few more of them") for i in range(2)]
    return spark.createDataFrame(rows, "doc_id long, source string, text string")


def brute(rows, ratio=0.01, min_pages=5):
    keys = lambda t: [x.strip(" \t\r") for x in (t or "").split("\n")]
    out = {}
    for i, host, text in rows:
        own = [set(keys(t)) - {""} for t in {t for _, h, t in rows if h == host}]  # a page for each text
        if text is None:
            out[i] = (None, 0)
            continue
        bad = {x for x in set(keys(text)) if (n := sum(x in k for k in own)) >= min_pages and n > ratio * len(own)}
        lines = text.split("\n")
        kept = [x for x, k in zip(lines, keys(text)) if k not in bad]
        whole = not any(map(str.strip, kept))
        out[i] = (text, 0) if whole else ("\n".join(kept), len(lines) - len(kept))
    return out


def test_frequent_lines_go_and_rare_ones_stay(spark):
    got = {r.doc_id: r for r in drop_boilerplate_lines(pages(spark), dropped="n").collect()}
    assert got[3].text == "body of page 3 is long enough to stay\n\nmore of 3" and got[3].n == 1
    assert got[100].text.startswith(HEAD) and got[100].n == 0  # two pages are too few


def test_edge_cases_against_brute_force(spark):
    rows = [(i, "a.org" if i % 3 else None, f"  {HEAD}\t\nline {i % 4} with some words in it\nown {i} text that is not shared") for i in range(24)]
    rows += [(60 + i, "c.org", f"seldom seen\nown text number {i}" if i < 6 else f"own text number {i}") for i in range(200)]  # 3 percent
    rows += [(300 + i, "d.org", f"rarely seen\nown text number {i}" if i < 5 else f"own text number {i}") for i in range(500)]  # 1 percent
    rows += [(50, "a.org", None), (51, "a.org", ""), (52, None, "\n\n"), (53, "a.org", HEAD), (54, "a.org", "x" * 200_000 + "\n" + HEAD), (55, "a.org", f"{HEAD}\n{HEAD}\n" + "tail of words " * 9)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = {r.doc_id: (r.text, r.n) for r in drop_boilerplate_lines(df, ratio=0.2, min_pages=3, dropped="n").collect()}
    assert got == brute(rows, 0.2, 3)
    got = {r.doc_id: (r.text, r.n) for r in drop_boilerplate_lines(df, dropped="n").collect()}
    assert got == brute(rows)


def test_copies_of_a_whole_page_stay_whole(spark):
    rows = [(i, "a.org", "one line\nanother line\na third line") for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    assert {r.text for r in drop_boilerplate_lines(df).collect()} == {"one line\nanother line\na third line"}


def test_clashing_columns_empty_table_and_repeated_rows(spark):
    df = pages(spark).withColumn("row", F.lit(1)).withColumn("host", F.lit("h")).withColumn("lines", F.lit(2)).withColumn("kept", F.lit(3)).withColumn("line.x", F.lit(4))
    out = drop_boilerplate_lines(df.union(df))
    assert out.columns == df.columns and out.count() == 44 and {r["lines"] for r in out.collect()} == {2}
    assert drop_boilerplate_lines(df.limit(0)).count() == 0


def test_lines_of_few_percent_go_and_copies_count_once(spark):
    rows = [(i, "a.org", f"page {i} has words of its own\n" + (f"{HEAD}\n" if i % 30 == 0 else "") + f"end of {i}") for i in range(300)]
    rows += [(1000 + i, "a.org", "a page that was copied\nwith its own second line\nand a third") for i in range(40)]
    rows += [(2000, "a.org", "a page that was copied\nand something else")]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = {r.doc_id: (r.text, r.n) for r in drop_boilerplate_lines(df, dropped="n").collect()}
    assert all(got[i] == (f"page {i} has words of its own\nend of {i}", int(i % 30 == 0)) for i in range(300))
    assert all(got[i] == (t, 0) for i, _, t in rows[300:])


def test_short_pages_of_mostly_boilerplate_lose_it(spark):
    rows = [(i, "a.org", f"{HEAD}\npage {i} has a text of its own, long enough") for i in range(20)]
    rows += [(50, "a.org", f"{HEAD}\nown.\n{HEAD}"), (51, "a.org", f"{HEAD}\n \n{HEAD}"), (52, "a.org", HEAD)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = {r.doc_id: (r.text, r.n) for r in drop_boilerplate_lines(df, dropped="n").collect()}
    assert got[50] == ("own.", 2) and got[51] == (rows[21][2], 0) and got[52] == (HEAD, 0)
    assert got[7] == ("page 7 has a text of its own, long enough", 1)
    assert {k: (v[0], v[1]) for k, v in got.items()} == brute(rows)


def test_the_query_keeps_its_contract(spark, tmp_path):
    rows = [(i, f"s{i % 2}", f"{HEAD}\npage {i} has a text of its own" if i % 9 == 0 else f"page {i} has a text of its own") for i in range(120)] + [(500, None, None)]
    spark.createDataFrame(rows, "doc_id long, source string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    out = op3_line_dedup(spark, str(tmp_path))
    assert out.columns == ["doc_id", "text", "n_dropped"]
    assert {r.doc_id: (r.text, r.n_dropped) for r in out.collect()} == brute(rows)
