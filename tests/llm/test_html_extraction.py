import random
import time
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from geomedallion.llm.html_extraction import Page, boilerplate_words, extract, extract_pages, votes_of
from geomedallion.llm.queries import op8_html_extraction

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body><header><a href="/">Site</a> slogan of the site</header>
<nav><ul><li><a href="/a">Menu one</a></li></ul></nav><!-- a <p>comment</p> --><div class="cookie-notice">We use cookies, lots of them.</div>
<div id="content-{n}" class="post-{n}"><h1>Title {n} &amp; more</h1><p>First <b>bold</b>er paragraph of page {n},
 with&nbsp;some   text.<br>Next line<p>Second &lt;paragraph&gt; &#233; left open<ul><li>one<li>two</ul><script>var t="</p>";</script>
<form><input name=q><button>Go</button></form></div><aside>Related: nothing</aside><div class="comments"><p>I disagree with all of this, at great length and more.</p></div>
<footer>&copy; 2024</footer></body></html>"""


def text(n):
    return f"Title {n} & more First bolder paragraph of page {n}, with some text. Next line Second <paragraph> é left open one two"


def test_article_text_and_generalised_paths():
    assert extract(PAGE.format(n=5), []) == text(5)
    assert {p for p, _ in votes_of(PAGE.format(n=5))} == {p for p, _ in votes_of(PAGE.format(n=77))}


def test_consensus_helps_a_page_whose_article_is_short(spark):
    rows = [(n, "https://www.a.org/x", PAGE.format(n=n)) for n in range(12)]
    short = '<html><body><div class="post-3" id="content-3"><p>Short.</p></div><div class="other"><p>' + "A longer text that belongs to another box. " * 6 + "</p></div></body></html>"
    rows += [(50, "https://www.a.org/y", short), (51, "https://b.org/y", short), (52, None, short)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit("h")).withColumn("paths", F.lit(1)).withColumn("text", F.lit("t"))
    got = {r.page_id: r for r in extract_pages(df).collect()}
    assert all(got[n].text == text(n) and got[n].n_chars == len(text(n)) for n in range(12))
    assert got[50].text == "Short." and got[51].text.startswith("A longer") and got[52].text.startswith("A longer")


def test_rows_of_every_kind(spark):
    rows = [(1, "u", None), (2, "u", ""), (3, None, "plain text &amp; no tags"), (4, "http://[bad", "<p>open <i>tags <article><p>x y</article"), (5, "u", "<div>" * 5000 + "deep"), (6, "u", "<article><p>" + "long text " * 60_000), (6, "u", "<article><p>again</p></article>"), (7, "u", "<html><body><script>only()</script></body></html>"), (8, "u", "a < b and <3 > 2"), (None, None, None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = extract_pages(df).collect()
    assert len(got) == len(rows)
    by = {(r.page_id, r.n_chars): r.text for r in got}
    assert by[1, 0] == by[2, 0] == by[7, 0] == "" and by[3, 20] == "plain text & no tags"
    assert by[6, 599999] == ("long text " * 60_000).strip() and by[6, 5] == "again" and by[5, 4] == "deep"
    assert extract_pages(df.limit(0)).count() == 0


def test_end_tags_do_not_leave_their_container():
    page = Page("<div><article><p>one</b></p><div>two</div></p> three</article></div>")
    assert page.text_of({page.tag.index("article")}) == "one two three"


def test_open_options_and_buttons_end_with_what_holds_them():
    article = "<article><p>First words of the text.</p>{}<p>Last words of the text.</p></article>"
    for inside in ("<datalist><option>one<option>two</datalist>", "<select><optgroup><option>one<option>two</select>", "<div><button>Go</div>", "<div><svg><path d=x></div>", "<svg><svg>a</svg>b</svg>", "<svg><foreignObject><div>a</svg>", "<template><div>a</div></template>", "<noscript><p>a</noscript>"):
        assert extract(article.format(inside), []) == "First words of the text. Last words of the text.", inside
    assert extract("<article><p>One <template><div>no</div></template>two.</p></article>", []) == "One two."
    assert extract("<article><p>One.</p><script>left open <p>no", []) == "One."


BODY = "<p>" + "Plain words of the article go on and on in here. " * 4 + "</p>"
SAID = ("Plain words of the article go on and on in here. " * 4).strip()
WHOLE = {
    "title and lead beside the body": (f"<html><body><article><h1>Title</h1><p>Lead.</p><div class=post-body>{BODY * 3}</div></article></body></html>", f"Title Lead. {SAID} {SAID} {SAID}"),
    "title and lead in a plain page": (f"<html><body><h1>Title</h1><p>Lead.</p><div class=post-body>{BODY}</div></body></html>", f"Title Lead. {SAID}"),
    "two sections of other classes": (f"<body><div><section class=a>{BODY * 3}</section><section class=b><p>Short end.</p></section></div></body>", f"{SAID} {SAID} {SAID} Short end."),
    "classes that are no boilerplate": (f"<article><section class=related-work>{BODY}</section><section id=ad-hoc>{BODY}</section></article>", f"{SAID} {SAID}"),
    "header in a plain container": (f"<body><div id=all><header>Site Name <a href=x>Menu</a></header>{BODY}</div></body>", SAID),
    "header of the article": (f"<body><article><header><h1>Title</h1></header>{BODY}</article></body>", f"Title {SAID}"),
    "comments of another name": (f"<body><article>{BODY}<section class=user-responses>{BODY * 5}</section></article></body>", SAID),
    "comments in camel case": (f"<body><div>{BODY}<div class=commentList>{BODY * 5}</div></div></body>", SAID),
    "a form that holds the article": (f"<body><form id=aspnetForm><div class=content>{BODY * 2}<form><p>Your name <input></p></form></div></form></body>", f"{SAID} {SAID} Your name"),
    "a form beside it": (f"<body><article>{BODY * 2}<form><p>Your name, please, and more.</p></form></article></body>", f"{SAID} {SAID}"),
    "a class of the whole page": (f"<body><div class=has-sidebar><div class=post>{BODY}</div></div></body>", SAID),
    "references across tags": (f"<article>{BODY}<p>x&am<b>p;</b> &lt;<i>y</i>&gt;</p></article>", f"{SAID} x&amp; <y>"),
    "notices": (f"<body><div class=cookie-notice><p>We use cookies.</p></div><div class=newsletter-box><p>Sign up.</p></div><main>{BODY}</main></body>", SAID),
}


@pytest.mark.parametrize("name", WHOLE)
def test_articles_are_whole_and_alone(name):
    page, want = WHOLE[name]
    want = want.replace(" Your name", "") if name == "a form that holds the article" else want
    assert extract(page, []) == want
    assert extract(page, [p for p, _ in votes_of(page)]) == want


def test_words_of_classes():
    assert boilerplate_words("comment-list sidebar_2 shareButtons") == {"comment", "sidebar", "share"}
    assert not boilerplate_words("related-work ad-hoc notice-of-death menu-plan -- 12 headerless")


@pytest.mark.parametrize("page", [
    "<div>" * 20_000 + "deep", "<b>" * 40_000 + "deep" * 10, "<b>x" * 20_000, "<div>" * 10_000 + "</section>" * 20_000 + "<p>end",
    "<div class=a>" * 20_000 + "<p>" + "word " * 500, "<p>a" * 40_000, "<b><p>x" * 15_000, "<ul><li>" * 15_000 + "x", "<a href=x>" * 20_000 + "<p>y",
])
def test_hostile_pages_take_linear_time(page):
    start = time.process_time()
    paths = [p for p, _ in votes_of(page)]
    extract(page, paths)
    assert time.process_time() - start < 4


class Brute(HTMLParser):
    """Text of well-formed pages: blocks outside dropped elements, by the standard library's parser."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out, self.skip = [], 0

    def handle_starttag(self, tag, attributes):
        gone = tag in ("nav", "footer", "script", "style", "aside", "form") or dict(attributes).get("class") in ("ad", "comments", "menu-items")
        self.skip += 1 if self.skip or gone else 0
        self.out.append(" " if tag in ("p", "div", "h1", "li", "ul", "article", "section") else "")

    def handle_endtag(self, tag):
        self.skip -= 1 if self.skip else 0
        self.out.append(" " if tag in ("p", "div", "h1", "li", "ul", "article", "section") else "")

    def handle_data(self, data):
        self.out.append("" if self.skip else data)


def test_random_articles_against_a_plain_extractor():
    rng = random.Random(9)
    words = ["word", "naïve", "&amp;", "&#233;t&eacute;", "a&nbsp;b", "x\n  y", "<b>bold</b>er", "<i>it</i>", "3 &lt; 4"]
    line = lambda: " ".join(rng.choice(words) for _ in range(rng.randint(6, 40)))

    def part(depth=0):
        kind = rng.randrange(7 if depth < 3 else 3)
        if kind < 2:
            return f"<p>{line()}</p>"
        if kind == 2:
            return "<ul>" + "".join(f"<li>{line()}</li>" for _ in range(rng.randint(1, 4))) + "</ul>"
        if kind == 3:
            return rng.choice(["<aside>{}</aside>", "<div class='ad'>{}</div>", "<div class='comments'>{}</div>", "<ul class='menu-items'><li>{}</li></ul>", "<form><p>{}</p></form>"]).format(line())
        return rng.choice(["<div>{}</div>", "<section>{}</section>"]).format("".join(part(depth + 1) for _ in range(rng.randint(1, 4))))

    for _ in range(150):
        article = "<article><h1>" + line() + "</h1>" + "".join(f"<p>{line()}</p>" for _ in range(6)) + "".join(part() for _ in range(rng.randint(1, 8))) + "</article>"
        page = f"<html><body><nav><ul><li><a href='/'>{line()}</a></li></ul></nav>{article}<footer>{line()}</footer></body></html>"
        plain = Brute()
        plain.feed(article)
        assert extract(page, [p for p, _ in votes_of(page)]) == " ".join("".join(plain.out).split())


def test_the_query_keeps_its_contract(spark, tmp_path):
    rows = [(n, f"https://a.org/{n}", PAGE.format(n=n)) for n in range(3)] + [(9, None, None)]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    out = op8_html_extraction(spark, str(tmp_path))
    assert out.dtypes == [("page_id", "bigint"), ("url", "string"), ("text", "string"), ("n_chars", "bigint")]
    assert {r.page_id: r.text for r in out.collect()} == {**{n: text(n) for n in range(3)}, 9: ""}
