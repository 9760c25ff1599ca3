"""Operator 8: main text of web pages by consensus paths of a host.

First pass: each page's containers are scored (text in paragraphs, less links), each is widened to the article or
main element it stands in, and the best ones vote with their score share for their generalised path (tags and
classes from the root, digits as ``#``). Spark sums the votes per host and path. Second pass: each page is
re-extracted from the container on its host's winning path, with the headings, paragraphs and sections beside it;
the next path is tried where a page lacks the first, and a page that has none of them falls back on its own best
container.

Elements of what is no article (menus, headers, footers, notices, comments and so on) are dropped by their tag, role
or class. A class counts by its head word ("comment-list", not "related-work"); a form, or a class that
says nothing certain, is weighed against the text inside: what holds most of a page's paragraphs is not dropped.

Scale: the votes are partially aggregated, so a host with a third of all pages sends a row per task and
path. Paths travel as digests of a fixed size, made from the parent's digest, so deep pages cost no more than long
ones. Only the winning paths (``TOP_PATHS`` a host) are joined back; they are broadcast if few (the
written table is counted first), otherwise the pages are the outer side of a join on the host, whose
skew Spark splits.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geomedallion.llm.common import in_arrow, materialise

TOP_PATHS = 5
VOTES = 3
MIN_SHARE = 0.05  # of its host's votes, for a path to win
BROADCAST_HOSTS = 100_000

# Element names by role, and class words of what is no article text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe".split())  # hold no elements: read up to their end tag
EMBEDDED = frozenset("noscript template svg math select option button canvas object".split())  # blocks inside close nothing outside
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 "
    "h6 head header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
SCOPE = frozenset("article aside body div footer form header html main nav section table td th ul ol dl blockquote fieldset".split())
CONTAINER = frozenset("article body div main section td".split())
DROPPED = frozenset("nav aside footer script style textarea title noscript template iframe svg math select option button canvas object head menu dialog".split())
TEXTUAL = frozenset("p h1 h2 h3 h4 h5 h6 li blockquote pre td dd dt figcaption caption summary".split())  # blocks of running text
COMMENT_WORDS = frozenset("comment comments disqus replies reply respond response responses reactions".split())
BOILERPLATE_WORDS = COMMENT_WORDS | frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs consent cookie cookies footer header masthead menu "
    "nav navbar navigation newsletter notice pagination popup promo promoted related share sharing sidebar signup social sponsor sponsored "
    "subscribe toolbar widget".split()
)
LAYOUT_WORDS = frozenset(  # say nothing after another word: "comment-list" is comments
    "area articles bar block box button buttons col column container group holder icons inner item items left link links list outer panel posts "
    "right row section slot stories top bottom unit wrap wrapper form message text".split()
)
MOST = 0.5  # of a page's paragraph text: what holds more is not dropped for its class or as a form
CLOSES = {"p": BLOCK - {"br"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}}
ROLES = frozenset("navigation banner complementary contentinfo search form dialog alert".split())

MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*+)>", re.S)
ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
DIGITS = re.compile(r"\d+")
PARTS = re.compile(r"[-_\d\s]+|(?<=[a-z])(?=[A-Z])")


def boilerplate_words(value: str) -> set[str]:
    """The boilerplate words that head the tokens of a class or id: the last word that is not one of layout."""
    out = set()
    for token in value.split():
        parts = [p.lower() for p in PARTS.split(token) if p]
        while len(parts) > 1 and parts[-1] in LAYOUT_WORDS:
            parts.pop()
        out |= {parts[-1]} & BOILERPLATE_WORDS if parts else set()
    return out


class Page:
    """Elements of a page in page order, tolerant of missing end tags."""

    def __init__(self, source: str):
        self.tag, self.label, self.parent = ["#root"], [""], [-1]
        self.words: list[set[str]] = [set()]  # boilerplate words of the class and id
        self.hidden = [False]
        self.block, self.linked = [0], [False]  # the block an element stands in, and whether a link lies between
        self.texts: list[tuple[int, str]] = []
        self.breaks: set[int] = set()  # numbers of texts that begin a block
        self._open_tags: Counter[str] = Counter()
        self._parse(source)
        self._judge()

    def _judge(self) -> None:
        """Which elements are dropped, and the text and paragraph text below each."""
        n = len(self.tag)
        sectioned = [""] * n  # the article or main element that an element stands in
        hard = [False] * n
        for i in range(1, n):
            up, tag = self.parent[i], self.tag[i]
            sectioned[i] = tag if tag in ("article", "main") else sectioned[up]
            stray = tag == "header" and not sectioned[up]
            hard[i] = hard[up] or self.hidden[i] or tag in DROPPED or stray or bool(self.words[i] & COMMENT_WORDS)
        own, para = [0] * n, [0] * n
        for node, text in self.texts:
            if not hard[node]:
                size = len(text.strip())
                own[node] += size
                para[node] += size if self.tag[self.block[node]] in TEXTUAL and not self.linked[node] else 0
        for i in range(n - 1, 0, -1):
            own[self.parent[i]] += own[i]
            para[self.parent[i]] += para[i]
        self.dropped = hard
        for i in range(1, n):
            doubtful = self.tag[i] == "form" or bool(self.words[i])
            self.dropped[i] = hard[i] or self.dropped[self.parent[i]] or (doubtful and para[i] <= MOST * para[0])
        self.para = para

    def _parse(self, source: str) -> None:
        stack, at, n = [0], 0, len(source)
        while at < n:
            m = MARKUP.search(source, at)
            if m is None:
                self._text(stack[-1], source[at:])
                return
            if m.start() > at:
                self._text(stack[-1], source[at : m.start()])
            at = m.end()
            name = m.group(2)
            if name is None:
                continue
            name = name.lower()
            if m.group(1):
                self._close(stack, name)
                continue
            if name in RAW and not m.group(3).endswith("/"):
                end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(source, at)
                at = end.end() if end else n
                if name in BLOCK:
                    self.breaks.add(len(self.texts))
                continue
            self._open(stack, name, m.group(3))

    def _text(self, node: int, text: str) -> None:
        self.texts.append((node, entities.unescape(text)))

    def _open(self, stack: list[int], name: str, attributes: str) -> None:
        while len(stack) > 1 and name in BLOCK:  # a start tag ends what cannot hold it
            i = next((k for k in range(len(stack) - 1, 0, -1) if self.tag[stack[k]] in CLOSES or self.tag[stack[k]] in SCOPE or self.tag[stack[k]] in EMBEDDED), 0)
            if i and name in CLOSES.get(self.tag[stack[i]], ()):
                self._leave(stack, i)
            else:
                break
        if name in ("option", "optgroup") and self.tag[stack[-1]] == "option":
            self._leave(stack, len(stack) - 1)
        if name in BLOCK:
            self.breaks.add(len(self.texts))
        if name in VOID or attributes.endswith("/"):
            return
        words, boilerplate, hidden = [], set(), False
        for key, a, b, c in ATTRIBUTE.findall(attributes):
            value = a or b or c
            if key.lower() in ("class", "id"):
                words += value.lower().split()
                boilerplate |= boilerplate_words(value)
            elif key.lower() == "role":
                hidden |= value.lower() in ROLES
            else:
                hidden |= key.lower() == "hidden" or value.lower() == "true"
        up, node = stack[-1], len(self.tag)
        self.parent.append(up)
        self.tag.append(name)
        self.label.append(".".join([name, *sorted({DIGITS.sub("#", w) for w in words})]))
        self.hidden.append(hidden)
        self.words.append(set() if name in ("body", "html") else boilerplate)
        self.block.append(node if name in BLOCK else self.block[up])
        self.linked.append(name == "a" or (name not in BLOCK and self.linked[up]))
        stack.append(node)
        self._open_tags[name] += 1

    def _leave(self, stack: list[int], k: int) -> None:
        self._open_tags.subtract(self.tag[i] for i in stack[k:])
        del stack[k:]

    def _close(self, stack: list[int], name: str) -> None:
        if name in BLOCK:
            self.breaks.add(len(self.texts))
        if not self._open_tags[name]:
            return
        for k in range(len(stack) - 1, 0, -1):
            tag = self.tag[stack[k]]
            if tag == name:
                self._leave(stack, k)
                return
            if tag in SCOPE and name not in SCOPE and name not in EMBEDDED:
                return

    def digests(self) -> list[bytes]:
        """The generalised path of every element, as a digest of its parent's and its own label."""
        out = [b""]
        for i in range(1, len(self.tag)):
            out.append(blake2b(out[self.parent[i]] + self.label[i].encode("utf-8", "replace"), digest_size=12).digest())
        return out

    def widened(self, node: int) -> int:
        """The article or main element that a container stands in, or the container itself."""
        k = node
        while k > 0 and self.tag[k] not in ("article", "main"):
            k = self.parent[k]
        return k or node

    def family(self, nodes: set[int]) -> set[int]:
        """The containers, and beside them and what holds them: headings and paragraphs; and sections beside sections."""
        chain, sections = set(), set()
        for node in nodes:
            if self.tag[self.widened(node)] in ("article", "main"):
                continue  # holds what belongs to it
            if self.tag[node] == "section":
                sections.add(self.parent[node])
            while node > 0 and node not in chain:
                chain.add(node)
                node = self.parent[node]
        holders = {self.parent[i] for i in chain}
        beside = {
            i for i in range(1, len(self.tag))
            if self.parent[i] in holders and i not in chain and not self.dropped[i] and self.para[i]
            and (self.tag[i] in TEXTUAL - {"li", "td"} or (self.tag[i] == "section" and self.parent[i] in sections))
        }
        return nodes | beside

    def containers(self) -> list[tuple[float, int]]:
        """(score, node), best first: text of paragraphs to their parent in full and beyond it by half."""
        n = len(self.tag)
        own, links = [0] * n, [0] * n
        score = [0.0] * n
        holder = [0] * n  # the nearest container, the element itself included
        for i in range(1, n):
            holder[i] = i if self.tag[i] in CONTAINER else holder[self.parent[i]]
        for node, text in self.texts:
            size = len(text.strip())
            if size and not self.dropped[node]:
                (links if self.linked[node] else own)[self.block[node]] += size
        for node in range(1, n):
            good = own[node] - 2 * links[node]
            k, share = holder[node], 1.0
            while good > 0 and k > 0 and share > 0.1:
                score[k] += share * good
                k, share = holder[self.parent[k]], share * 0.5
        for node in range(1, n):
            if score[node] and self.tag[node] in ("article", "main"):
                score[node] *= 1.5
            elif score[node] and self.tag[node] == "body":
                score[node] *= 0.6
        return sorted(((s, i) for i, s in enumerate(score) if s > 0 and not self.dropped[i]), key=lambda x: (-x[0], x[1]))

    def text_of(self, nodes: set[int]) -> str:
        """Text below the nodes, without dropped elements."""
        inside = [False] * len(self.tag)
        for i in range(len(self.tag)):
            up = self.parent[i]
            inside[i] = i in nodes or (up >= 0 and inside[up] and not self.dropped[i])
        parts = []
        for k, (node, text) in enumerate(self.texts):
            if k in self.breaks:
                parts.append(" ")
            if inside[node]:
                parts.append(text)
        return " ".join("".join(parts).split())


def votes_of(source: str) -> list[tuple[bytes, float]]:
    """Digests of the paths of a page's best containers, widened, with their score shares."""
    page = Page(source)
    best = page.containers()[:VOTES]
    total = sum(s for s, _ in best)
    digests = page.digests() if best else []
    out: Counter[bytes] = Counter()
    for s, node in best:
        out[digests[page.widened(node)]] += s / total
    return sorted(out.items())


def extract(source: str, paths: list[bytes]) -> str:
    """Main text of one page, by the first of its host's paths that yields any."""
    page = Page(source)
    found = page.containers()
    if not found:
        return page.text_of({i for i, t in enumerate(page.tag) if t == "body"} or {0})
    by_path: dict[bytes, set[int]] = {}
    if paths:
        wanted = set(paths)
        for i, digest in enumerate(page.digests()):
            if digest in wanted and not page.dropped[i]:
                by_path.setdefault(digest, set()).add(i)
    for path in paths:
        if path in by_path and (text := page.text_of(page.family(by_path[path]))):
            return text
    return page.text_of(page.family({page.widened(found[0][1])}))


def host_of(url: str) -> F.Column:
    pattern = r"^[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)"
    return F.coalesce(F.regexp_extract(F.lower(F.col(f"`{url}`")), pattern, 1), F.lit(""))


def winning_paths(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """``host, paths``: each host's paths by votes, best first (ties by path)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            host, path, vote = [], [], []
            for h, source in zip(batch.column(0), batch.column(1)):
                for p, v in votes_of(source.as_py() or ""):
                    host.append(h.as_py()), path.append(p), vote.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(host, pa.string()), pa.array(path, pa.binary()), pa.array(vote, pa.float64())], names=["host", "path", "vote"])

    votes = pages.select(host_of(url).alias("host"), F.col(f"`{html}`").alias("html")).transform(in_arrow, run, "host string, path binary, vote double")
    counted = votes.groupBy("host", "path").agg(F.round(F.sum("vote"), 6).alias("votes"))
    order = Window.partitionBy("host").orderBy(F.desc("votes"), "path")
    ranked = counted.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= TOP_PATHS)
    grouped = ranked.groupBy("host").agg(F.sort_array(F.collect_list(F.struct("rank", "path", "votes"))).alias("top"))
    return grouped.select("host", F.transform(F.filter("top", lambda t: t["votes"] >= MIN_SHARE * F.col("top")[0]["votes"]), lambda t: t["path"]).alias("paths"))


def extract_pages(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` of every page.

    Null and empty html, and pages without text, give an empty text. Pages without a url share the
    host ``''``. Repeated rows are extracted each (and vote each). Whole pages are read, however long. Containers of
    equal score go by page order, paths of equal votes by their digest. Other columns are not read, whatever their
    names; an empty table gives no rows.
    """
    winners = materialise(winning_paths(pages, url, html))
    if winners.count() <= BROADCAST_HOSTS:
        winners = F.broadcast(winners)
    schema = T.StructType([
        T.StructField("page_id", pages.schema[page_id].dataType), T.StructField("url", T.StringType()),
        T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(s.as_py() or "", p.as_py() or []) for s, p in zip(batch.column(2), batch.column(3))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=schema.names)

    rows = pages.select(F.col(f"`{page_id}`").alias("page_id"), F.col(f"`{url}`").alias("url"), F.col(f"`{html}`").alias("html"), host_of(url).alias("host"))
    return rows.join(winners, "host", "left").select("page_id", "url", "html", "paths").transform(in_arrow, run, schema)
