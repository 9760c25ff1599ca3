"""Operator 3: line de-duplication by site-relative frequency.

A line is boilerplate of a host when it stands on more than ``ratio`` of the host's pages (and on
``min_pages`` at least). Such lines are dropped from every page of that host. Pages of one host with the
same text count as one page, so that copies of a page do not make its own lines boilerplate.

Scale: the pages become lists of line hashes (16 bytes a line, no text is shuffled). Copies collapse by
the hash of their text, in each task first; the lists are exploded and counted per (host, line) with
partial aggregation, so a host with a third of all pages spreads by its lines. Each
boilerplate line covers at least ``ratio`` of its host's pages, so a host has at most
``average lines per page / ratio`` of them: the per-host list joined back to the pages is small
whatever the number of pages. The lines found are written and counted; up to ``BROADCAST_ROWS`` of them
(16 bytes each) are broadcast and no text is shuffled, beyond that the join on the host is a shuffle whose
hot host Spark can split (the pages are the outer side of a left join).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geomedallion.llm.common import BROADCAST_ROWS, materialise

RATIO = 0.01
MIN_PAGES = 5
BLANKS = " \t\r"


def _line_key(line: Column) -> Column:
    """Two 64-bit hashes of the trimmed line, as one comparable value."""
    line = F.btrim(line, F.lit(BLANKS))
    return F.struct(F.xxhash64(line).alias("a"), F.xxhash64(F.lit("line"), line).alias("b"))


def _is_blank(line: Column) -> Column:
    return F.btrim(line, F.lit(BLANKS)) == ""


def _page_key(text: str) -> Column:
    """Two 64-bit hashes of the whole text."""
    return F.struct(F.xxhash64(text).alias("a"), F.xxhash64(F.lit("page"), text).alias("b"))


def boilerplate_lines(pages: DataFrame, host: str, text: str, ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """One row per boilerplate line: ``host``, ``line`` (its key)."""
    keys = F.array_distinct(F.transform(F.filter(F.split(text, "\n"), lambda x: ~_is_blank(x)), _line_key))
    lists = pages.select(F.col(host).alias("host"), keys.alias("keys"), _page_key(text).alias("page")).dropDuplicates(["host", "page"])
    counted = pages.select(F.col(host).alias("host_"), _page_key(text).alias("page")).distinct()
    lines = lists.select("host", F.explode("keys").alias("line"))
    counts = lines.groupBy("host", "line").agg(F.count("*").alias("n")).filter(F.col("n") >= min_pages)
    totals = counted.groupBy("host_").agg(F.count("*").alias("pages"))
    return (
        counts.join(totals, F.col("host").eqNullSafe(F.col("host_")))
        .filter(F.col("n") > F.lit(ratio) * F.col("pages"))
        .select("host", "line")
    )


def drop_boilerplate_lines(
    pages: DataFrame, host: str = "source", text: str = "text", ratio: float = RATIO, min_pages: int = MIN_PAGES, dropped: str | None = None
) -> DataFrame:
    """``pages`` with the boilerplate lines taken out of ``text``; all rows and columns stay.

    Lines are compared without blanks at their ends. A line counts once per host and distinct text, also where rows
    are repeated. A line on exactly ``ratio`` of the pages stays. Rows without a host form a host of their own. Null
    and empty texts have no lines and stay as they are, blank lines are never dropped. A page on which nothing but
    blank lines would be left stays whole for near-duplicate detection. ``dropped`` names an added column with the
    number of lines dropped (an existing column of that name is replaced). An empty table gives no rows.
    """
    lines = materialise(boilerplate_lines(pages, host, text, ratio, min_pages))
    found = lines.groupBy("host").agg(F.collect_list("line").alias("lines"))
    if lines.count() <= BROADCAST_ROWS:  # 16 bytes a line: the pages need not be shuffled
        found = F.broadcast(found)
    rows = pages.select(F.struct(*(F.col(f"`{c}`") for c in pages.columns)).alias("row"))  # no column name can clash
    body = F.col("row").getField(text)
    all_lines = F.split(body, "\n")
    kept = F.filter(all_lines, lambda x: _is_blank(x) | ~F.array_contains(F.col("lines"), _line_key(x)))
    out = rows.join(found, F.col("row").getField(host).eqNullSafe(F.col("host")), "left").select(
        "row", F.when(F.col("lines").isNotNull() & body.isNotNull(), kept).alias("kept")
    )
    cut = F.exists("kept", lambda x: ~_is_blank(x)) & (F.size("kept") < F.size(all_lines))
    cols = [F.col("row").getField(c).alias(c) for c in pages.columns if c not in (text, dropped)]
    cols.append(F.when(cut, F.array_join("kept", "\n")).otherwise(body).alias(text))
    if dropped:
        cols.append(F.when(cut, F.size(all_lines) - F.size("kept")).otherwise(0).cast("long").alias(dropped))
    names = [c for c in pages.columns if c != dropped] + ([dropped] if dropped else [])
    return out.select(*cols).select(*(F.col(f"`{c}`") for c in names))
