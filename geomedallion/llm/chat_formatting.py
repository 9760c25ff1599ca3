"""Operator 2: chat formatting in budgeted windows, with DataFrame functions only.

A conversation is cut into windows of whole turns. Every window starts with the conversation's system
turn (if its first turn is one), then repeats a limited number of tokens of history, then holds new
turns. The texts of assistants among the new turns are under the loss mask; the repeated system turn
and history never are, so each assistant text is a target exactly once.

Tokens are those of the byte-level BPE that the caller names, counted on the formatted turn with its marks and
escapes (``native_tokens``: exact, but for very long pre-tokens, which count more). Where turns meet, the pre-tokens at
the seam can join; ``SEAM`` tokens a turn cover that, so ``n_tokens`` is never under the tokens of a window's text.

Method: prefix sums of turn tokens give each turn its place on the conversation's token line. The
line is cut into stretches of ``STRETCH`` window capacities; inside a stretch the turns are taken
greedily, a window ending at the last turn whose prefix sum still fits. A turn longer than a window
gets a window of its own (turns are never cut). History is the run of turns before the window whose
prefix sums lie within the history budget.

Scale: a stretch holds a bounded number of tokens (and one long turn at most), so grouping by
(conversation, stretch) never gathers a whole conversation, even one that holds a third of all rows.
The prefix sums have two levels: over blocks of ``BLOCK`` consecutive turn numbers, then within.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geomedallion.llm.common import materialise, steps
from geomedallion.llm.native_tokens import token_counts

# The marks of the template, and the control strings that texts must not contain as such.
START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
CONTROL = r"(<(?=\||/?s>|</?SYS>)|\[(?=/?INST\]))"

BUDGET = 1024
HISTORY = 192
STRETCH = 16
BLOCK = 256
MIN_NEW = 64
SEAM = 2  # "|>" and "<|" are two tokens at least, joined at a seam of two turns four at most


def escape(text: Column) -> Column:
    """Control strings get a backslash after their first character; backslashes are doubled."""
    return F.regexp_replace(F.regexp_replace(text, r"\\", r"\\\\"), CONTROL, r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _prefix_sums(turns: DataFrame) -> DataFrame:
    """``before``: the tokens of the conversation that come before the turn."""
    order = ["turn", "role", "text"]
    blocks = turns.groupBy("conv", "block").agg(F.sum("tokens").alias("block_tokens"))
    earlier = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("conv", "block", F.coalesce(F.sum("block_tokens").over(earlier), F.lit(0)).alias("base"))
    within = Window.partitionBy("conv", "block").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        turns.withColumn("in_block", F.coalesce(F.sum("tokens").over(within), F.lit(0)))
        .alias("t")
        .join(blocks.alias("b"), F.col("t.conv").eqNullSafe(F.col("b.conv")) & F.col("t.block").eqNullSafe(F.col("b.block")))
        .select("t.*", (F.col("in_block") + F.col("base")).alias("before"))
    )


def _system_turns(turns: DataFrame) -> DataFrame:
    """The first turn of each conversation where it is a system turn."""
    first = F.min(F.struct("turn", "role", "text", "tokens")).alias("f")
    return (
        turns.groupBy("conv").agg(first).filter(F.col("f.role") == "system")
        .select("conv", F.col("f.text").alias("sys_text"), F.col("f.tokens").alias("sys_tokens"))
    )


def _greedy(turns: Column, capacity: Column) -> Column:
    """Window number of each new turn of a stretch, by one pass over the prefix sums."""
    start = F.struct(F.array().cast("array<int>").alias("w"), F.lit(-1).alias("n"), F.lit(0).cast("long").alias("open"))

    def step(acc: Column, t: Column) -> Column:
        fits = (acc["n"] >= 0) & (t["before"] + t["tokens"] - acc["open"] <= capacity)
        n = F.when(fits, acc["n"]).otherwise(acc["n"] + 1)
        return F.struct(
            F.concat(acc["w"], F.array(n)).alias("w"), n.alias("n"), F.when(fits, acc["open"]).otherwise(t["before"]).alias("open")
        )

    return F.aggregate(turns, start, step, lambda acc: acc["w"])


def _rendered(role: Column, text: Column) -> Column:
    return F.concat(F.lit(START), escape(role), F.lit(SEP), escape(text), F.lit(END))


def format_windows(
    conversations: DataFrame, ranks: bytes, pattern: str, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    budget: int = BUDGET, history: int = HISTORY, target_role: str = "assistant",
) -> DataFrame:
    """One row per window: ``conv_id, stretch, window, start_token, n_context, n_turns, n_tokens, text, loss_spans``.

    ``ranks`` and ``pattern`` are the byte-level BPE whose tokens the budgets count.
    ``window`` counts from 0 within the conversation's stretch ``stretch``; (stretch, window) is the
    window's order. ``n_context`` is how many turns at its start are repeated. ``loss_spans`` has the
    start and end (code points in ``text``) of each target text. Turns are ordered by turn, role and
    text, nulls first; repeated rows are turns of their own. Null texts and roles count as empty;
    rows without conv_id form one conversation. A window exceeds ``budget`` only if it has a single new
    turn, or if the system turn leaves less than ``MIN_NEW`` tokens for new ones.
    Other columns are not read. An empty table gives no rows.
    """
    with steps() as keep:
        return keep(_windows(conversations, ranks, pattern, conv, turn, role, text, budget, history, target_role))


def _windows(
    conversations: DataFrame, ranks: bytes, pattern: str, conv: str, turn: str, role: str, text: str, budget: int, history: int, target_role: str
) -> DataFrame:
    source = conversations.select(
        F.col(f"`{conv}`").alias("conv"), F.col(f"`{turn}`").cast("long").alias("turn"),
        F.coalesce(F.col(f"`{role}`"), F.lit("")).alias("role"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
    )
    source = materialise(source.withColumn("row", F.monotonically_increasing_id()))
    counts = token_counts(source, "row", _rendered(F.col("role"), F.col("text")), ranks, pattern)
    turns = source.join(counts, "row").drop("row").withColumn("tokens", F.col("tokens") + SEAM)
    turns = materialise(turns.withColumn("block", F.floor(F.col("turn") / BLOCK)))
    placed = _prefix_sums(turns).alias("t").join(
        _system_turns(turns).alias("s"), F.col("t.conv").eqNullSafe(F.col("s.conv")), "left"
    ).select("t.conv", "turn", "role", "text", "tokens", "before", "sys_text", F.coalesce("sys_tokens", F.lit(0)).alias("sys_tokens"))
    capacity = F.greatest(F.lit(budget - history) - F.col("sys_tokens"), F.lit(MIN_NEW))
    placed = placed.withColumn("capacity", capacity).withColumn("length", F.col("capacity") * STRETCH)
    stretch = F.floor(F.col("before") / F.col("length"))
    placed = materialise(placed.withColumn("stretch", stretch))

    # a turn at a stretch's end is also history of the next stretch
    reaches = F.col("before") >= (F.col("stretch") + 1) * F.col("length") - F.lit(history)
    copies = F.when(reaches, F.array(F.struct(F.col("stretch").alias("in"), F.lit(True).alias("new")), F.struct((F.col("stretch") + 1).alias("in"), F.lit(False).alias("new"))))
    copies = copies.otherwise(F.array(F.struct(F.col("stretch").alias("in"), F.lit(True).alias("new"))))
    item = F.struct("before", "turn", "role", "text", "tokens")
    grouped = placed.withColumn("copy", F.explode(copies)).groupBy("conv", F.col("copy.in").alias("stretch")).agg(
        F.first("capacity").alias("capacity"), F.first("sys_text").alias("sys_text"), F.first("sys_tokens").alias("sys_tokens"),
        F.sort_array(F.collect_list(F.when(F.col("copy.new"), item))).alias("new"),
        F.sort_array(F.collect_list(F.when(~F.col("copy.new"), item))).alias("old"),
    ).filter(F.size("new") > 0)

    numbered = grouped.withColumn("numbers", _greedy(F.col("new"), F.col("capacity"))).withColumn("all", F.concat("old", "new"))
    windows = numbered.withColumn("window", F.explode(F.sequence(F.lit(0), F.array_max("numbers"))))
    mine = F.filter(F.col("new"), lambda t, i: F.element_at("numbers", i + 1) == F.col("window"))
    windows = windows.withColumn("mine", mine).withColumn("open", F.col("mine")[0]["before"])
    # the system turn stands at place 0 of the line: it is repeated as such and is no history
    past = F.filter(
        F.col("all"),
        lambda t: (t["before"] < F.col("open")) & (t["before"] >= F.col("open") - F.lit(history)) & ~((t["before"] == 0) & F.col("sys_text").isNotNull()),
    )
    head = F.when(F.col("sys_text").isNotNull() & (F.col("open") > 0), F.array(F.struct(F.lit("system").alias("role"), F.col("sys_text").alias("text"), F.col("sys_tokens").alias("tokens"), F.lit(False).alias("target"))))

    def plain(ts: Column, target: bool) -> Column:
        return F.transform(ts, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"), t["tokens"].alias("tokens"), ((t["role"] == target_role) & F.lit(target)).alias("target")))

    context = F.concat(F.coalesce(head, F.array().cast("array<struct<role:string,text:string,tokens:bigint,target:boolean>>")), plain(past, False))
    windows = windows.select(
        "conv", "stretch", "window", F.col("open").alias("start_token"), F.size(context).alias("n_context"), F.concat(context, plain(F.col("mine"), True)).alias("turns")
    )

    def add(acc: Column, t: Column) -> Column:
        begin = acc["at"] + F.length(F.concat(F.lit(START), escape(t["role"]), F.lit(SEP)))
        end = begin + F.length(escape(t["text"]))
        span = F.struct(begin.cast("long").alias("start"), end.cast("long").alias("end"))
        return F.struct(
            F.when(t["target"], F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"]).alias("spans"),
            (end + len(END)).cast("long").alias("at"),
        )

    empty = F.struct(F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans"), F.lit(0).cast("long").alias("at"))
    return windows.select(
        F.col("conv").alias("conv_id"), "stretch", "window", "start_token", "n_context", F.size("turns").alias("n_turns"),
        F.aggregate("turns", F.lit(0).cast("long"), lambda a, t: a + t["tokens"]).alias("n_tokens"),
        F.array_join(F.transform("turns", lambda t: _rendered(t["role"], t["text"])), "").alias("text"),
        F.aggregate("turns", empty, add, lambda a: a["spans"]).alias("loss_spans"),
    )


def read_back(windows: DataFrame) -> DataFrame:
    """The conversations that the windows hold, without what is repeated: the turns and targets are read from the
    windows' texts, with ``n_context``, ``n_turns`` and ``loss_spans`` to tell what is new and what is a target.
    A conversation comes back as one row, so it must fit in one; the windows themselves are bounded.

    One row per conversation: ``conv_id, n_turns, turns_text`` (role, line feed, text, line feed per
    turn), ``loss_text`` (unescaped text under the loss mask) and ``formatted_chars``.
    """
    mark = r"(?s)\Q" + START + r"\E(.*?)\Q" + SEP + r"\E(.*?)\Q" + END + r"\E"
    roles, texts = (F.regexp_extract_all("text", F.lit(mark), F.lit(i)) for i in (1, 2))
    fresh = F.slice(F.arrays_zip(roles.alias("r"), texts.alias("t")), F.col("n_context") + 1, F.col("n_turns"))
    turns = F.transform(fresh, lambda t: F.concat(unescape(t["r"]), F.lit("\n"), unescape(t["t"]), F.lit("\n")))
    loss = F.transform("loss_spans", lambda s: unescape(F.substring(F.col("text"), s["start"] + 1, s["end"] - s["start"])))
    parts = windows.select(
        "conv_id", "stretch", "window", F.size(turns).alias("n"), F.array_join(turns, "").alias("turns_part"),
        F.array_join(loss, "").alias("loss_part"), F.length("text").alias("chars"),
    )
    ordered = F.sort_array(F.collect_list(F.struct("stretch", "window", "turns_part", "loss_part"))).alias("p")
    return parts.groupBy("conv_id").agg(F.sum("n").alias("n_turns"), F.sum("chars").alias("formatted_chars"), ordered).select(
        "conv_id", "n_turns", F.array_join("p.turns_part", "").alias("turns_text"), F.array_join("p.loss_part", "").alias("loss_text"), "formatted_chars"
    )
