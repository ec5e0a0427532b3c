r"""Chat formatting in budgeted, turn-aligned windows, in DataFrame functions alone.

Template: each turn is ``<|role|>text</s>``. In roles and texts a backslash goes
before each ``\ < | >`` and inside ``[INST]`` and ``[/INST]``, so no control string
of this or a like template survives inside a text, and dropping each escaping
backslash gives the text back.

Windows: the running sum of turn tokens of a conversation, without its system turn,
is cut into cells of ``budget - history - system`` tokens. The turns inside a
cell make a window; a turn across the border of two cells makes one of its own. A
window so holds a contiguous span of whole turns, within the budget unless one
turn alone is larger. Before its span a window repeats the system turn and as
many of the turns just before as fit into ``history`` tokens. Only the span's
assistant texts are under the loss mask, so each is a target exactly once.

Prefix sums go by blocks of ``BLOCK_TURNS`` turn numbers, and history is joined on
bins of token positions, so a conversation with very many turns is the work of
many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regiocube.llm.common import stored

BUDGET = 1024
HISTORY = 192
BLOCK_TURNS = 256
#: Tokens that the marks of a turn cost.
TURN_TOKENS = 4
TARGET_ROLE = "assistant"
SYSTEM_ROLE = "system"

_SYSTEM, _REPEATED, _NEW = 0, 1, 2


def escaped(text: Column) -> Column:
    """The text with no control string left in it."""
    marks = F.regexp_replace(text, r"[\\<|>]", r"\\$0")
    return F.regexp_replace(marks, r"\[(?=/?INST\])", r"[\\")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def turn_tokens(text: Column) -> Column:
    """Tokens of a turn: one for each four bytes begun, and those of its marks."""
    return F.floor((F.octet_length(text) + 3) / 4).cast("long") + TURN_TOKENS


def _placed_turns(rows: DataFrame) -> DataFrame:
    """Turns with ``start``, the tokens before them in their conversation, and ``system``, the tokens of
    its system turn: blocks are summed, then turns in a block."""
    order = [F.col("turn").asc_nulls_first(), "role", "text"]
    of_system = F.when(F.col("role") == SYSTEM_ROLE, F.col("tokens")).otherwise(0)
    rows = rows.withColumn("tokens", turn_tokens(F.col("text"))).withColumn(
        "block", F.coalesce(F.floor(F.col("turn") / BLOCK_TURNS), F.lit(-(1 << 62))))
    before = Window.partitionBy("key").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = Window.partitionBy("key").orderBy("block")
    base = (rows.groupBy("key", "block").agg(
        F.sum("tokens").alias("held"), F.min_by(of_system, F.struct("turn", "role", "text")).alias("first"))
        .select("key", "block", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("base"),
                F.first("first").over(blocks).alias("system")))
    inside = Window.partitionBy("key", "block").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return rows.join(base, ["key", "block"]).withColumn(
        "start", F.col("base") + F.coalesce(F.sum("tokens").over(inside), F.lit(0))).drop("block", "base")


def chat_windows(conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """(conv_id, window, formatted, targets, n_repeated, n_tokens): the formatted windows of every conversation.

    ``targets`` are the extents array<struct<start, length>> (code points of
    ``formatted``) under the loss mask, ``n_repeated`` the leading turns that earlier
    windows hold already.

    - null text or role: empty; an empty assistant text is an empty target;
    - null conv_id: one conversation; null turn: before all others;
    - equal turn numbers: by role, then text; repeated rows: turns each;
    - only a first turn of role ``system`` is kept in every window; a conversation of that turn alone is one window;
    - a turn beyond the budget: whole, in a window that exceeds it;
    - empty table: empty result; other columns are not looked at.
    """
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("key"),
        F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    turns = stored(_placed_turns(rows), "turns")
    is_system = (F.col("start") == 0) & (F.col("role") == SYSTEM_ROLE)
    step = F.greatest(F.lit(budget - history) - F.col("system"), F.lit(max(1, budget // 8)))
    begin = F.col("start") - F.col("system")
    cell = F.floor(begin / F.col("step"))
    across = F.floor((begin + F.col("tokens") - 1) / F.col("step")) != cell
    spans = (turns.where(~is_system).withColumn("step", step)
             .withColumn("window", (cell * 2 + across.cast("int")).cast("long")))
    new = spans.select("key", "conv_id", "window", "start", "system", "tokens", "role", "text", F.lit(_NEW).alias("kind"))
    # Where each window's span begins, by bins of token positions. A turn is
    # repeated where a span begins at most ``history`` tokens after the turn's start.
    begins = spans.groupBy("key", "window").agg(F.min("start").alias("begins"))
    binned = begins.withColumn("bin", F.floor(F.col("begins") / history))
    reach = spans.withColumn("bin", F.explode(F.sequence(F.floor((F.col("start") + F.col("tokens")) / history),
                                                         F.floor((F.col("start") + history) / history)))) \
        if history else spans.limit(0).withColumn("bin", F.lit(0))
    fits = reach.where(F.col("tokens") <= history).drop("window")
    repeated = (fits.join(binned, ["key", "bin"])
                .where((F.col("begins") >= F.col("start") + F.col("tokens")) & (F.col("begins") <= F.col("start") + history))
                .select("key", "conv_id", "window", "start", "system", "tokens", "role", "text", F.lit(_REPEATED).alias("kind")))
    kept = (turns.where(is_system).join(begins, "key", "left")
            .select("key", "conv_id", F.coalesce("window", F.lit(0)).alias("window"), "start", "system", "tokens", "role", "text",
                    F.lit(_SYSTEM).alias("kind")))
    head = F.concat(F.lit("<|"), escaped(F.col("role")), F.lit("|>"))
    body = escaped(F.col("text"))
    pieces = new.union(repeated).union(kept).select(
        "key", "conv_id", "window", "tokens", "kind", "start", F.concat(head, body, F.lit("</s>")).alias("piece"),
        F.char_length(head).alias("head"), F.char_length(body).alias("body"),
        ((F.col("kind") == _NEW) & (F.col("role") == TARGET_ROLE)).alias("target"),
        # The conversation's first window is the one whose span begins at its first token.
        F.when(F.col("kind") == _NEW, F.col("start") > F.col("system")).alias("later"))
    # A window holds at most about budget / TURN_TOKENS turns.
    held = pieces.groupBy("key", "conv_id", "window").agg(
        F.sort_array(F.collect_list(F.struct("start", "piece", "head", "body", "target", "kind"))).alias("turns"),
        F.sum("tokens").alias("n_tokens"), F.coalesce(F.min("later"), F.lit(False)).alias("later"))
    lengths = F.transform("turns", lambda t: F.char_length(t["piece"]))
    offset = lambda i: F.aggregate(F.slice(lengths, F.lit(1), i), F.lit(0), lambda a, x: a + x)
    extents = F.transform("turns", lambda t, i: F.struct((offset(i) + t["head"]).cast("long").alias("start"),
                                                         t["body"].cast("long").alias("length"), t["target"].alias("target")))
    # The system turn is new in the conversation's first window.
    repeats = F.size(F.filter("turns", lambda t: (t["kind"] == _REPEATED) | ((t["kind"] == _SYSTEM) & F.col("later"))))
    return held.select(
        "conv_id", "window", F.array_join(F.transform("turns", lambda t: t["piece"]), "").alias("formatted"),
        F.transform(F.filter(extents, lambda e: e["target"]),
                    lambda e: F.struct(e["start"].alias("start"), e["length"].alias("length"))).alias("targets"),
        repeats.cast("long").alias("n_repeated"), "n_tokens")


def read_turns(windows: DataFrame) -> DataFrame:
    """(conv_id, window, turns array<struct<role, text>>, targets array<string>, n_chars) parsed from formatted windows.

    ``turns`` are those that the window is the first to hold; ``targets`` the texts under its mask.
    """
    parsed = F.transform(F.filter(F.split("formatted", "</s>"), lambda p: p != ""), lambda p: F.struct(
        unescaped(F.substring_index(F.substring(p, 3, 1 << 30), "|>", 1)).alias("role"),
        unescaped(F.substring(p, F.instr(p, "|>") + 2, F.char_length(p))).alias("text")))
    return windows.select(
        "conv_id", "window", F.slice(parsed, F.col("n_repeated").cast("int") + 1, F.greatest(F.size(parsed), F.lit(1))).alias("turns"),
        F.transform("targets", lambda t: unescaped(F.substring(F.col("formatted"), (t["start"] + 1).cast("int"), t["length"].cast("int"))))
        .alias("targets"), F.char_length("formatted").cast("long").alias("n_chars"))


def conversation_digests(windows: DataFrame) -> DataFrame:
    """One row per conversation, from its formatted windows: turns and targets read back, counted and digested.

    The digests are of a whole conversation's text, so that text meets in one task.
    """
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    by_window = read_turns(windows).select(
        "conv_id", "window", F.size("turns").cast("long").alias("n"), said.alias("said"),
        F.array_join("targets", "").alias("target"), "n_chars")
    joined = lambda c: F.array_join(F.transform(F.col("parts"), lambda p: p[c]), "")
    return (by_window.groupBy("conv_id")
            .agg(F.sort_array(F.collect_list(F.struct("window", "said", "target"))).alias("parts"),
                 F.sum("n").alias("n_turns"), F.sum("n_chars").alias("formatted_chars"))
            .select("conv_id", "n_turns", F.sha2(joined("said"), 256).alias("turns_sha256"),
                    F.char_length(joined("target")).cast("long").alias("loss_chars"),
                    F.sha2(joined("target"), 256).alias("loss_sha256"), "formatted_chars"))
