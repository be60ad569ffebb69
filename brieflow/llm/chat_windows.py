"""Chat formatting in budgeted windows, with DataFrame functions only.

A conversation's turns are numbered in order and their tokens summed up before each (prefix sums). A window holds
whole turns, which the prefix sums choose (see ``_cut``), repeats the conversation's system turn at its head, and
repeats the last turns before it, from whatever windows, as far as their tokens, a difference of two prefix sums, fit the
history budget. Repeated turns are masked, so each assistant text stands under the loss mask exactly once.

No window exceeds the budget unless one turn alone does, which then has a window of its own without any repeats. A quarter of
the budget at least is left to a window's own turns: a system turn that leaves less without history is not repeated, one that leaves
less beside the whole history shortens the history; and a turn so long that the system turn does not fit beside it stands without it.

The template is ``<|im_start|>role\\ntext<|im_end|>\\n``. A backslash goes into every ``<|`` of a text (after the
``<`` and all backslashes that follow it), so texts never hold a control string and are read back exactly; in
roles line feeds and per cent signs are escaped as well.

A long conversation is not gathered in one task: turns are sorted as a whole, summed by portion of the sorted table and then by
portion, and put into windows by equality joins on parts of a conversation. (The digest query does gather each conversation, as
one hash over all its text has to.)

Defined cases: null text and null role count as empty; a null conversation id is a conversation; a null turn
number comes first; turns of equal number are ordered by role and text, and repeated rows are repeated turns;
very long texts are turns like others; an empty table gives no rows; further columns, whatever their names, are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brieflow.llm.common import attach_groups, stored

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
BUDGET = 1024
HISTORY = 256
#: tokens of a turn's marks
MARKS = 4


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", "<$1|")


def escape_role(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def unescape_role(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def token_count(text: Column) -> Column:
    """Words and single other characters of a text."""
    return F.regexp_count(text, F.lit(r"[\p{L}\p{N}]+|[^\s\p{L}\p{N}]")).cast("long")


def _numbered(turns: DataFrame) -> DataFrame:
    """``turns`` in order, stored once, with ``_at`` (unique, ascending) and ``_part`` (the portion of the sorted table).
    Turns are sorted as a whole, so a conversation of any length, or turns of equal number, are dealt to many tasks."""
    order = [F.asc_nulls_first("_c"), F.asc_nulls_first("_turn"), F.asc("_role"), F.asc("_text")]
    ordered = turns.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()).withColumn("_part", F.spark_partition_id())
    return stored(ordered, "turns")


def _summed(ordered: DataFrame) -> DataFrame:
    """``_c``, ``_at``, ``_tokens``, ``_pos`` (from 1) and ``_sum`` (tokens before the turn within its conversation), and of
    the first turn, if it is the system's, ``_head``: prefix sums within a portion, then over the portions' totals."""
    narrow = ordered.select("_c", "_at", "_part", "_tokens", (F.col("_role") == "system").alias("_is_system"))
    totals = narrow.groupBy("_c", "_part").agg(F.count("*").alias("_rows"), F.sum("_tokens").alias("_total"))
    before = Window.partitionBy("_c").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row per portion at most
    totals = totals.select("_c", "_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_rows0"), F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_sum0"))
    inside = Window.partitionBy("_c", "_part").orderBy("_at")
    earlier = inside.rowsBetween(Window.unboundedPreceding, -1)
    own = narrow.withColumn("_n", F.row_number().over(inside)).withColumn("_s", F.coalesce(F.sum("_tokens").over(earlier), F.lit(0)))
    summed = own.join(totals, ["_c", "_part"]).select("_c", "_at", "_tokens", (F.col("_rows0") + F.col("_n")).alias("_pos"), (F.col("_sum0") + F.col("_s")).alias("_sum"), "_is_system")
    return summed.withColumn("_head", (F.col("_pos") == 1) & F.col("_is_system")).drop("_is_system")


def _cut(summed: DataFrame, total: int, budget: int, history: int) -> DataFrame:
    """Adds ``_window``, ``_system`` (tokens of the system turn that is repeated, else 0) and ``_history`` (of the conversation).

    The prefix sums are laid on a grid whose cells are as wide as the room for a window's own turns. Turns within one cell
    make a window; of the turns that reach over a cell's end there is one, which joins the window of the cell that it
    starts in, or else of the cell that it ends in, if it fits there, or else has a window of its own. A cell's window
    depends on its own turns and the one that reaches into it, so all is equality joins on (conversation, cell).
    """
    conversations = summed.groupBy("_c").agg(F.count("*").alias("_size"), F.coalesce(F.max(F.when(F.col("_head"), F.col("_tokens"))), F.lit(0)).alias("_said"))
    system = F.when(F.col("_said") <= budget - budget // 4, F.col("_said")).otherwise(F.lit(0))
    least = F.least(F.lit(history), F.lit(budget - budget // 4) - F.col("_system"))
    conversations = stored(conversations.withColumn("_system", system).withColumn("_history", least).drop("_said"), "conversations")
    own = attach_groups(summed, conversations, "_c", "_size", total).drop("_size")
    room = F.lit(budget) - F.col("_system") - F.col("_history")
    own = stored(own.withColumn("_room", room).withColumn("_from", F.floor(F.col("_sum") / room)).withColumn("_to", F.floor((F.col("_sum") + F.col("_tokens") - 1) / room)), "grid")
    over = F.col("_to") > F.col("_from")
    cells = (own.groupBy("_c", F.col("_from").alias("_cell"))
             .agg(F.coalesce(F.sum(F.when(~over, F.col("_tokens"))), F.lit(0)).alias("_inside"), F.max(F.when(over, F.col("_tokens"))).alias("_out"),
                  F.max(F.when(over, F.col("_at"))).alias("_out_at"), F.max(F.when(over, F.col("_to"))).alias("_out_to"), F.first("_room").alias("_room")))
    back = F.coalesce((F.col("_inside") > 0) & (F.col("_inside") + F.col("_out") <= F.col("_room")), F.lit(False))
    cells = stored(cells.withColumn("_back", back), "cells")
    used = cells.select("_c", F.col("_cell").alias("_out_to"), (F.col("_inside") + F.when(F.col("_back"), F.col("_out")).otherwise(F.lit(0))).alias("_used"), (F.col("_inside") > 0).alias("_any"))
    joins = F.coalesce(F.col("_any") & (F.col("_used") + F.col("_out") <= F.col("_room")), F.lit(False))
    reaching = (cells.filter("_out is not null").join(used, ["_c", "_out_to"], "left")
                .select("_c", F.col("_out_at").alias("_at"), F.when(F.col("_back"), 2 * F.col("_cell") + 1).when(joins, 2 * F.col("_out_to") + 1)
                        .otherwise(2 * F.col("_cell") + 2).alias("_window")))
    kept = ["_c", "_at", "_tokens", "_pos", "_sum", "_head", "_system", "_history"]
    return (own.filter(~over).select(*kept, (2 * F.col("_from") + 1).alias("_window"))
            .unionByName(own.filter(over).select(*kept).join(reaching, ["_c", "_at"])))


def _repeats(placed: DataFrame, windows: DataFrame, history: int) -> DataFrame:
    """The earlier turns that windows repeat: those whose prefix sum lies at most the window's history below its start.
    They meet in buckets of the prefix sums, however many windows the history reaches over."""
    if history <= 0:
        return placed.select("_c", "_at", "_pos", "_window").limit(0)
    bucket = lambda s: F.floor(s / history)
    asked = (windows.filter("_start > 0 and _most > 0").select("_c", "_window", "_start", "_most", "_with_system", F.explode(F.sequence(
        bucket(F.greatest(F.col("_start") - F.col("_most"), F.lit(0))), bucket(F.col("_start") - 1))).alias("_bucket")))
    told = placed.select("_c", "_at", "_pos", "_sum", "_head", bucket(F.col("_sum")).alias("_bucket"))
    near = (F.col("_sum") < F.col("_start")) & (F.col("_sum") >= F.col("_start") - F.col("_most")) & ~(F.col("_head") & F.col("_with_system"))
    return told.join(asked, ["_c", "_bucket"]).filter(near).select("_c", "_at", "_pos", "_window")


def chat_windows(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
                 budget: int = BUDGET, history: int = HISTORY, learned: str = "assistant") -> DataFrame:
    """One row per window: the conversation's id, ``window`` (ascending, not dense), ``formatted``, ``n_repeated``
    (turns at the head that are repeated) and ``loss`` (code point spans of the text under the loss mask)."""
    rows = turns.select(F.col(conv_col).alias("_c"), F.col(turn_col).alias("_turn"), F.coalesce(role_col, F.lit("")).alias("_role"), F.coalesce(text_col, F.lit("")).alias("_text"))
    # a null id is a conversation too, but equality joins need a key
    rows = rows.withColumn("_conv", F.col("_c")).withColumn("_c", F.coalesce(F.concat(F.lit("c"), F.col("_conv").cast("string")), F.lit("null")))
    ordered = _numbered(rows.withColumn("_tokens", token_count(F.col("_text")) + MARKS))
    summed = stored(_summed(ordered), "prefix-sums")
    total = summed.count()
    placed = stored(_cut(summed, total, budget, history), "placed-turns")
    windows = placed.groupBy("_c", "_window").agg(F.min("_sum").alias("_start"), F.sum("_tokens").alias("_own"), F.first("_system").alias("_system"), F.first("_history").alias("_history"))
    with_system = (F.col("_start") > 0) & (F.col("_system") > 0) & (F.col("_own") + F.col("_system") <= budget)
    left = F.lit(budget) - F.col("_own") - F.when(F.col("_with_system"), F.col("_system")).otherwise(F.lit(0))
    windows = stored(windows.withColumn("_with_system", with_system).withColumn("_most", F.greatest(F.least("_history", left), F.lit(0))), "windows")
    target = F.struct("_window", F.lit(True).alias("_again"))
    again = _repeats(placed, windows, history).groupBy("_at").agg(F.collect_list(target).alias("_others"))  # at most history / MARKS windows
    where = placed.join(again, "_at", "left").select("_at", "_pos", F.concat(
        F.array(F.struct("_window", F.lit(False).alias("_again"))), F.coalesce("_others", F.array().cast("array<struct<_window:bigint,_again:boolean>>"))).alias("_targets"))
    members = (ordered.select("_c", "_conv", "_at", "_role", "_text").join(where, "_at")
               .select("_c", "_conv", "_pos", "_role", "_text", F.explode("_targets").alias("_k")).select("_c", "_conv", "_k.*", "_pos", "_role", "_text"))
    heads = placed.filter("_head and _system > 0").select("_c", "_at").join(ordered.filter("_role = 'system'").select("_at", "_conv", "_role", "_text"), "_at").drop("_at")
    heads = stored(heads.join(windows.filter("_with_system").groupBy("_c").agg(F.count("*").alias("_uses")), "_c"), "system-turns")
    system = attach_groups(windows.filter("_with_system").select("_c", "_window"), heads, "_c", "_uses", total).select(
        "_c", "_conv", "_window", F.lit(True).alias("_again"), F.lit(0).cast("long").alias("_pos"), "_role", "_text")
    gathered = members.unionByName(system).groupBy("_c", "_window").agg(
        F.first("_conv").alias("_conv"), F.array_sort(F.collect_list(F.struct("_pos", "_again", "_role", "_text"))).alias("_turns"))
    head = lambda t: F.concat(F.lit(OPEN), escape_role(t["_role"]), F.lit("\n"))
    tail = F.lit(CLOSE + "\n")
    parts = F.transform("_turns", lambda t: F.struct(head(t).alias("head"), escape(t["_text"]).alias("body"), (~t["_again"] & (t["_role"] == learned)).alias("loss")))
    empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def mask(s: Column, p: Column) -> Column:
        start = s["at"] + F.length(p["head"])
        end = start + F.length(p["body"])
        spans = F.when(p["loss"], F.concat(s["spans"], F.array(F.struct(start.alias("start"), end.alias("end"))))).otherwise(s["spans"])
        return F.struct((end + F.length(tail)).alias("at"), spans.alias("spans"))

    return gathered.withColumn("_parts", parts).select(
        F.col("_conv").alias(conv_col), F.col("_window").alias("window"),
        F.array_join(F.transform("_parts", lambda p: F.concat(p["head"], p["body"], tail)), "").alias("formatted"),
        F.size(F.filter("_turns", lambda t: t["_again"])).alias("n_repeated"),
        F.aggregate("_parts", empty, mask, lambda s: s["spans"]).alias("loss"))


def read_turns(formatted: Column) -> Column:
    """The turns (``role``, ``text``) of a formatted window."""
    pieces = F.filter(F.split(formatted, r"<\|im_start\|>", -1), lambda p, i: i > 0)

    def turn(p: Column) -> Column:
        cut = F.instr(p, "\n")
        return F.struct(unescape_role(F.substring(p, F.lit(1), cut - 1)).alias("role"),
                        unescape(F.substring(p, cut + 1, F.length(p) - cut - len(CLOSE) - 1)).alias("text"))

    return F.transform(pieces, turn)


def chat_digest(windows: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """Per conversation, read back from its windows: ``n_turns``, ``turns_sha256``, ``loss_chars``, ``loss_sha256``
    and ``formatted_chars``."""
    own = F.filter(read_turns(F.col("formatted")), lambda t, i: i >= F.col("n_repeated"))
    shown = F.array_join(F.transform(own, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learned = F.array_join(F.transform("loss", lambda s: unescape(F.substring(F.col("formatted"), s["start"] + 1, s["end"] - s["start"]))), "")
    read = windows.select(conv_col, F.struct("window", F.size(own).alias("n"), shown.alias("shown"), learned.alias("learned"), F.length("formatted").alias("chars")).alias("w"))
    all_of = lambda name: F.array_join(F.transform("ws", lambda w: w[name]), "")
    total = lambda name: F.aggregate("ws", F.lit(0).cast("long"), lambda s, w: s + w[name])
    return read.groupBy(conv_col).agg(F.array_sort(F.collect_list("w")).alias("ws")).select(
        conv_col, total("n").alias("n_turns"), F.sha2(all_of("shown"), 256).alias("turns_sha256"),
        F.length(all_of("learned")).cast("long").alias("loss_chars"), F.sha2(all_of("learned"), 256).alias("loss_sha256"), total("chars").alias("formatted_chars"))
