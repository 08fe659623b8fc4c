"""Chat formatting into budgeted windows.

Prefix sums of the turns' tokens choose turn-aligned windows: with ``step`` =
half of what the budget leaves beside the system turn and the history, a turn
that starts at token ``a`` belongs to window ``a div step``; a turn longer than
``step`` has a window to itself.  So a window holds less than ``2 * step``
tokens of new turns (only one turn longer than the budget can exceed it; texts
are never cut).  Every window starts with the conversation's system turn, then
repeats the turns of the window before that fit in ``history`` tokens.  The
loss mask covers the assistant texts of new turns: repeated ones are left out.

Prefix sums run in two levels (inside blocks of ``BLOCK_TURNS`` turn numbers,
then over the blocks), so a conversation that holds a third of all rows is
dealt over many tasks.

Template: ``### <role>: <text></turn>\\n``.  Inside texts and roles a
backslash is written ``\\\\``, ``<`` ``\\l`` and ``#`` ``\\h``; in roles also ``:``
``\\c``.  No unescaped mark can then stand in a text, and ``unescape`` undoes it.

Only DataFrame operations.  Defined results: a null role or text is empty;
turns are ordered by turn (null first), role, text; rows repeated in full are
turns of their own; a null conv_id is a conversation like others; an empty table
gives no window; other columns are ignored."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUDGET = 1024
HISTORY = 256
BLOCK_TURNS = 64
END = "</turn>\n"
MARK_TOKENS = 4


def escape(text: Column, role: bool = False) -> Column:
    out = F.replace(F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<"), F.lit("\\l")), F.lit("#"), F.lit("\\h"))
    return F.replace(out, F.lit(":"), F.lit("\\c")) if role else out


def unescape(text: Column) -> Column:
    """Undo ``escape``: pairs of backslashes are found first, from the left."""
    def marks(part: Column) -> Column:
        out = F.replace(F.replace(part, F.lit("\\l"), F.lit("<")), F.lit("\\h"), F.lit("#"))
        return F.replace(out, F.lit("\\c"), F.lit(":"))
    return F.array_join(F.transform(F.split(text, r"\\\\"), marks), "\\")


def tokens_of(text: Column) -> Column:
    """Words of a text and its marks: a count that Spark computes on its own."""
    return F.size(F.filter(F.split(text, r"\s+"), lambda w: w != "")) + MARK_TOKENS


def _placed(turns: DataFrame, history: int, budget: int) -> DataFrame:
    """Every turn with its number, start token, window key and its conversation's system turn."""
    rows = turns.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce(F.floor(F.col("turn") / BLOCK_TURNS), F.lit(-(1 << 62))).alias("block")).withColumn("tokens", tokens_of(F.col("text")))
    order = Window.partitionBy("conv_id", "block").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    rows = rows.withColumns({"k": F.row_number().over(order), "upto": F.sum("tokens").over(order.rowsBetween(Window.unboundedPreceding, 0))})
    first = F.min(F.when(F.col("k") == 1, F.struct("k", "role", "text", "tokens"))).alias("first")
    blocks = rows.groupBy("conv_id", "block").agg(F.sum("tokens").alias("sum"), F.count(F.lit(1)).alias("n"), first)
    over = Window.partitionBy("conv_id").orderBy("block")
    before = over.rowsBetween(Window.unboundedPreceding, -1)
    whole = over.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    blocks = blocks.select(
        F.col("conv_id").alias("c"), F.col("block").alias("b"), F.coalesce(F.sum("sum").over(before), F.lit(0)).alias("base"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base_n"), F.sum("n").over(whole).alias("n_turns"),
        F.first("first").over(whole).alias("head"))
    blocks = blocks.withColumn("head", F.when(F.col("head.role") == "system", F.col("head")))
    rows = rows.join(blocks, rows["conv_id"].eqNullSafe(blocks["c"]) & (rows["block"] == blocks["b"]))
    step = F.greatest(F.lit(1), F.floor((budget - history - F.coalesce(F.col("head.tokens"), F.lit(0))) / 2)).cast("long")
    rows = rows.withColumns({"n": F.col("base_n") + F.col("k"), "a": F.col("base") + F.col("upto") - F.col("tokens"), "step": step})
    return rows.withColumns({
        "window": F.floor(F.col("a") / F.col("step")) * 2 + (F.col("tokens") > F.col("step")).cast("long"),
        "is_head": F.col("head").isNotNull() & (F.col("n") == 1)}).select(
        "conv_id", "n", "a", "role", "text", "tokens", "window", "is_head", "head", "n_turns")


def format_windows(turns: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """One row per window: conv_id, window (ascending in the conversation),
    formatted, mask (spans of code points, end exclusive), n_repeated
    (leading turns that an earlier window has too), n_turns, tokens."""
    rows = _placed(turns, history, budget)
    rows = rows.filter(~F.col("is_head") | (F.col("n_turns") == 1))
    spans = rows.groupBy("conv_id", "window").agg(F.min("a").alias("first"))
    over = Window.partitionBy("conv_id").orderBy("window")
    nexts = spans.select(F.col("conv_id").alias("c"), F.col("window").alias("w"), F.lead("window").over(over).alias("next"),
                         F.lead("first").over(over).alias("next_first"), (F.row_number().over(over) == 1).alias("opens"))
    rows = rows.join(nexts, rows["conv_id"].eqNullSafe(nexts["c"]) & (rows["window"] == nexts["w"]))
    again = F.col("next").isNotNull() & (F.col("next_first") - F.col("a") <= history)
    places = F.when(again, F.array(F.struct(F.col("window").alias("w"), F.lit(False).alias("old"), "opens"),
                                   F.struct(F.col("next").alias("w"), F.lit(True).alias("old"), F.lit(False).alias("opens")))).otherwise(
        F.array(F.struct(F.col("window").alias("w"), F.lit(False).alias("old"), "opens")))
    dealt = rows.select("conv_id", "n", "role", "text", "tokens", "head", "is_head", F.explode(places).alias("p"))
    turn = F.struct("n", F.col("p.old").alias("old"), "role", "text", "tokens")
    grouped = dealt.groupBy("conv_id", F.col("p.w").alias("window")).agg(
        F.sort_array(F.collect_list(turn)).alias("turns"), F.first("head").alias("head"), F.max("p.opens").alias("opens"), F.max("is_head").alias("alone"))
    head = F.array(F.struct(F.lit(0).cast("long").alias("n"), (~F.col("opens")).alias("old"), F.col("head.role").alias("role"),
                            F.col("head.text").alias("text"), F.col("head.tokens").alias("tokens")))
    grouped = grouped.withColumn("turns", F.when(F.col("head").isNotNull() & ~F.col("alone"), F.concat(head, "turns")).otherwise(F.col("turns")))
    grouped = grouped.withColumn("parts", F.transform("turns", lambda t: F.struct(
        F.concat(F.lit("### "), escape(t["role"], role=True), F.lit(": ")).alias("open"), escape(t["text"]).alias("body"),
        ((t["role"] == "assistant") & ~t["old"]).alias("loss"))))
    formatted = F.array_join(F.transform("parts", lambda p: F.concat(p["open"], p["body"], F.lit(END))), "")
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def add(acc: Column, p: Column) -> Column:
        start = acc["at"] + F.length(p["open"])
        end = start + F.length(p["body"])
        return F.struct((end + len(END)).alias("at"), F.when(
            p["loss"], F.concat(acc["spans"], F.array(F.struct(start.alias("start"), end.alias("end"))))).otherwise(acc["spans"]).alias("spans"))

    return grouped.select(
        "conv_id", "window", formatted.alias("formatted"), F.aggregate("parts", zero, add)["spans"].alias("mask"),
        F.size(F.filter("turns", lambda t: t["old"])).alias("n_repeated"), F.size("turns").alias("n_turns"),
        F.aggregate("turns", F.lit(0).cast("long"), lambda s, t: s + t["tokens"]).alias("tokens"))


def read_windows(windows: DataFrame) -> DataFrame:
    """Per window, read back from its text: ``turns`` (role, text) new in this
    window and ``targets``, the texts under the loss mask, all unescaped."""
    whole = F.filter(F.split("formatted", "</turn>\n"), lambda p: p != "")

    def parse(part: Column) -> Column:
        opened = F.instr(part, ": ")
        return F.struct(unescape(F.substring(part, F.lit(5), opened - 5)).alias("role"),
                        unescape(F.substring(part, opened + 2, F.length(part))).alias("text"))

    return windows.select(
        "conv_id", "window", F.transform(F.slice(whole, F.col("n_repeated") + 1, F.size(whole)), parse).alias("turns"),
        F.transform("mask", lambda s: unescape(F.substring(F.col("formatted"), s["start"] + 1, s["end"] - s["start"]))).alias("targets"),
        F.length("formatted").alias("chars"))


def conversation_digests(windows: DataFrame) -> DataFrame:
    """One row per conversation, from the windows' text: n_turns, digests of
    all turns and of all text under the loss mask, and the characters formatted."""
    read = read_windows(windows)
    per = read.select("conv_id", "window", "chars", F.size("turns").alias("n"), F.array_join(F.transform(
        "turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").alias("said"), F.array_join("targets", "").alias("taught"))
    conv = per.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("window", "said", "taught"))).alias("w"),
                                      F.sum("n").alias("n_turns"), F.sum("chars").alias("formatted_chars"))
    taught = F.array_join(F.col("w.taught"), "")
    return conv.select("conv_id", "n_turns", F.sha2(F.array_join(F.col("w.said"), "").cast("binary"), 256).alias("turns_sha256"),
                       F.length(taught).cast("long").alias("loss_chars"), F.sha2(taught.cast("binary"), 256).alias("loss_sha256"), "formatted_chars")
