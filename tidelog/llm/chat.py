"""Conversations as training windows: escaped template, budgeted spans, repeated history, loss mask. Expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUDGET, HISTORY = 512, 128  # tokens of a window, and of the turns repeated in it
TURN_TOKENS = 4  # of the marks around a turn
# Words and single marks; white space is written out as engines differ in its shorthand.
TOKEN = r"[\p{L}\p{N}]+|[^\x09-\x0D\x20\p{L}\p{N}]"
ASSISTANT, SYSTEM, END = "assistant", "system", "</turn>\n"
TOGETHER = 64  # turns numbered in one task; sums over such blocks give each its start


def escape(text: Column) -> Column:
    """Reversible; no mark of the template is left in the text."""
    for mark in "\\<>":
        text = F.replace(text, F.lit(mark), F.lit("\\" + mark))
    return text


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def written(role: Column, text: Column) -> Column:
    """A turn in the template; role and text are escaped."""
    return F.concat(F.lit("<turn "), role, F.lit(">\n"), text, F.lit(END))


def numbered(convs: DataFrame) -> DataFrame:
    """Turns with their number in the conversation (at) and the tokens before (s) and after (e) them."""
    by = ["turn", "role", "text"]
    turns = convs.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    turns = turns.withColumn("size", F.regexp_count("text", F.lit(TOKEN)).cast("long") + TURN_TOKENS).withColumn(
        "block", F.floor(F.col("turn") / TOGETHER))
    blocks = turns.groupBy("conv_id", "block").agg(F.sum("size").alias("sum"), F.count("*").alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("block")
    blocks = blocks.select(F.col("conv_id").alias("c"), F.col("block").alias("b"),
                           (F.sum("sum").over(earlier) - F.col("sum")).alias("s0"), (F.sum("n").over(earlier) - F.col("n")).alias("n0"))
    inside = Window.partitionBy("conv_id", "block").orderBy(*by)
    turns = turns.withColumn("at", F.row_number().over(inside)).withColumn(
        "e", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    same = F.col("conv_id").eqNullSafe(F.col("c")) & F.col("block").eqNullSafe(F.col("b"))
    return turns.join(blocks, same).select("conv_id", (F.col("n0") + F.col("at")).alias("at"), "role", "text",
                                           (F.col("s0") + F.col("e") - F.col("size")).alias("s"), (F.col("s0") + F.col("e")).alias("e"))


def windows(convs: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """(conv_id, first, n_repeated, n_new, formatted, loss): the windows of every conversation.

    ``convs`` has conv_id, turn, role, text; other columns are ignored. Turns are in order of turn,
    equal ones in order of role and text; a repeated row is a turn of its own; null role or text is
    empty; rows with null conv_id are one conversation, null turn comes first. Prefix sums of turn
    tokens cut a conversation into cells: turns that lie in one cell are a span, a turn that crosses
    into the next is a span of its own, so spans keep to the cell or are one turn, which is never
    cut. A window is the first system turn, if that is earlier, then earlier turns of at most
    ``history`` tokens in a row, then the span. ``loss`` has start (from 1) and length of the
    assistant texts of the span in ``formatted``; repeated turns have none. With cells of
    budget - history - system tokens (a quarter of the budget at least) every window of turns that
    fit keeps to the budget. A group holds two cells of turns, whatever the conversation's length.
    """
    if not 0 <= history <= budget // 4:
        raise ValueError("history takes at most a quarter of the budget")
    turns = numbered(convs).select("conv_id", "at", "s", "e", escape(F.col("role")).alias("role"), escape(F.col("text")).alias("text"),
                                   (F.col("role") == ASSISTANT).alias("learn"), (F.col("role") == SYSTEM).alias("system"))
    first = turns.where("system").groupBy(F.col("conv_id").alias("c")).agg(
        F.min_by(F.struct("at", "role", "text", (F.col("e") - F.col("s")).alias("size")), "at").alias("sys"))
    turns = turns.join(first.select("c", F.col("sys.at").alias("sys_at"), F.col("sys.size").alias("sys_size")),
                       F.col("conv_id").eqNullSafe(F.col("c")), "left").drop("c")
    cell = F.greatest(F.lit(budget - history) - F.coalesce("sys_size", F.lit(0)), F.lit(budget // 4))
    turns = turns.withColumn("cell", F.floor(F.col("s") / cell)).withColumn("crosses", F.floor((F.col("e") - 1) / cell) > F.col("cell"))
    turn = F.struct("at", "s", "e", "role", "text", "learn", "crosses", (F.col("near") == 0).alias("own"))
    cells = turns.withColumn("near", F.explode(F.array(F.lit(0), F.lit(1)))).groupBy(
        "conv_id", (F.col("cell") + F.col("near")).alias("cell"), "sys_at").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    spans = cells.select("conv_id", "sys_at", "turns", F.explode(F.array(F.lit(False), F.lit(True))).alias("crossing")).withColumn(
        "new", F.filter("turns", lambda t: t["own"] & (t["crosses"] == F.col("crossing")))).where("size(new) > 0")
    start = F.col("new")[0]["s"]
    spans = spans.withColumn("old", F.filter("turns", lambda t: (t["e"] <= start) & (t["s"] >= start - history)
                                             & ~t["at"].eqNullSafe(F.col("sys_at")))).drop("turns")
    spans = spans.join(first, F.col("conv_id").eqNullSafe(F.col("c")), "left").drop("c")
    head = F.when(F.col("sys.at") < F.col("new")[0]["at"], F.array(written(F.col("sys.role"), F.col("sys.text")))).otherwise(
        F.array().cast("array<string>"))

    def texts(turns: str) -> Column:
        return F.transform(turns, lambda t: written(t["role"], t["text"]))

    spans = spans.select("conv_id", F.col("new")[0]["at"].alias("first"), "new", F.concat(head, texts("old")).alias("repeated"),
                         texts("new").alias("written"))
    before = F.length(F.array_join("repeated", ""))
    marks = F.length(F.lit("<turn >\n"))

    def mask(t: Column, i: Column) -> Column:
        start = F.aggregate(F.slice("written", F.lit(1), i), F.lit(0), lambda n, w: n + F.length(w)) + before + marks
        return F.struct((start + F.length(t["role"]) + 1).alias("start"), F.length(t["text"]).alias("length"), t["learn"].alias("learn"))

    masks = F.filter(F.transform("new", mask), lambda m: m["learn"])
    return spans.select("conv_id", "first", F.size("repeated").cast("long").alias("n_repeated"), F.size("new").cast("long").alias("n_new"),
                        F.concat(F.array_join("repeated", ""), F.array_join("written", "")).alias("formatted"),
                        F.transform(masks, lambda m: F.struct(m["start"], m["length"])).alias("loss"))


def read_back(formatted: DataFrame) -> DataFrame:
    """``formatted`` windows with what they say: ``said`` (new turns as role and text) and ``learned`` (texts under the mask)."""
    parts = F.slice(F.split("formatted", END), F.col("n_repeated").cast("int") + 1, F.col("n_new").cast("int"))
    role = r"(?s)^<turn ((?:[^\\>]++|\\.)*+)>\n"
    turns = F.transform(parts, lambda p: F.struct(unescape(F.regexp_extract(p, role, 1)).alias("role"),
                                                  unescape(F.regexp_replace(p, role, "")).alias("text")))
    learned = F.transform("loss", lambda m: unescape(F.substring(F.col("formatted"), m["start"], m["length"])))
    return formatted.withColumn("said", turns).withColumn("learned", learned)


def digests(formatted: DataFrame) -> DataFrame:
    """Per conversation what its windows say, as digests.

    A digest of a whole conversation needs its text in one row: this is the only step that gathers
    one, and only for checks; ``windows`` never does.
    """
    back = read_back(formatted).select(
        "conv_id", "n_new", F.length("formatted").cast("long").alias("chars"),
        F.struct("first", F.array_join(F.transform("said", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").alias("said"),
                 F.array_join("learned", "").alias("learned")).alias("window"))
    whole = back.groupBy("conv_id").agg(F.sum("n_new").alias("n_turns"), F.sum("chars").alias("formatted_chars"),
                                        F.array_sort(F.collect_list("window")).alias("windows"))
    said = F.array_join(F.transform("windows", lambda w: w["said"]), "")
    learned = F.array_join(F.transform("windows", lambda w: w["learned"]), "")
    return whole.select("conv_id", "n_turns", F.sha2(said, 256).alias("turns_sha256"), F.length(learned).cast("long").alias("loss_chars"),
                        F.sha2(learned, 256).alias("loss_sha256"), "formatted_chars")
