"""Chat formatting in budgeted windows, with DataFrame functions only.

A turn's tokens, summed up over the turns before it, give its place; a window is a stretch
of places as long as the budget, so windows begin and end with turns. A turn that reaches
over the end of a stretch is a window of its own. Every window repeats the system turn and
as many earlier turns as fit the history budget; repeated turns carry no loss, so each
assistant text is a target once.

Running sums are taken in two steps, within blocks of turns and over the blocks, so a
conversation with very many turns is summed by many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
#: Turns of one block of the running sums.
BLOCK = 256


def escaped(text: Column) -> Column:
    """The text without control strings: every ``<|`` and every ``~`` is written with a ``~``."""
    return F.replace(F.replace(text, F.lit("~"), F.lit("~0")), F.lit("<|"), F.lit("<~1"))


def unescaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("~1"), F.lit("|")), F.lit("~0"), F.lit("~"))


def escaped_role(role: Column) -> Column:
    """As :func:`escaped`, and on one line."""
    return F.replace(escaped(role), F.lit("\n"), F.lit("~2"))


def unescaped_role(role: Column) -> Column:
    return unescaped(F.replace(role, F.lit("~2"), F.lit("\n")))


def token_count(text: Column) -> Column:
    """Tokens of a formatted turn by its size: a token per 4 bytes, and 4 for the template."""
    return (F.ceil(F.octet_length(text) / 4) + 4).cast("long")


def windows(
    turns: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    budget: int = 512,
    history: int = 128,
    system: str = "system",
    target: str = "assistant",
) -> DataFrame:
    """(conv, window, n_new, n_repeated, n_tokens, text, loss) per window.

    *text* is the formatted window: the system turn, repeated turns, new turns. *loss* lists
    the stretches (from, to) of it, in code points, that are targets: the texts of new
    *target* turns, still escaped. Turns are taken in the order of (turn, role, text), nulls
    first. A null text or role is empty. Repeated rows are turns of their own. Null
    conversations are one conversation. New turns take at most *budget* tokens, repeated ones
    at most *history*, besides the system turn; a turn longer than the budget is a window of
    its own, whole. The system turn is the first turn if its role is *system*.
    """
    rows = turns.select(
        F.col(conv).alias("conv"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    head = F.concat(F.lit(START), escaped_role(F.col("role")), F.lit("\n"))
    body = escaped(F.col("text"))
    rows = rows.withColumn("head", head).withColumn("body", body)
    rows = rows.withColumn("tokens", token_count(F.concat("head", "body")))
    # Running sums: within blocks of turn numbers, and over the sums of the blocks before.
    rows = rows.withColumn("block", F.coalesce(F.floor(F.col("turn") / BLOCK), F.lit(-(2**40))))
    order = ["turn", "role", "text"]
    inner = Window.partitionBy("conv", "block").orderBy(*order)
    sums = rows.groupBy("conv", "block").agg(F.sum("tokens").alias("t"), F.count("*").alias("n"))
    outer = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        F.col("conv").alias("c"), F.col("block").alias("b"),
        F.coalesce(F.sum("t").over(outer), F.lit(0)).alias("t0"), F.coalesce(F.sum("n").over(outer), F.lit(0)).alias("n0"),
    )
    until = inner.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = (
        rows.withColumn("t1", F.sum("tokens").over(until))
        .withColumn("n1", F.row_number().over(inner))
        .join(offsets, F.col("conv").eqNullSafe(F.col("c")) & (F.col("block") == F.col("b")))
        .withColumn("end", F.col("t0") + F.col("t1"))
        .withColumn("begin", F.col("end") - F.col("tokens"))
        .withColumn("at", F.col("n0") + F.col("n1") - 1)
        .select("conv", "at", "role", "head", "body", "tokens", "begin", "end")
    )
    first = F.floor(F.col("begin") / budget)
    over = F.floor((F.col("end") - 1) / budget) > first
    # Twice the stretch, and one more for a turn that reaches over its end: in order either way.
    placed = placed.withColumn("window", 2 * first + over.cast("long"))
    is_system = (F.col("at") == 0) & (F.col("role") == system)
    turn_row = F.struct("at", "head", "body", (F.col("role") == target).alias("target"), "tokens")
    new = placed.groupBy("conv", "window").agg(
        F.sort_array(F.collect_list(turn_row)).alias("new"), F.min("begin").alias("from")
    )
    # Earlier turns within the history budget: they begin in the stretches before the window.
    # Each turn offers itself to the windows that its distance allows.
    reach = placed.filter(~is_system & (F.col("tokens") <= history)).select(
        F.col("conv").alias("c"), "begin", "at", "head", "body", "tokens",
        F.explode(F.sequence(F.floor(F.col("begin") / budget), F.floor((F.col("end") + history) / budget))).alias("stretch"),
    )
    offered = reach.join(
        new.select("conv", "window", "from", F.floor(F.col("window") / 2).alias("s")),
        F.col("c").eqNullSafe(F.col("conv")) & (F.col("stretch") == F.col("s")),
    ).filter((F.col("begin") < F.col("from")) & (F.col("begin") >= F.col("from") - history))
    repeated = offered.groupBy(F.col("conv").alias("c"), F.col("window").alias("w")).agg(
        F.sort_array(F.collect_list(F.struct("at", "head", "body", F.lit(False).alias("target"), "tokens"))).alias("old")
    )
    leads = placed.filter(is_system).select(F.col("conv").alias("sc"), F.array(F.struct("at", "head", "body", F.lit(False).alias("target"), "tokens")).alias("lead"))
    nothing = F.slice("new", 1, 0)
    joined = (
        new.join(repeated, F.col("conv").eqNullSafe(F.col("c")) & (F.col("window") == F.col("w")), "left")
        .join(leads, F.col("conv").eqNullSafe(F.col("sc")), "left")
        .withColumn("lead", F.when(F.col("new")[0]["at"] == 0, nothing).otherwise(F.coalesce("lead", nothing)))
        .withColumn("old", F.coalesce("old", nothing))
        .withColumn("before", F.concat("lead", "old"))
        .withColumn("all", F.concat("before", "new"))
    )
    size = lambda t: F.char_length(t["head"]) + F.char_length(t["body"]) + len(END) + 1
    # Starts of all turns in the window, from the sizes of those before.
    starts = F.aggregate(
        "all",
        F.struct(F.lit(0).alias("sum"), F.array().cast("array<int>").alias("starts")),
        lambda a, t: F.struct((a["sum"] + size(t)).alias("sum"), F.concat(a["starts"], F.array(a["sum"])).alias("starts")),
    )["starts"]
    marks = F.zip_with(
        "all", starts,
        lambda t, s: F.when(
            t["target"],
            F.struct((s + F.char_length(t["head"])).alias("from"), (s + F.char_length(t["head"]) + F.char_length(t["body"])).alias("to")),
        ),
    )
    return joined.select(
        F.col("conv").alias(conv),
        "window",
        F.size("new").alias("n_new"),
        F.size("before").alias("n_repeated"),
        F.aggregate("all", F.lit(0).cast("long"), lambda a, t: a + t["tokens"]).alias("n_tokens"),
        F.array_join(F.transform("all", lambda t: F.concat(t["head"], t["body"], F.lit(END + "\n"))), "").alias("text"),
        F.filter(marks, lambda m: m.isNotNull()).alias("loss"),
    )


def read_back(formatted: DataFrame, conv: str = "conv_id") -> DataFrame:
    """(conv, turns: array of (role, text), targets: array of text, chars), read from windows.

    Only the formatted texts, the loss stretches and the number of repeated turns are used.
    """
    pieces = F.split("text", r"<\|im_start\|>")  # the first piece is before the first turn: empty
    new = F.slice(pieces, F.col("n_repeated") + 2, F.size(pieces))
    cut = len(END) + 1

    line = lambda t: F.substring_index(t, "\n", 1)
    body = lambda t: t.substr(F.char_length(line(t)) + 2, F.char_length(t) - F.char_length(line(t)) - 1 - cut)
    parts = F.transform(
        new, lambda t: F.struct(unescaped_role(line(t)).alias("role"), unescaped(body(t)).alias("text"))
    )
    targets = F.transform("loss", lambda m: unescaped(F.substr("text", m["from"] + 1, m["to"] - m["from"])))
    read = formatted.select(
        F.col(conv).alias("conv"), "window", parts.alias("turns"), targets.alias("targets"), F.char_length("text").cast("long").alias("chars")
    )
    ordered = F.sort_array(F.collect_list(F.struct("window", "turns", "targets")))
    return read.groupBy("conv").agg(ordered.alias("w"), F.sum("chars").alias("chars")).select(
        F.col("conv").alias(conv), F.flatten("w.turns").alias("turns"), F.flatten("w.targets").alias("targets"), "chars"
    )
