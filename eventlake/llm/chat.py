"""Conversations as training windows: budgeted, turn-aligned, with a loss mask over new targets.

Every turn is written as "\\n### Role: text </turn>". In texts and roles the characters that could
form a control string are escaped ("%" as %25, "#" as %23, "<" as %3C; in roles ":" as %3A as well),
so the template parses back without loss. Prefix sums of turn tokens choose the windows: the line of
tokens is divided into cells of equal length, and the turns that end in a cell are a window. A window
starts with the system turn, repeats as many turns before its first new one as the history allowance
holds, and masks the targets among them; cells are so long that all of it fits the budget. No step
holds more of a conversation than a block of turns or a window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlake.llm._common import cut

HEAD, COLON, TAIL = "\n### ", ": ", " </turn>"
BUDGET = 1024  # tokens of a window, with its system turn and history; a new turn of more has a window of its own
HISTORY = 256  # tokens of turns that are repeated before the new ones
LEAST_CELL = 64  # tokens of a cell where a long system turn leaves less of the budget
BLOCK = 1024  # turn numbers that are put in order together
TARGET = "assistant"


def escaped(text: Column) -> Column:
    return F.replace(F.replace(F.replace(text, F.lit("%"), F.lit("%25")), F.lit("#"), F.lit("%23")), F.lit("<"), F.lit("%3C"))


def unescaped(text: Column) -> Column:
    return F.replace(F.replace(F.replace(text, F.lit("%3C"), F.lit("<")), F.lit("%23"), F.lit("#")), F.lit("%25"), F.lit("%"))


def _role(role: Column) -> Column:
    return F.replace(escaped(role), F.lit(":"), F.lit("%3A"))


def _placed(turns: DataFrame, tokens: str | None) -> DataFrame:
    """The turns with a key of their conversation that is not null, their place in it and the tokens
    before them. Windows run over blocks of turn numbers; blocks are added up by conversation."""
    text, role = F.coalesce(F.col("text").cast("string"), F.lit("")), F.coalesce(F.col("role").cast("string"), F.lit(""))
    size = F.ceil(F.octet_length(F.concat(F.lit(HEAD + COLON + TAIL), role, text)) / 4).cast("long") if tokens is None else F.greatest(F.coalesce(F.col(tokens).cast("long"), F.lit(1)), F.lit(1))
    key = F.coalesce(F.concat(F.lit("c"), F.col("conv_id").cast("string")), F.lit("")).alias("key")
    t = turns.select(key, "conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"), size.alias("tokens"))
    t = t.withColumn("block", F.coalesce(F.floor(F.col("turn") / BLOCK), F.lit(-(1 << 62))))
    inside = Window.partitionBy("key", "block").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, 0)
    t = t.select("*", F.count("*").over(inside).alias("idx"), F.sum("tokens").over(inside).alias("upto"))
    sums = t.groupBy("key", "block").agg(F.count("*").alias("n"), F.sum("tokens").alias("s"))
    before = Window.partitionBy("key").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offset = sums.select("key", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n0"), F.coalesce(F.sum("s").over(before), F.lit(0)).alias("s0"))
    t = t.join(offset, ["key", "block"])
    return t.select("key", "conv_id", (F.col("idx") + F.col("n0") - 1).alias("idx"), (F.col("upto") + F.col("s0") - F.col("tokens")).alias("start"), "tokens", "role", "text")


def chat_windows(turns: DataFrame, budget: int = BUDGET, history: int = HISTORY, tokens: str | None = None) -> DataFrame:
    """turns(conv_id, turn, role, text) -> conv_id, window, n_repeated, formatted, loss_spans.

    One row per window; window is the place of its first new turn in the conversation. n_repeated
    counts its leading turns that stand in an earlier window too (system turn and history). loss_spans
    are (start, n_chars) of the escaped texts of its new assistant turns, in code points of formatted.
    All turns of a window fit the budget together, but for a window of one new turn that is larger than a
    cell, or a system turn that leaves less than LEAST_CELL. Tokens are those of the column that `tokens`
    names, such as a tokenizer's counts, else a quarter of the UTF-8 bytes of the written turn, rounded
    up. Turns are ordered by turn (null first), then role and text; null roles and texts count as empty;
    a null conv_id is a conversation of its own; rows that repeat are repeated turns. Texts are never
    cut. Other columns are ignored, and an empty table gives an empty one.
    """
    placed = cut(_placed(turns, tokens), "turns")
    size = placed.groupBy("key").agg(F.max("idx").alias("last"))
    system = placed.where("idx = 0 AND role = 'system'").join(size.where("last > 0"), "key").select("key", F.col("tokens").alias("kept"), F.struct("role", "text").alias("system"))
    # The line of tokens after the system turn, in cells of half of what the budget leaves: a window is at
    # most its cell and the part of its first turn before it.
    cell = F.greatest(F.lit(LEAST_CELL), F.floor((F.lit(budget - history) - F.coalesce("kept", F.lit(0))) / 2)) if budget > 4 * LEAST_CELL else F.lit(max(1, (budget - history) // 2))
    line = placed.join(system.select("key", "kept"), "key", "left").select("*", cell.cast("long").alias("cell"))
    line = line.where("kept IS NULL OR idx > 0").withColumn("start", F.col("start") - F.coalesce("kept", F.lit(0)))
    line = line.withColumns({"at": F.floor((F.col("start") + F.col("tokens") - 1) / F.col("cell")), "fits": (F.col("tokens") <= F.col("cell")).cast("int")})
    own = Window.partitionBy("key", "at", "fits")
    turn = F.struct("idx", "role", "text")
    new = line.select("key", "conv_id", F.min("idx").over(own).alias("window"), "kept", F.lit(False).alias("repeated"), turn.alias("turn"))
    spans = line.groupBy("key", "at", "fits").agg(F.min("idx").alias("window"), F.min("start").alias("start"), F.first("cell").alias("cell"), F.first("conv_id").alias("conv_id"), F.first("kept").alias("kept")).where("window > 1 OR (window > 0 AND kept IS NULL)")
    back = spans.select("key", "conv_id", "kept", "window", F.col("start").alias("to"), F.explode(F.sequence(F.greatest(F.lit(0), F.floor((F.col("start") - history) / F.col("cell"))), F.greatest(F.lit(0), F.floor((F.col("start") - 1) / F.col("cell"))))).alias("at")) if history else None
    rows = new
    if back is not None:
        past = back.join(line.select("key", "at", F.col("start").alias("from"), turn.alias("turn")), ["key", "at"]).where(F.col("turn.idx") < F.col("window")).where(F.col("from") >= F.col("to") - history)
        rows = rows.unionByName(past.select("key", "conv_id", "window", "kept", F.lit(True).alias("repeated"), "turn"))
    lead = spans.join(system.drop("kept"), "key").select("key", "conv_id", "window", "kept", F.lit(True).alias("repeated"), F.struct(F.lit(0).cast("long").alias("idx"), "system.role", "system.text").alias("turn"))
    first = system.join(placed.where("idx = 0").select("key", "conv_id"), "key").select("key", "conv_id", F.lit(1).cast("long").alias("window"), "kept", F.lit(False).alias("repeated"), F.struct(F.lit(0).cast("long").alias("idx"), "system.role", "system.text").alias("turn"))
    rows = rows.unionByName(lead).unionByName(first)
    w = rows.groupBy("key", "window").agg(F.first("conv_id").alias("conv_id"), F.count_if("repeated").cast("int").alias("n_repeated"), F.array_sort(F.collect_list("turn")).alias("t"))
    written = F.transform("t", lambda t: F.struct(F.concat(F.lit(HEAD), _role(t["role"]), F.lit(COLON)).alias("head"), escaped(t["text"]).alias("body"), (t["role"] == TARGET).alias("target")))
    w = w.select("conv_id", "window", "n_repeated", written.alias("w"))
    walk = lambda a, t: F.struct(
        (a["i"] + 1).alias("i"),
        (a["at"] + F.length(t["head"]) + F.length(t["body"]) + len(TAIL)).alias("at"),
        F.when(t["target"] & (a["i"] >= F.col("n_repeated")), F.concat(a["spans"], F.array(F.struct((a["at"] + F.length(t["head"])).alias("start"), F.length(t["body"]).alias("n_chars"))))).otherwise(a["spans"]).alias("spans"),
    )
    zero = F.lit(0).cast("int")
    start = F.struct(zero.alias("i"), zero.alias("at"), F.array().cast("array<struct<start:int,n_chars:int>>").alias("spans"))
    return w.select(
        "conv_id",
        "window",
        "n_repeated",
        F.array_join(F.transform("w", lambda t: F.concat(t["head"], t["body"], F.lit(TAIL))), "").alias("formatted"),
        F.aggregate("w", start, walk, lambda a: a["spans"]).alias("loss_spans"),
    )


def parsed(formatted: Column) -> Column:
    """The turns (role, text) of a formatted window."""
    parts = F.filter(F.split(formatted, TAIL.replace("/", "\\/")), lambda p: p != "")
    body = lambda p: F.substring(p, F.lit(len(HEAD) + 1), F.length(p))
    role = lambda p: F.substring_index(body(p), COLON, 1)
    return F.transform(
        parts,
        lambda p: F.struct(
            F.replace(F.replace(F.replace(F.replace(role(p), F.lit("%3A"), F.lit(":")), F.lit("%3C"), F.lit("<")), F.lit("%23"), F.lit("#")), F.lit("%25"), F.lit("%")).alias("role"),
            unescaped(F.substring(body(p), F.length(role(p)) + len(COLON) + 1, F.length(p))).alias("text"),
        ),
    )


def read_windows(windows: DataFrame) -> DataFrame:
    """Of each window: its new turns, the text under its loss mask, and the code points written."""
    turns = windows.select("conv_id", "window", "n_repeated", "formatted", "loss_spans", parsed(F.col("formatted")).alias("p"))
    new = F.slice("p", F.col("n_repeated") + 1, F.greatest(F.size("p") - F.col("n_repeated"), F.lit(0)))
    loss = F.array_join(F.transform("loss_spans", lambda s: unescaped(F.substring(F.col("formatted"), s["start"] + 1, s["n_chars"]))), "")
    return turns.select("conv_id", "window", new.alias("turns"), loss.alias("loss"), F.length("formatted").cast("long").alias("n_chars"))


def read_back(windows: DataFrame) -> DataFrame:
    """Of each conversation, from its windows: n_turns, its turns once and in order (each as role, line
    end, text, line end), the text under the loss mask, and the code points written."""
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    own = read_windows(windows).select("conv_id", "window", F.size("turns").cast("long").alias("n"), said.alias("turns"), "loss", "n_chars")
    whole = own.groupBy("conv_id").agg(F.sum("n").alias("n_turns"), F.array_sort(F.collect_list(F.struct("window", "turns", "loss"))).alias("w"), F.sum("n_chars").alias("formatted_chars"))
    return whole.select("conv_id", "n_turns", F.array_join("w.turns", "").alias("turns"), F.array_join("w.loss", "").alias("loss"), "formatted_chars")
