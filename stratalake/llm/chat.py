"""Multi-party dialogues rendered once from every participant's point of view, with loss masks.

For each speaker the same dialogue is written out with that speaker as assistant and all others as users with their
names. A long dialogue is rendered in parts of consecutive turns, so that no row or group grows with it; mask
positions count from the beginning of the whole rendering.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Turns rendered together.
PART_TURNS = 256
SYSTEM = "system"


def escaped(text: Column) -> Column:
    """Text that holds no `<|`: in `<`, any backslashes, `|` one backslash more is put before the `|`."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def escaped_name(name: Column) -> Column:
    """A name that holds neither `<|` nor `|>`; in `|`, any backslashes, `>` one backslash more follows the `|`."""
    return F.regexp_replace(escaped(name), r"\|(\\*)>", r"|\\$1>")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", "<$1|")


def unescaped_name(name: Column) -> Column:
    return unescaped(F.regexp_replace(name, r"\|\\(\\*)>", "|$1>"))


def header(role: Column, name: Column) -> Column:
    """What stands before a turn's text. `name` is null for the assistant and for system turns."""
    return F.concat(F.lit("<|"), role, F.coalesce(F.concat(F.lit(" name="), escaped_name(name)), F.lit("")), F.lit("|>\n"))


TURN_END = "\n<|end|>\n"


def perspectives(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", speaker: str = "role", text: str = "text", part_turns: int = PART_TURNS) -> DataFrame:
    """(conv_id, perspective, part, n_turns, n_trained, rendered, mask) of every dialogue and participant.

    Participants are the distinct speakers but for `system`, whose turns stay system turns for all. A part holds the turns
    whose number div part_turns is the same. `rendered` is the part's text. `mask` lists the characters to train on as
    "start-end" (end exclusive, comma-separated), counted from the beginning of the first part: the text of the assistant's
    turns and the end mark after it. Marks in texts and names are escaped, so that no text can open or close a turn; the
    positions are those of the escaped text, and `unescaped` and `unescaped_name` give it back. Null texts are empty; null
    speakers are rendered as user `unknown` and take part under that name; null turn numbers come first, in part -1. Turns that tie are ordered by speaker, then text;
    repeated rows are kept. Dialogues of system turns only have no perspective. Other columns are ignored.
    """
    who = F.coalesce(F.col(speaker).cast("string"), F.lit("unknown"))
    rows = turns.select(
        F.col(conv).alias("conv_id"),
        F.col(turn).cast("bigint").alias("turn"),
        who.alias("speaker"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    ).withColumn("part", F.coalesce(F.floor(F.col("turn") / part_turns), F.lit(-1)).cast("bigint"))
    seen = rows.filter(F.col("speaker") != SYSTEM).groupBy("conv_id").agg(F.sort_array(F.collect_set("speaker")).alias("people"))
    parts = rows.groupBy("conv_id", "part").agg(F.sort_array(F.collect_list(F.struct("turn", "speaker", "text"))).alias("turns"))
    # One row per part and participant; what a turn becomes depends only on whether it is theirs.
    each = parts.join(seen, "conv_id").select("conv_id", "part", "turns", F.explode("people").alias("perspective"))

    def rendered(t: Column, perspective: Column) -> Column:
        mine, system = t["speaker"] == perspective, t["speaker"] == SYSTEM
        role = F.when(mine, "assistant").when(system, SYSTEM).otherwise("user")
        head = header(role, F.when(~mine & ~system, t["speaker"]))
        return F.struct(mine.alias("mine"), head.alias("head"), F.concat(escaped(t["text"]), F.lit(TURN_END)).alias("body"))

    each = each.withColumn("pieces", F.transform("turns", lambda t: rendered(t, F.col("perspective")))).drop("turns")
    each = each.withColumn("rendered", F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["body"])), ""))
    before = Window.partitionBy("conv_id", "perspective").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    each = each.withColumn("base", F.coalesce(F.sum(F.length("rendered")).over(before), F.lit(0)))
    start = F.struct(F.col("base").cast("bigint").alias("at"), F.expr("CAST(array() AS ARRAY<STRING>)").alias("spans"))

    def step(acc: Column, p: Column) -> Column:
        begin = acc["at"] + F.length(p["head"])
        end = begin + F.length(p["body"])
        span = F.concat(begin.cast("string"), F.lit("-"), end.cast("string"))
        return F.struct(end.alias("at"), F.when(p["mine"], F.array_append(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    return each.select(
        "conv_id",
        "perspective",
        "part",
        F.size("pieces").cast("bigint").alias("n_turns"),
        F.size(F.filter("pieces", lambda p: p["mine"])).cast("bigint").alias("n_trained"),
        "rendered",
        F.array_join(F.aggregate("pieces", start, step)["spans"], ",").alias("mask"),
    )
