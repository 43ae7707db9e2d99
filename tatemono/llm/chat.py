"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it are
its context, and only its own text is trainable. Turns after the last
assistant turn, or all turns of a conversation without one, form one example
without a target, so that nothing is lost.

The template writes a turn as ``<s>role[INST]text</s>``. Inside roles and texts
the strings that look like a control string get a backslash before their last
character; one that has backslashes there already gets one more. Taking one
off again restores every text.

DataFrame operations only. Nulls and edges: a NULL text or role counts as
empty. Turns are ordered by turn (NULL first), then by role and text, so
repeated rows stay and their order does not matter. Rows with a NULL conv_id
are one conversation. An empty table gives an empty result. Other columns of
the input are ignored. One conversation is one row, because its digest is
taken over all its turns in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, MIDDLE, CLOSE = "<s>", "[INST]", "</s>"  # control strings, with [/INST] kept free

_ESCAPE = ((r"(</?s\\*)>", r"$1\\>"), (r"(\[/?INST\\*)\]", r"$1\\]"))
_UNESCAPE = ((r"(</?s\\*)\\>", r"$1>"), (r"(\[/?INST\\*)\\\]", r"$1]"))


def _replaced(text: Column, rules: tuple[tuple[str, str], ...]) -> Column:
    for pattern, by in rules:
        text = F.regexp_replace(text, pattern, by)
    return text


def escaped(text: Column) -> Column:
    return _replaced(text, _ESCAPE)


def unescaped(text: Column) -> Column:
    return _replaced(text, _UNESCAPE)


def expand(turns: DataFrame) -> DataFrame:
    """Per example: ``conv_id, example, formatted, loss_start, loss_length,
    last``. ``example`` counts the conversation's examples from 0, the loss
    mask covers ``loss_length`` characters from ``loss_start`` on, and
    ``last`` marks the example that holds the whole conversation."""
    clean = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    turn = F.struct(F.col("turn"), clean("role").alias("role"), clean("text").alias("text"))
    whole = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    target = F.filter(
        F.sequence(F.lit(1), F.size("turns")), lambda i: F.element_at("turns", i)["role"] == "assistant"
    )
    tail = F.coalesce(F.element_at("turns", -1)["role"] != "assistant", F.lit(True))
    head = lambda t: F.concat(F.lit(OPEN), escaped(t["role"]), F.lit(MIDDLE))
    marked = F.transform("turns", lambda t: F.struct(head(t).alias("head"), escaped(t["text"]).alias("body")))
    whole = whole.select("conv_id", target.alias("targets"), tail.alias("tail"), F.size("turns").alias("n"), marked.alias("marked"))
    # an example ends with its target; the tail's ends with the last turn
    ends = F.when(F.col("tail"), F.concat("targets", F.array("n"))).otherwise(F.col("targets"))
    rows = whole.select("conv_id", "marked", "tail", "n", F.posexplode(ends).alias("example", "end"))
    written = F.transform("marked", lambda t: F.concat(t["head"], t["body"], F.lit(CLOSE)))
    own = F.element_at("marked", F.col("end"))
    has_target = ~(F.col("tail") & (F.col("end") == F.col("n")))
    before = F.array_join(F.slice(written, 1, F.col("end") - 1), "")
    rows = rows.select(
        "conv_id",
        "example",
        before.alias("context"),
        own["head"].alias("head"),
        own["body"].alias("body"),
        has_target.alias("has_target"),
        (F.col("end") == F.col("n")).alias("last"),
    )
    return rows.select(
        "conv_id",
        "example",
        F.concat("context", "head", "body", F.lit(CLOSE)).alias("formatted"),
        F.when(F.col("has_target"), F.length("context") + F.length("head")).alias("loss_start"),
        F.when(F.col("has_target"), F.length("body")).otherwise(F.lit(0)).alias("loss_length"),
        "last",
    )


def parse(formatted: Column) -> Column:
    """The turns of a formatted text: an array of ``role, text``."""
    parts = F.split(formatted, CLOSE)
    turns = F.slice(parts, 1, F.size(parts) - 1)
    role = lambda p: F.substring_index(p, MIDDLE, 1)

    def read(p: Column) -> Column:
        name = F.substr(role(p), F.lit(len(OPEN) + 1))
        text = F.substr(p, F.length(role(p)) + F.lit(len(MIDDLE) + 1))
        return F.struct(unescaped(name).alias("role"), unescaped(text).alias("text"))

    return F.transform(turns, read)


def digests(examples: DataFrame) -> DataFrame:
    """Per conversation, read back from its examples: number and digest of the
    turns, length and digest of all text under the loss mask, characters."""
    loss = unescaped(F.substr("formatted", F.col("loss_start") + 1, F.col("loss_length")))
    rows = examples.select(
        "conv_id",
        F.when(F.col("loss_start").isNotNull(), F.struct("example", loss.alias("text"))).alias("loss"),
        F.length("formatted").cast("long").alias("chars"),
        F.when(F.col("last"), F.col("formatted")).alias("whole"),
    )
    grouped = rows.groupBy("conv_id").agg(
        F.array_sort(F.collect_list("loss")).alias("losses"),
        F.sum("chars").alias("formatted_chars"),
        F.element_at(F.collect_list("whole"), 1).alias("whole"),  # one row has it
    )
    grouped = grouped.select(
        "conv_id",
        parse(F.col("whole")).alias("turns"),
        F.array_join(F.transform("losses", lambda x: x["text"]), "").alias("loss"),
        "formatted_chars",
    )
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return grouped.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )
