"""Mixing sources to target weights by weighted fair queueing.

Every document waits in the queue of its source, in shuffled order, and again
in a second and third pass of the source. Its virtual finish time is the
source's words up to its end, divided by the source's target. All queues are
merged by finish time in one range sort, and the order is cut where the words
reach the total budget.

DataFrame operations only. Sizes and ids, never texts, are shuffled. A hot
source is no hot task: its queue is cut by range, and its running totals are
sums of ranges plus a window inside each one.

Nulls: a NULL text has size 0, a NULL source is a source of its own that comes
last, a NULL doc_id is a value like any other. Repeated rows are separate
documents. Documents of size 0 are never taken. An empty table gives an empty
result. Other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tatemono.llm import prefix
from tatemono.llm.text import fresh, word_count
from tatemono.operators.joins import lookup_join
from tatemono.operators.rows import global_row_number
from tatemono.sources import scratch

WEIGHTS = (1, 2, 3)
PASSES = 3
SEED = 17

_WIDE = "decimal(38,0)"  # products of word counts


def source_key(source: Column) -> Column:
    """A source as a key that is never NULL."""
    return F.when(source.isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), source))


def shuffle_key(doc_id: Column, seed: int) -> Column:
    """60 bits of the digest of seed and id: a fixed shuffle of documents."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, passes: int = PASSES) -> DataFrame:
    """Stored table ``_key, source_size, target, _docs`` from rows of ``source, _key, size``.

    The budget, all words, is shared by weight. A target above ``passes`` times
    its source's words stops there and the excess is shared again, until none
    is above. Products are compared as whole numbers.
    """
    sources = sizes.groupBy("source", "_key").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("_docs"))
    ranked = global_row_number(sources, [F.col("source").asc_nulls_last()], "_rank", "sources")
    weight = F.lit(0)
    for i, w in enumerate(weights):
        weight = F.when((F.col("_rank") - 1) % len(weights) == i, F.lit(w)).otherwise(weight)
    weighed = scratch.store(ranked.withColumn("_w", weight.cast("long")), "weighed")

    cap = F.col("source_size") * passes
    total = weighed.agg(F.sum("source_size").alias("n")).first()["n"] or 0
    rest, free_weight, capped = total, None, F.lit(False)
    while True:
        row = weighed.agg(
            F.sum(F.when(~capped, F.col("_w"))).alias("w"),
            F.coalesce(F.sum(F.when(capped, cap)), F.lit(0)).alias("stopped"),
        ).first()
        if row["w"] is None or (total - row["stopped"], row["w"]) == (rest, free_weight):
            break
        rest, free_weight = total - row["stopped"], row["w"]
        # a source that stopped stays so, because the share per weight only rises
        capped = cap.cast(_WIDE) * F.lit(free_weight).cast(_WIDE) < F.lit(rest).cast(_WIDE) * F.col("_w").cast(_WIDE)
    share = F.lit(float(rest)) * F.col("_w").cast("double") / F.lit(float(free_weight or 1))
    target = F.when(capped, cap.cast("double")).otherwise(share)
    return scratch.store(weighed.select("_key", "source_size", target.alias("target"), "_docs"), "targets")


def mix(
    docs: DataFrame, weights: Sequence[int] = WEIGHTS, passes: int = PASSES, seed: int = SEED, row: str | None = None
) -> DataFrame:
    """Per document: ``doc_id, size, source_size, target, taken`` and, with
    ``row`` (a column that numbers the rows of a stored table), that number.

    A document is taken whole, up to ``passes`` times; ``taken`` are its words
    times its copies in the mix.
    """
    number = F.col(row) if row else F.monotonically_increasing_id()
    sized = scratch.store(
        docs.select(
            number.alias("_row"),
            "doc_id",
            "source",
            source_key(F.col("source")).alias("_key"),
            word_count(F.col("text")).alias("size"),
        ),
        "sized",
    )
    targets = source_targets(sized, weights, passes)
    narrow = lookup_join(sized.drop("source"), targets, ["_key"], ["_row"], "_docs")
    narrow = narrow.withColumn("_mix", shuffle_key(F.col("doc_id"), seed))

    queue = prefix.in_order(
        narrow.where(F.col("size") > 0), [F.col(c) for c in ("_key", "_mix", "doc_id", "size", "_row")], "queue"
    )
    blocks = prefix.totals_before(queue, "size", ["_key"])
    ends = lookup_join(queue, blocks.select("_key", prefix.PART, "_before", "_rows"), ["_key", prefix.PART], ["_row"], "_rows")
    ends = ends.withColumn("_end", F.col("_before") + prefix.running_in_block("size", ["_key"]))
    copies = ends.select(
        "_key", "_mix", "doc_id", "size", "_row", "_end", "source_size", "target",
        F.explode(F.sequence(F.lit(0), F.lit(passes - 1))).alias("_pass"),
    )
    finish = (F.col("_pass") * F.col("source_size") + F.col("_end")).cast("double") / F.col("target")
    copies = copies.select("_key", "_mix", "doc_id", "size", "_row", "_pass", finish.alias("_finish"))

    order = [F.col(c) for c in ("_finish", "_key", "_pass", "_mix", "doc_id", "size", "_row")]
    merged = prefix.in_order(copies.select("_finish", "_key", "_pass", "_mix", "doc_id", "size", "_row"), order, "merged")
    taken = _cut(merged, sized).groupBy("_row").agg(F.sum("size").alias("taken"))
    result = narrow.join(taken, "_row", "left").withColumn("taken", F.coalesce("taken", F.lit(0)).cast("long"))
    return result.select("doc_id", "size", "source_size", "target", "taken", *([F.col("_row").alias(row)] if row else []))


def _cut(merged: DataFrame, sized: DataFrame) -> DataFrame:
    """Rows of the merged order up to the budget. Only the range that holds
    the cut needs a running total."""
    budget = sized.agg(F.sum("size").alias("n")).first()["n"] or 0
    blocks = prefix.totals_before(merged, "size")
    over = blocks.where(F.col("_before") + F.col("_sum") > budget).agg(F.min(prefix.PART).alias("p")).first()["p"]
    if over is None:
        return merged.select("_row", "size")
    before = blocks.where(F.col(prefix.PART) == over).first()["_before"]
    cut = merged.where(F.col(prefix.PART) == over).withColumn("_sum", prefix.running_in_block("size"))
    whole = merged.where(F.col(prefix.PART) < over).select("_row", "size")
    return whole.unionByName(cut.where(F.col("_sum") <= budget - before).select("_row", "size"))


def mix_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: all columns of ``docs``, each document as often as it
    is taken."""
    row, copies = fresh(docs, "_mix_row"), fresh(docs, "_mix_copies")
    numbered = scratch.store(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    mixed = mix(numbered, row=row, **options).where(F.col("taken") > 0)
    times = mixed.select(row, (F.col("taken") / F.col("size")).cast("int").alias(copies))
    out = numbered.join(times, row).withColumn(copies, F.explode(F.sequence(F.lit(1), F.col(copies))))
    return out.select(*[f"`{c}`" for c in docs.columns])
