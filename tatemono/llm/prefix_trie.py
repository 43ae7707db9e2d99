"""A trie of conversation prefixes, totalled from the leaves by time-forward processing.

Conversations are first rebuilt: each begins with the first turns of its base
conversation, as many as a hash of its id says, and goes on with its own turns
after as many. Every distinct sequence of first turns is a node; a node's
identity is its depth with two exact sums of place-dependent digests of its
turns, so all prefixes come from running totals in one global order, however
long a conversation is.

1. One aggregation per node counts its members. A node with a single member has
   a path below it, and no total of such a node needs anything else.
2. Of the shared nodes, a node's load is what is left of its members' turns, a
   bound on the nodes below. The highest nodes whose load is small become shard
   roots. Shards are processed side by side: the shared nodes of a shard come in
   reverse level order, and each sends its totals forward in time to its parent
   through a priority queue that spills.
3. The totals of shard roots are added up per parent, and the nodes above them
   are processed the same way. Shards and what lies above both have about as
   many nodes per level as the square root of all turns.

Nulls and edges: a row without conv_id takes no part; a NULL role or text is
empty. Turns are ordered by turn (NULL first), then role and text; equal rows
are turns each for itself. A conversation that nothing is left of is a member
of the root only. An empty table has no node. Other columns of the input are
ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tatemono.llm import prefix
from tatemono.llm.spill_queue import SpillingQueue
from tatemono.llm.text import Rows, rows_in, task
from tatemono.operators.joins import lookup_join
from tatemono.sources import scratch

GROUP = 5  # conversations c to c + 4 share the base c
HEADS = 9  # a conversation takes fewer turns than this from its base
LEAST_LOAD = 64  # of a shard
PIECE_BYTES = 1 << 16  # of a list of ids that is hashed
SLICE_ROWS = 20_000

_SUM = "decimal(38,0)"


def _digest(place: Column, content: Column) -> list[Column]:
    """Two numbers of 60 bits for a turn at a place."""
    mixed = F.md5(F.concat_ws(":", place, content))
    return [F.conv(F.substring(mixed, at, 15), 16, 10).cast(_SUM) for at in (1, 16)]


def _node(depth: Column, a: Column, b: Column) -> Column:
    return F.md5(F.concat_ws(":", depth.cast("string"), a.cast(_SUM).cast("string"), b.cast(_SUM).cast("string")))


def _root() -> Column:
    return _node(F.lit(0), F.lit(0), F.lit(0))


def _totals(placed: DataFrame, by: str, values: list[str]) -> DataFrame:
    """``placed`` with the total of each value over the rows of ``by`` before
    and with the row, however many rows ``by`` has: totals of whole ranges,
    and a running total inside one range."""
    before = Window.partitionBy(by).orderBy(prefix.PART).rowsBetween(Window.unboundedPreceding, -1)
    sums = placed.groupBy(by, prefix.PART).agg(*[F.sum(v).alias(f"_{v}") for v in values], F.count(F.lit(1)).alias("_rows"))
    earlier = [F.coalesce(F.sum(f"_{v}").over(before), F.lit(0)).cast(_SUM).alias(f"_{v}") for v in values]
    blocks = scratch.store(sums.select(by, prefix.PART, "_rows", *earlier), "blocks")
    joined = lookup_join(placed, blocks, [by, prefix.PART], [prefix.POS], "_rows", SLICE_ROWS)
    inside = {v: prefix.running_in_block(v, [by]).cast(_SUM) for v in values}
    return joined.withColumns(inside).withColumns({v: (F.col(v) + F.col(f"_{v}")).cast(_SUM) for v in values})


def _own_turns(turns: DataFrame) -> DataFrame:
    """Stored ``conv_id, place`` (from 0), ``content, bytes`` of all turns."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = turns.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long"), "turn", role.alias("role"), text.alias("text"), F.monotonically_increasing_id().alias("_row"), F.lit(1).cast("long").alias("place")
    )
    # the last column tells equal rows apart, so that they spread over ranges
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text"), F.col("_row")]
    content = F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)
    placed = _totals(prefix.in_order(rows, order, "turns"), "conv_id", ["place"])
    return scratch.store(
        placed.select("conv_id", (F.col("place") - 1).cast("long").alias("place"), content.alias("content"), F.octet_length("text").cast("long").alias("bytes")),
        "own",
    )


def _conversations(own: DataFrame, group: int, heads: int) -> DataFrame:
    """Stored row per conversation: its turns ``n``, its base, how many turns it
    asks for and how many it gets (``used``), and its ``total`` after that."""
    counted = own.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    asked = F.crc32(F.col("conv_id").cast("string")) % F.lit(heads)
    named = counted.select("conv_id", "n", asked.alias("h"), (F.col("conv_id") - F.col("conv_id") % group).alias("base"))
    bases = counted.select(F.col("conv_id").alias("base"), F.col("n").alias("_n"))
    used = F.least(F.col("h"), F.coalesce(F.col("_n"), F.lit(0)))
    rows = named.join(bases, "base", "left").withColumn("used", used).drop("_n")
    return scratch.store(rows.withColumn("total", F.col("used") + F.greatest(F.col("n") - F.col("h"), F.lit(0))), "conversations")


def rebuilt_paths(turns: DataFrame, group: int = GROUP, heads: int = HEADS) -> DataFrame:
    """Stored ``conv_id, depth, total, node, parent, bytes`` of all rebuilt
    turns, and of the root for every conversation."""
    own = _own_turns(turns)
    conversations = _conversations(own, group, heads)
    after = lookup_join(own, conversations.select("conv_id", "n", "h", "used", "total"), ["conv_id"], ["place"], "n", SLICE_ROWS)
    after = after.where(F.col("place") >= F.col("h")).withColumn("depth", F.col("used") + F.col("place") - F.col("h") + 1)
    # a base has few of these rows, and few conversations
    first = own.where(F.col("place") < heads - 1).withColumnRenamed("conv_id", "base")
    before = first.join(conversations.select("conv_id", "base", "used", "total"), "base").where(F.col("place") < F.col("used"))
    before = before.withColumn("depth", F.col("place") + 1)
    columns = ["conv_id", "depth", "total", "content", "bytes"]
    rows = after.select(columns).unionByName(before.select(columns))
    x, y = _digest(F.col("depth"), F.col("content"))
    rows = rows.withColumns({"x": x, "y": y, "a": x, "b": y}).drop("content")
    summed = _totals(prefix.in_order(rows, [F.col("conv_id"), F.col("depth")], "rebuilt"), "conv_id", ["a", "b"])
    parent = _node(F.col("depth") - 1, F.col("a") - F.col("x"), F.col("b") - F.col("y"))
    paths = summed.select("conv_id", "depth", "total", _node(F.col("depth"), F.col("a"), F.col("b")).alias("node"), parent.alias("parent"), "bytes")
    nothing = F.lit(0).cast("long")
    roots = conversations.select("conv_id", nothing.alias("depth"), "total", _root().alias("node"), F.lit(None).cast("string").alias("parent"), nothing.alias("bytes"))
    return scratch.store(paths.unionByName(roots), "paths")


_TOTALS = "node string, n_children long, n_leaves long, saved_tokens long, up string, n_convs long"


def time_forward(most: int | None = None):
    """Totals of the nodes of a partition, which come shard by shard and, inside
    one, by falling depth, then by node. A node's totals travel to its parent
    as a message that waits in a queue until the parent's turn has come."""
    schema = pa.schema(
        [("node", pa.string()), ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("up", pa.string()), ("n_convs", pa.int64())]
    )
    names = ("shard", "depth", "node", "parent", "n_convs", "ends", "bytes", "c_children", "c_leaves", "c_saved", "c_convs")

    @task
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, waiting = Rows(schema), SpillingQueue(most) if most else SpillingQueue()
        for batch in batches:
            for shard, depth, node, parent, n, ends, size, children, leaves, saved, convs in rows_in(batch, *names):
                while waiting and waiting.peek()[:3] == (shard, -depth, node):
                    _, _, _, _, more_leaves, more_saved, more_convs = waiting.pop()
                    children, leaves = children + 1, leaves + more_leaves
                    saved, convs = saved + more_saved, convs + more_convs
                # members that go on to a child of their own alone
                alone = n - ends - convs
                children, leaves = children + alone, leaves + alone
                if not children:
                    leaves = 1
                saved += (n - 1) * size
                up = parent if node == shard else None
                if parent is not None and up is None:
                    waiting.push((shard, 1 - depth, parent, node, leaves, saved, n))
                yield from rows.add(
                    (node.decode(), children, leaves, saved, up and up.decode(), n), 120
                )
        yield from rows.flush()

    return run


def _processed(nodes: DataFrame, name: str) -> DataFrame:
    """Stored totals of ``nodes``, which carry a shard and what came from below."""
    rows = nodes.select(
        "shard", "depth", "node", "parent", "n_convs", "ends", "bytes", "c_children", "c_leaves", "c_saved", "c_convs"
    ).repartition("shard").sortWithinPartitions("shard", F.col("depth").desc(), "node")
    return scratch.store(rows.mapInArrow(time_forward(), _TOTALS), name)


def _shard_roots(paths: DataFrame, shared: DataFrame, load: int) -> DataFrame:
    """Stored ``conv_id, shard``: the highest shared node of small load on the
    path of each conversation."""
    light = shared.where(F.col("load") <= load).select("node", "n_convs", F.lit(True).alias("is_light"))
    on_path = paths.select("conv_id", "depth", "node")
    marked = lookup_join(on_path, scratch.store(light, "light"), ["node"], ["conv_id"], "n_convs", SLICE_ROWS).where("is_light")
    return scratch.store(marked.groupBy("conv_id").agg(F.min_by("node", "depth").alias("shard")), "shards")


def subtree_totals(paths: DataFrame, nodes: DataFrame, turns: int, least_load: int = LEAST_LOAD) -> DataFrame:
    """Stored ``node, n_children, n_leaves, saved_tokens`` of the shared ones
    among the stored ``nodes``; ``turns`` is the number of rows of ``paths``."""
    load = max(least_load, math.isqrt(turns))
    shared = nodes.where(F.col("n_convs") > 1)
    none = F.lit(0).cast("long")
    nothing_below = {"c_children": none, "c_leaves": none, "c_saved": none, "c_convs": none}
    shards = _shard_roots(paths, shared, load)
    below = shared.where(F.col("load") <= load).join(shards, "conv_id").withColumns(nothing_below)
    inside = _processed(below, "inside")
    # what the shard roots send up, added up per parent
    sent = inside.where(F.col("up").isNotNull()).groupBy(F.col("up").alias("node")).agg(
        F.count(F.lit(1)).alias("c_children"), F.sum("n_leaves").alias("c_leaves"), F.sum("saved_tokens").alias("c_saved"), F.sum("n_convs").alias("c_convs")
    )
    above = shared.where(F.col("load") > load).join(sent, "node", "left").withColumn("shard", F.lit(""))
    above = above.withColumns({c: F.coalesce(F.col(c), none) for c in nothing_below})
    columns = ["node", "n_children", "n_leaves", "saved_tokens"]
    return scratch.store(inside.select(columns).unionByName(_processed(above, "above").select(columns)), "totals")


def _piece_maker():
    """Ids of a node, in order, as pieces of text."""
    schema = pa.schema([("node", pa.string()), ("first", pa.int64()), ("ids", pa.binary())])

    @task
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, here, first, parts, size = Rows(schema), None, 0, [], 0
        for batch in batches:
            for node, conv_id in rows_in(batch, "node", "conv_id"):
                if node != here or size >= PIECE_BYTES:
                    if parts:
                        yield from rows.add((here.decode(), first, b",".join(parts)), size + 60)
                    here, first, parts, size = node, conv_id, [], 0
                parts.append(b"%d" % conv_id)
                size += len(parts[-1]) + 1
        if parts:
            yield from rows.add((here.decode(), first, b",".join(parts)), size + 60)
        yield from rows.flush()

    return run


def _hasher():
    """SHA-256 over a node's pieces, one after the other."""
    schema = pa.schema([("node", pa.string()), ("digest", pa.string())])

    @task
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, here, state = Rows(schema), None, None
        for batch in batches:
            for node, ids in rows_in(batch, "node", "ids", at_once=8):
                if node == here:
                    state.update(b",")
                else:
                    if here is not None:
                        yield from rows.add((here.decode(), state.hexdigest()), 100)
                    here, state = node, hashlib.sha256()
                state.update(ids)
        if here is not None:
            yield from rows.add((here.decode(), state.hexdigest()), 100)
        yield from rows.flush()

    return run


def _end_digests(paths: DataFrame, nodes: DataFrame) -> DataFrame:
    """Stored ``node, digest`` of the nodes where several conversations end."""
    many = scratch.store(nodes.where(F.col("ends") > 1).select("node", F.lit(True).alias("many"), "ends"), "ends")
    ending = paths.where(F.col("depth") == F.col("total")).select("node", "conv_id")
    ending = lookup_join(ending, many, ["node"], ["conv_id"], "ends", SLICE_ROWS).where("many").select("node", "conv_id")
    pieces = ending.repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id")
    pieces = pieces.mapInArrow(_piece_maker(), "node string, first long, ids binary")
    ordered = pieces.repartition("node").sortWithinPartitions("node", "first")
    return scratch.store(ordered.mapInArrow(_hasher(), "node string, digest string"), "digests")


def trie(turns: DataFrame, group: int = GROUP, heads: int = HEADS, least_load: int = LEAST_LOAD) -> DataFrame:
    """Row per node: ``conv_id, depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256``."""
    paths = rebuilt_paths(turns, group, heads)
    ending = F.col("depth") == F.col("total")
    nodes = scratch.store(
        paths.groupBy("node").agg(
            F.min("conv_id").alias("conv_id"),
            F.max("depth").alias("depth"),
            F.max("parent").alias("parent"),
            F.max("bytes").alias("bytes"),
            F.max("total").alias("total"),
            F.count(F.lit(1)).alias("n_convs"),
            F.count_if(ending).alias("ends"),
            F.min(F.when(ending, F.col("conv_id"))).alias("end_id"),
            F.sum(F.col("total") - F.col("depth") + 1).alias("load"),
        ),
        "nodes",
    )
    totals = subtree_totals(paths, nodes, paths.count(), least_load)
    named = nodes.join(totals, "node", "left").join(_end_digests(paths, nodes), "node", "left")
    going_on = (F.col("depth") < F.col("total")).cast("long")
    digest = F.coalesce("digest", F.sha2(F.coalesce(F.col("end_id").cast("string"), F.lit("")), 256))
    named = named.select(
        "conv_id", "depth", "parent", "n_convs",
        F.coalesce("n_children", going_on).alias("n_children"),
        F.coalesce("n_leaves", F.lit(1).cast("long")).alias("n_leaves"),
        F.coalesce("saved_tokens", F.lit(0).cast("long")).alias("saved_tokens"),
        digest.alias("ends_sha256"),
    )
    # the smallest member of a node with one member is that of the node below
    parents = nodes.where(F.col("n_convs") > 1).join(totals.select("node", "n_children"), "node")
    parents = scratch.store(parents.select(F.col("node").alias("parent"), F.col("conv_id").alias("_parent"), F.col("n_children").alias("_count")), "parents")
    joined = lookup_join(named, parents, ["parent"], ["conv_id", "depth"], "_count", SLICE_ROWS)
    above = F.when(F.col("depth") > 0, F.coalesce("_parent", "conv_id"))
    return joined.select("conv_id", "depth", above.alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
