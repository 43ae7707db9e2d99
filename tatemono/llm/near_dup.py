"""Near-duplicate documents: MinHash banding, verification, components.

1. Each text becomes the set of its distinct 5-word shingles. Documents with
   equal sets form a class, found by a digest of the set; only one document of
   a class, its smallest id, goes on.
2. A set's signature holds the minima of many universal hash functions. Bands
   of the signature are bucket keys.
3. Each document of a bucket is compared with the bucket's smallest one: first
   by the signature, whose agreement estimates the similarity, then exactly on
   the full sets. So a bucket of mutual copies costs a star, not all its pairs.
   The links give components.
   A bucket whose documents then are in different components may hide a link
   between two of them. Its documents outside the bucket's main component are
   compared with all of the bucket, exactly, in tiles of bounded size: the
   buckets with the same main component are laid out as one grid, so each set
   is shipped once per side, and only true links leave a tile.
4. Links are joined to components by alternating large-star and small-star.

Nulls and edges: a text that is NULL or has no word has an empty set and is
linked with nothing. A row without doc_id is linked with nothing, has no
component, and is kept. Rows that share a doc_id are one document: it is linked
by any of their texts. An empty table gives an empty result. Other columns of
the input are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tatemono.llm.components import connected_components
from tatemono.llm.shingles import MinHash, fingerprint, shingle_set
from tatemono.llm.text import Rows, fresh, rows_in, task
from tatemono.operators.joins import lookup_join
from tatemono.sources import scratch


@dataclass(frozen=True)
class Bands:
    """32 bands of 4 minima: a pair at similarity 0.75 shares a bucket with a
    chance of 1 - (1 - 0.75**4)**32, about 0.999995. A pair goes to the exact
    test if ``least`` or more of its 128 minima agree, which is 5 standard
    deviations below what 0.75 gives."""

    bands: int = 32
    rows: int = 4
    least: float = 0.55
    percent: int = 75


# A tile's side: at most about so many documents, and shingles of them.
TILE = 1024
TILE_SHINGLES = 400_000

# links between two lists of rows ``(rep, component, payload)``
Compare = Callable[[list[tuple], list[tuple]], Iterator[tuple[int, int]]]

_SKETCH = "doc_id long, n long, print binary, keys array<long>"
_SETS = "doc_id long, n long, signature array<int>, shingles array<long>"


def _sketcher(bands: Bands):
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n", pa.int64()), ("print", pa.binary()), ("keys", pa.list_(pa.int64()))]
    )

    @task
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        minhash, rows = MinHash(bands.bands, bands.rows), Rows(schema)
        for batch in batches:
            for doc_id, text in rows_in(batch, "doc_id", "text"):
                found = shingle_set(text)
                if len(found):
                    keys = minhash.keys(minhash.signature(found))
                    yield from rows.add((doc_id, len(found), fingerprint(found), keys), 8 * len(keys) + 40)
                else:
                    yield from rows.add((doc_id, 0, None, None), 40)
        yield from rows.flush()

    return run


def _set_maker(bands: Bands):
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("n", pa.int64()),
            ("signature", pa.list_(pa.int32())),
            ("shingles", pa.list_(pa.int64())),
        ]
    )

    @task
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        minhash, rows = MinHash(bands.bands, bands.rows), Rows(schema)
        for batch in batches:
            for doc_id, text in rows_in(batch, "doc_id", "text"):
                found = shingle_set(text)
                signature = (minhash.signature(found) >> 33).astype("int32")
                yield from rows.add((doc_id, len(found), signature, found.view("int64")), 8 * len(found) + 600)
        yield from rows.flush()

    return run


def sketches(docs: DataFrame, bands: Bands = Bands()) -> DataFrame:
    """Stored table per row: set size, digest of the set, band keys."""
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return scratch.store(texts.mapInArrow(_sketcher(bands), _SKETCH), "sketches")


def classes(sketched: DataFrame) -> DataFrame:
    """Adds ``rep``, the smallest id with the same set; NULL without a set or id."""
    known = F.col("doc_id").isNotNull() & F.col("print").isNotNull()
    groups = scratch.store(
        sketched.where(known)
        .groupBy("print")
        .agg(F.min("doc_id").alias("_rep"), F.count(F.lit(1)).alias("_count"))
        .where(F.col("_count") > 1),
        "classes",
    )
    joined = lookup_join(sketched, groups, ["print"], ["doc_id"], "_count", 20_000)
    return joined.withColumn("rep", F.when(known, F.coalesce("_rep", "doc_id"))).drop("_rep")


def _sets(texts: DataFrame, ids: DataFrame, make, schema: str) -> DataFrame:
    """``make`` over the texts of the stored ``ids``."""
    if scratch.measure(ids).broadcastable:
        ids = F.broadcast(ids)
    return texts.join(ids, "doc_id", "left_semi").mapInArrow(make, schema)


class _Verifier:
    """Finds the links among candidate pairs ``a, b`` of representatives."""

    def __init__(self, docs: DataFrame, bands: Bands, repeated: bool):
        self.texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
        self.bands, self.repeated = bands, repeated

    def links(self, pairs: DataFrame) -> DataFrame:
        """Stored rows of ``pairs``, a stored table, that are similar enough. A
        document of very many pairs is a skewed key, which Spark splits."""
        ids = scratch.store(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "members")
        sets = _sets(self.texts, ids, _set_maker(self.bands), _SETS)
        sets = scratch.store(sets.distinct() if self.repeated else sets, "sets")

        def side(x: str) -> DataFrame:
            return sets.select(
                F.col("doc_id").alias(x),
                F.col("n").alias("n" + x),
                F.col("signature").alias("s" + x),
                F.col("shingles").alias("x" + x),
            )

        both = pairs.select("a", "b").join(side("b"), "b").join(side("a"), "a")
        agreeing = F.size(F.filter(F.zip_with("sa", "sb", lambda x, y: x == y), lambda same: same))
        likely = agreeing >= F.lit(self.bands.least) * F.size("sa")
        return scratch.store(both.where(likely).where(_linked(self.bands.percent)).select("a", "b"), "links")


def _linked(percent: int) -> Column:
    """Whole-number test of intersection over union, on the full sets."""
    shared = F.size(F.array_intersect("xa", "xb"))
    return F.lit(100) * shared >= F.lit(percent) * (F.col("na") + F.col("nb") - shared)


def _size_fits(percent: int) -> Column:
    """Sets of too different sizes cannot be similar enough."""
    small, large = F.least("na", "nb"), F.greatest("na", "nb")
    return F.lit(100) * small >= F.lit(percent) * large


def with_components(rows: DataFrame, node: str, components: DataFrame, out: str) -> DataFrame:
    found = components.select(F.col("node").alias(node), F.col("component").alias("_component"))
    return rows.join(found, node, "left").withColumn(out, F.coalesce("_component", node)).drop("_component")


def _set_bytes():
    schema = pa.schema([("rep", pa.int64()), ("payload", pa.binary())])

    @task
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = Rows(schema)
        for batch in batches:
            for doc_id, text in rows_in(batch, "doc_id", "text"):
                found = shingle_set(text).tobytes()
                yield from rows.add((doc_id, found), len(found) + 40)
        yield from rows.flush()

    return run


def tile_links(left: list[tuple], right: list[tuple], percent: int) -> Iterator[tuple[int, int]]:
    """Links between ``(rep, component, shingles)`` rows of different
    components. The right side's shingles are listed in order with their
    owners; a left set looks up its own, and hits are counted by owner."""
    if not left or not right:
        return
    sets = [np.frombuffer(r[2], np.uint64) for r in right]
    sizes = np.array([len(s) for s in sets])
    ids, groups = np.array([r[0] for r in right]), np.array([r[1] for r in right])
    listed, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(listed, kind="stable")
    listed, owner = listed[order], owner[order]
    for rep, group, shingles in left:
        own = np.frombuffer(shingles, np.uint64)
        first, last = np.searchsorted(listed, own, "left"), np.searchsorted(listed, own, "right")
        hits = last - first
        places = np.repeat(first - np.concatenate([[0], np.cumsum(hits)[:-1]]), hits) + np.arange(hits.sum())
        shared = np.bincount(owner[places], minlength=len(sets))
        linked = (100 * shared >= percent * (len(own) + sizes - shared)) & (groups != group)
        for other in ids[linked].tolist():
            yield min(rep, other), max(rep, other)


def _tile_reader(compare: Compare):
    """Reads tiles one after the other; a tile's rows are neighbours."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    @task
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, sides, here = Rows(schema), ([], []), None
        for batch in batches:
            for *tile, is_left, rep, group, payload in rows_in(batch, *batch.schema.names):
                if tile != here:
                    for pair in compare(*sides):
                        yield from rows.add(pair, 16)
                    sides, here = ([], []), tile
                sides[0 if is_left else 1].append((rep, group, payload))
        for pair in compare(*sides):
            yield from rows.add(pair, 16)
        yield from rows.flush()

    return run


def hidden_links(texts: DataFrame, repeated: bool, shared: DataFrame, components: DataFrame, percent: int) -> DataFrame:
    """Stored links ``a, b`` between different components inside buckets, found
    on the full sets. ``repeated`` tells whether ids of ``texts`` repeat."""

    def sets(ids: DataFrame) -> DataFrame:
        found = _sets(texts, ids, _set_bytes(), "rep long, payload binary")
        return found.distinct() if repeated else found

    return hidden_pairs(shared, components, sets, partial(tile_links, percent=percent))


def hidden_pairs(
    shared: DataFrame, components: DataFrame, payloads: Callable[[DataFrame], DataFrame], compare: Compare
) -> DataFrame:
    """Stored pairs ``a, b`` of different components that share a bucket of
    ``shared`` (``key, rep, n, size``) and that ``compare`` finds on the
    ``payloads`` (``rep, payload``) of a table of ``doc_id``.

    A bucket's main component is the one with most of its rows. Only rows
    outside it are paired, with all rows of the bucket, so a large group of
    linked copies is not paired with itself.
    """
    rows = with_components(shared.where(F.col("size") > 2).select("key", "rep", "n"), "rep", components, "c")
    rows = scratch.store(rows, "labelled")
    sizes = rows.groupBy("key", "c").agg(F.count(F.lit(1)).alias("m"))
    main = (
        sizes.groupBy("key")
        .agg(F.max_by("c", "m").alias("main"), F.count(F.lit(1)).alias("groups"), F.sum("m").alias("_count"))
        .where(F.col("groups") > 1)
        .drop("groups")
    )
    opened = lookup_join(rows, scratch.store(main, "main"), ["key"], ["rep"], "_count", 20_000, broadcast_bytes=0)
    members = opened.where(F.col("main").isNotNull()).select("main", "rep", "n", "c").distinct()
    members = scratch.store(members, "members")

    outside = F.col("c") != F.col("main")
    side = lambda rows, n: F.greatest(F.ceil(rows / F.lit(TILE)), F.ceil(n / F.lit(TILE_SHINGLES)))
    grids = members.groupBy("main").agg(
        side(F.count(F.lit(1)), F.sum("n")).alias("rs"),
        side(F.count_if(outside), F.sum(F.when(outside, F.col("n")))).alias("ls"),
        F.count(F.lit(1)).alias("_count"),
    )
    ids = scratch.store(members.select(F.col("rep").alias("doc_id")).distinct(), "member_ids")
    sets = scratch.store(payloads(ids), "sets")
    placed = lookup_join(members, scratch.store(grids, "grids"), ["main"], ["rep"], "_count", 20_000)
    placed = placed.join(sets, "rep").withColumn("_outside", outside)
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), n - 1))
    place = F.xxhash64("rep")
    columns = ("rep", "c", "payload")
    left = placed.where("_outside").select(
        "main", F.pmod(place, "ls").alias("l"), every(F.col("rs")).alias("r"), F.lit(True).alias("left"), *columns
    )
    right = placed.select(
        "main", every(F.col("ls")).alias("l"), F.pmod(place, "rs").alias("r"), F.lit(False).alias("left"), *columns
    )
    tiles = left.unionByName(right).repartition("main", "l", "r").sortWithinPartitions("main", "l", "r")
    return scratch.store(tiles.mapInArrow(_tile_reader(compare), "a long, b long"), "links")


def near_duplicates(docs: DataFrame, bands: Bands = Bands()) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_shingles, component_id, kept``."""
    classed = scratch.store(classes(sketches(docs, bands)), "classed")
    known = classed.where(F.col("rep").isNotNull())
    ids = known.groupBy("doc_id").agg(F.count(F.lit(1)).alias("_count"), F.min("rep").alias("_least"))
    ids = scratch.store(ids.where(F.col("_count") > 1), "repeated")
    repeated = not ids.isEmpty()
    verifier = _Verifier(docs, bands, repeated)

    reps = known.where(F.col("doc_id") == F.col("rep")).select("rep", "n", "keys")
    rows = (reps.distinct() if repeated else reps).select("rep", "n", F.explode("keys").alias("key"))
    buckets = (
        rows.groupBy("key")
        .agg(F.count(F.lit(1)).alias("size"), F.min("rep").alias("a"), F.min_by("n", "rep").alias("na"))
        .where(F.col("size") > 1)
    )
    buckets = scratch.store(buckets.withColumn("_count", F.col("size")), "buckets")
    # band keys are many at every size, so this join is always a shuffle
    shared = lookup_join(rows, buckets, ["key"], ["rep"], "_count", 20_000, broadcast_bytes=0)
    shared = scratch.store(shared.where(F.col("a").isNotNull()), "shared")
    stars = shared.where(F.col("a") != F.col("rep")).withColumnsRenamed({"rep": "b", "n": "nb"})
    stars = scratch.store(stars.where(_size_fits(bands.percent)).select("a", "b").distinct(), "stars")

    links = verifier.links(stars)
    if repeated:
        # rows of one doc_id are one node, whatever classes they are in
        same = lookup_join(known.select("doc_id", "rep"), ids, ["doc_id"], ["rep"], "_count", 20_000)
        links = links.unionByName(same.where("_least != rep").select(F.col("_least").alias("a"), F.col("rep").alias("b")))
    components = connected_components(links)
    components = joined_components(components, hidden_links(verifier.texts, repeated, shared, components, bands.percent))

    result = with_components(classed.select("doc_id", "n", "rep"), "rep", components, "component_id")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return result.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def joined_components(components: DataFrame, links: DataFrame) -> DataFrame:
    """Components after more links; unchanged without any."""
    if links.isEmpty():
        return components
    stars = components.select(F.col("node").alias("a"), F.col("component").alias("b"))
    return connected_components(stars.unionByName(links))


def drop_near_duplicates(docs: DataFrame, bands: Bands = Bands()) -> DataFrame:
    """Rows of ``docs`` whose doc_id is the smallest of its component, one row
    per doc_id; rows without doc_id stay."""
    judged = scratch.store(near_duplicates(docs, bands).select("doc_id", "kept"), "judged")
    out = _without(docs, scratch.store(judged.where(~F.col("kept")).select("doc_id").distinct(), "dropped"))
    known = judged.where(F.col("kept") & F.col("doc_id").isNotNull())
    again = known.groupBy("doc_id").agg(F.count(F.lit(1)).alias("_rows")).where("_rows > 1").select("doc_id")
    again = scratch.store(again, "again")
    if again.isEmpty():
        return out
    # rows that share a doc_id: one stays, the smallest by the columns that have an order
    number = fresh(docs, "_number")
    rows = docs.join(again, "doc_id", "left_semi").select(*_all(docs), F.monotonically_increasing_id().alias(number))
    rows = scratch.store(rows, "copies")
    order = [F.col(f"`{f.name}`").alias(f"c{i}") for i, f in enumerate(docs.schema.fields) if _has_order(f.dataType)]
    least = F.min(F.struct(*order, F.col(number).alias("row"))).alias("least")
    first = rows.groupBy("doc_id").agg(least).select(F.col("least.row").alias(number))
    return _without(out, again).unionByName(rows.join(first, number, "left_semi").select(*_all(docs)))


def _has_order(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return all(_has_order(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _has_order(kind.elementType)
    return not isinstance(kind, (T.MapType, T.VariantType, T.CalendarIntervalType))


def _all(docs: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in docs.columns]


def _without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose doc_id is not in a stored table."""
    small = scratch.measure(ids).broadcastable
    return docs.join(F.broadcast(ids) if small else ids, "doc_id", "left_anti").select(*_all(docs))


