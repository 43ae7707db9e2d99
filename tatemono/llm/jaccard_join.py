"""Jaccard join of documents: universe partition, pigeonhole, verification.

Two sets of sizes x and y whose similarity reaches p percent differ in at most
``(x + y) * (100 - p) / (100 + p)`` elements. Sizes fall into bands that grow
by ``100 / p``, so a set only meets its own band and the one below.

1. Each text becomes the set of its distinct 5-word shingles. Documents with
   equal sets form a class; only its smallest id goes on.
2. A band cuts the universe of shingles by their hash into as many segments as
   its largest possible difference, plus one. A set's part in a segment is its
   subset. Every set is indexed in its band under a key per subset; in the
   band's reserve segments also under a key per subset less one element, the
   one-deletion neighbourhood.
3. A set probes its own band and the one below for sets that are not larger.
   It gives each segment a budget: 0, not probed; 1, the subsets must be
   equal; 2, they differ in one element at most, which the deletions of both
   sides find. If a pair with at most H differences missed every probe, it
   would differ in at least as many elements as the budgets add up to. So any
   budgets that add up to H + 1 find all pairs, and the cheapest are taken:
   the cost is the number of sets indexed under the probed keys. Empty and
   common subsets are left out that way.
4. A key's sets are a bucket. Each is compared with the bucket's smallest one;
   what may still be hidden between different components of a bucket is
   compared in tiles (see ``near_dup.hidden_pairs``). The comparison first
   looks at parities: a bit per place tells whether an odd number of elements
   falls there, and each bit in which two sets differ takes an element that
   they do not share. Pairs that do not differ in too many bits are verified
   on the full sets. Links are joined by large-star and small-star.

Costs only steer which keys are probed, never what is found. They are exact
counts but for keys that no chunk of a task holds twice. Keys and ids travel as
arrays, one per task and partition. A key of very many sets is cut into slots:
an indexed set lies in one of them, a probing one visits all.

Nulls and edges: a text that is NULL or has no word has an empty set and is
linked with nothing. A row without doc_id is linked with nothing and has no
component. Rows that share a doc_id are one document: it is linked by any of
their texts. An empty table gives an empty result. Other columns of the input
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tatemono.llm.components import connected_components
from tatemono.llm.near_dup import classes, hidden_pairs, joined_components, with_components
from tatemono.llm.shingles import fingerprint, shingle_set
from tatemono.llm.text import WORD, Rows, rows_in, task
from tatemono.operators.joins import lookup_join
from tatemono.sources import scratch

INDEXED, PROBING = 1, 2  # the lowest two bits of a key
SUBSET, DELETION = 0, 1
_ROLE = np.uint64(3)

CHUNK_KEYS = 1_000_000  # keys a task collects before it hands them on
TASK_KEYS = 4_000_000  # keys per partition, about
SLOT_KEYS = 50_000  # of one key per slot, about
COMMON = 8  # sets under a key from which its count is kept
MOST_COMMON = 200_000  # counts handed to the tasks, the largest ones


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


@dataclass(frozen=True)
class Partition:
    """Bands of set sizes and their segments for a similarity in percent."""

    percent: int = 80

    def differences(self, x: int, y: int) -> int:
        """Most elements by which linked sets of these sizes differ."""
        return (x + y) * (100 - self.percent) // (100 + self.percent)

    @cached_property
    def bands(self) -> list[tuple[int, int, int, int]]:
        """Smallest and largest size, segments, and reserve segments."""
        found, low = [], 1
        while low < 1 << 40:
            high = low * 100 // self.percent
            segments = self.differences(high, high * 100 // self.percent) + 1
            found.append((low, high, segments, min(segments, max(8, segments // 16))))
            low = high + 1
        return found

    @cached_property
    def _lows(self) -> np.ndarray:
        return np.array([b[0] for b in self.bands])

    def band(self, size: int) -> int:
        return int(np.searchsorted(self._lows, size, "right")) - 1


class Subsets:
    """The segments of one set under the partition of one band.

    Segments are cut by the leading bits of the hashes, so each is a run of
    the sorted set. A subset stands for the sum of its elements."""

    def __init__(self, tokens: np.ndarray, partition: Partition, band: int):
        self.band = band
        _, _, self.count, self.reserve = partition.bands[band]
        self.segment = ((tokens >> np.uint64(32)) * np.uint64(self.count)) >> np.uint64(32)
        edges = np.searchsorted(self.segment, np.arange(self.count + 1, dtype=np.uint64))
        total = np.concatenate([[np.uint64(0)], np.cumsum(tokens, dtype=np.uint64)])
        self.sums, self.sizes = total[edges[1:]] - total[edges[:-1]], np.diff(edges)
        # elements of the reserve segments, which are the first ones
        self.owner = self.segment[: edges[self.reserve]].astype(np.int64)
        self.without = self.sums[self.owner] - tokens[: edges[self.reserve]]

    def keys(self, kind: int, segment: np.ndarray, sums: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        place = (np.uint64(self.band) << np.uint64(1) | np.uint64(kind)) << np.uint64(48) ^ segment.astype(np.uint64)
        return _mixed(sums ^ _mixed(place + sizes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))) & ~_ROLE

    @cached_property
    def subsets(self) -> np.ndarray:
        """A key per segment."""
        return self.keys(SUBSET, np.arange(self.count), self.sums, self.sizes)

    @cached_property
    def deletions(self) -> np.ndarray:
        """Per reserve element the key by which a larger set is found."""
        return self.keys(DELETION, self.owner, self.without, self.sizes[self.owner] - 1)

    @cached_property
    def grown(self) -> np.ndarray:
        """Per reserve segment the key of sets with one element more."""
        first = slice(0, self.reserve)
        return self.keys(DELETION, np.arange(self.reserve), self.sums[first], self.sizes[first])

    @cached_property
    def shrunk(self) -> np.ndarray:
        """Per reserve element the key of sets without just that one."""
        return self.keys(SUBSET, self.owner, self.without, self.sizes[self.owner] - 1)

    def indexed(self) -> np.ndarray:
        return np.concatenate([self.subsets, self.deletions])

    def budgets(self, need: int, costs: Costs) -> np.ndarray:
        """0, 1 or 2 per segment, adding up to ``need``, at the least cost. The
        second step of a segment never costs less than its first, so taking
        the cheapest steps respects their order."""
        first = costs.of(self.subsets)
        shrunk = np.bincount(self.owner, weights=costs.of(self.shrunk), minlength=self.reserve)
        second = first[: self.reserve] + costs.of(self.grown) + shrunk
        steps = np.argsort(np.concatenate([first, second]), kind="stable")[:need]
        return np.bincount(np.where(steps < self.count, steps, steps - self.count), minlength=self.count)

    def probes(self, need: int, costs: Costs) -> tuple[np.ndarray, np.ndarray]:
        """Which subsets are probed, and the keys of the wider probes."""
        budgets = self.budgets(need, costs)
        wide = budgets[: self.reserve] == 2
        return budgets > 0, np.concatenate([self.grown[wide], self.shrunk[wide[self.owner]]])


class Costs:
    """Number of indexed sets per key; 1 where it is not known."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.counts = keys[order], counts[order].astype(np.float64)

    def of(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.ones(len(keys))
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.counts[at], 1.0)


def signatures(tokens: np.ndarray, partition: Partition, costs: Costs) -> np.ndarray:
    """All keys of a set, with the role of each in its lowest bits."""
    size = len(tokens)
    band = partition.band(size)
    own = Subsets(tokens, partition, band)
    probed, wider = own.probes(partition.differences(size, size) + 1, costs)
    subsets = own.subsets | np.where(probed, np.uint64(INDEXED | PROBING), np.uint64(INDEXED))
    parts = [subsets, own.deletions | np.uint64(INDEXED), wider | np.uint64(PROBING)]
    high = partition.bands[band - 1][1] if band else 0
    if 100 * high >= partition.percent * size:
        below = Subsets(tokens, partition, band - 1)
        probed, wider = below.probes(partition.differences(size, high) + 1, costs)
        parts += [below.subsets[probed] | np.uint64(PROBING), wider | np.uint64(PROBING)]
    return np.concatenate(parts)


def slotted(keys: np.ndarray, ids: np.ndarray, costs: Costs) -> tuple[np.ndarray, np.ndarray]:
    """Keys of very many sets cut into slots."""
    slots = np.ceil(costs.of(keys & ~_ROLE) / SLOT_KEYS).astype(np.int64)
    many = slots > 1
    if not many.any():
        return keys, ids
    hot, hot_ids, slots = keys[many], ids[many], slots[many]
    own = (_mixed(hot_ids.view(np.uint64)) % slots.astype(np.uint64)).astype(np.int64)
    copies = np.where(hot & np.uint64(PROBING), slots, 1)
    row = np.repeat(np.arange(len(hot)), copies)
    step = np.arange(len(row)) - np.repeat(np.cumsum(copies) - copies, copies)
    slot = (own[row] + step) % slots[row]
    # an indexed set stays indexed in its own slot only
    role = np.where(step == 0, hot[row] & _ROLE, np.uint64(PROBING))
    cut = _mixed((hot[row] & ~_ROLE) + slot.astype(np.uint64)) & ~_ROLE | role
    return np.concatenate([keys[~many], cut]), np.concatenate([ids[~many], hot_ids[row]])


def buckets(keys: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``key, id, size`` of the buckets in which a set probes for another one;
    of buckets with the same sets only one."""
    base = keys >> np.uint64(2)
    order = np.argsort(base, kind="stable")
    base = base[order]
    same = base[1:] == base[:-1]
    keep = np.concatenate([same, [False]]) | np.concatenate([[False], same])
    order, base = order[keep], base[keep]
    role, ids = keys[order] & _ROLE, ids[order]
    inner = np.lexsort((ids, base))
    base, role, ids = base[inner], role[inner], ids[inner]
    if not len(base):
        return base.view(np.int64), ids, ids
    first = np.flatnonzero(np.concatenate([[True], (base[1:] != base[:-1]) | (ids[1:] != ids[:-1])]))
    base, ids, role = base[first], ids[first], np.bitwise_or.reduceat(role, first)
    start = np.flatnonzero(np.concatenate([[True], base[1:] != base[:-1]]))
    size = np.diff(np.concatenate([start, [len(base)]]))
    useful = (size > 1) & (np.bitwise_or.reduceat(role, start) == _ROLE)
    members = _mixed(np.add.reduceat(_mixed(ids.view(np.uint64)), start) + size.astype(np.uint64))
    chosen = np.zeros(len(start), bool)
    chosen[np.flatnonzero(useful)[np.unique(members[useful], return_index=True)[1]]] = True
    rows = np.repeat(chosen, size)
    return base[rows].view(np.int64), ids[rows], np.repeat(size[chosen], size[chosen])


def parities(tokens: np.ndarray) -> bytes:
    """A bit per place for a set, about one place per element: whether the
    number of elements there is odd."""
    places = max(64, 1 << (len(tokens) - 1).bit_length())
    odd = np.bincount((tokens & np.uint64(places - 1)).astype(np.int64), minlength=places) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def _folded(words: np.ndarray) -> np.ndarray:
    """Parities (last axis) over half as many places."""
    half = words.shape[-1] // 2
    return words[..., :half] ^ words[..., half:]


def may_link(size: int, bits: np.ndarray, sizes: np.ndarray, others: np.ndarray, partition: Partition) -> np.ndarray:
    """Whether a set may be linked to others, all of the same number of places,
    as far as sizes and parities tell."""
    if others.shape[1] > 2 * len(bits) or len(bits) > 2 * others.shape[1]:
        return np.zeros(len(sizes), bool)  # too different in size
    if len(bits) > others.shape[1]:
        bits = _folded(bits)
    elif len(bits) < others.shape[1]:
        others = _folded(others)
    different = np.bitwise_count(others ^ bits).sum(axis=1, dtype=np.int64)
    most = (size + sizes) * (100 - partition.percent) // (100 + partition.percent)
    return np.maximum(different, np.abs(sizes - size)) <= most


def _words(bits: bytes) -> np.ndarray:
    return np.frombuffer(bits, np.uint64)


def tile_pairs(left: list[tuple], right: list[tuple], partition: Partition) -> Iterator[tuple[int, int]]:
    """Pairs that may be linked, between ``(rep, component, payload)`` rows of
    different components; a payload is a size, then parities."""
    by_places: dict[int, list[tuple]] = {}
    for rep, group, payload in right:
        by_places.setdefault(len(payload), []).append((rep, group, payload))
    packed = []
    for rows in by_places.values():
        ids, groups = (np.array([r[i] for r in rows]) for i in (0, 1))
        bits = np.stack([_words(r[2]) for r in rows])
        packed.append((ids, groups, bits[:, 0].astype(np.int64), bits[:, 1:]))
    for rep, group, payload in left:
        own = _words(payload)
        for ids, groups, sizes, bits in packed:
            likely = may_link(int(own[0]), own[1:], sizes, bits, partition) & (groups != group)
            for other in ids[likely].tolist():
                yield min(rep, other), max(rep, other)


def _likely(partition: Partition):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    @task
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = Rows(schema)
        for batch in batches:
            for a, b, left, right in rows_in(batch, "a", "b", "pa", "pb"):
                for pair in tile_pairs([(a, a, left)], [(b, b, right)], partition):
                    yield from rows.add(pair, 16)
        yield from rows.flush()

    return run


def _sketcher():
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("print", pa.binary()), ("payload", pa.binary())])

    @task
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = Rows(schema)
        for batch in batches:
            for doc_id, text in rows_in(batch, "doc_id", "text"):
                found = shingle_set(text)
                if len(found):
                    payload = len(found).to_bytes(8, "little") + parities(found)
                    yield from rows.add((doc_id, len(found), fingerprint(found), payload), len(payload) + 48)
                else:
                    yield from rows.add((doc_id, 0, None, None), 48)
        yield from rows.flush()

    return run


def _counter(partition: Partition):
    """Keys that a chunk of a task's sets holds more than once."""
    schema = pa.schema([("key", pa.int64()), ("sets", pa.int64())])

    def counted(parts: list[np.ndarray]) -> pa.RecordBatch:
        keys, sets = np.unique(np.concatenate(parts), return_counts=True)
        again = sets > 1
        return pa.RecordBatch.from_arrays([pa.array(keys[again].view(np.int64)), pa.array(sets[again])], schema=schema)

    @task
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            for (text,) in rows_in(batch, "text"):
                tokens = shingle_set(text)
                keys = Subsets(tokens, partition, partition.band(len(tokens))).indexed()
                parts.append(keys)
                held += len(keys)
                if held >= CHUNK_KEYS:
                    yield counted(parts)
                    parts, held = [], 0
        if parts:
            yield counted(parts)

    return run


def _signer(partition: Partition, places: int, common):
    """Keys and ids of a task's sets, dealt by the key into ``places``."""
    schema = pa.schema([("place", pa.int64()), ("keys", pa.binary()), ("ids", pa.binary())])

    def dealt(parts: list[np.ndarray], ids: list[int], costs: Costs) -> Iterator[pa.RecordBatch]:
        owner = np.repeat(np.array(ids, np.int64), [len(p) for p in parts])
        keys, owner = slotted(np.concatenate(parts), owner, costs)
        place = ((keys >> np.uint64(2)) % np.uint64(places)).astype(np.int64)
        order = np.argsort(place, kind="stable")
        place, keys, owner = place[order], keys[order], owner[order]
        start = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        rows = Rows(schema)
        for a, b in zip(start.tolist(), [*start[1:].tolist(), len(place)], strict=True):
            yield from rows.add((int(place[a]), keys[a:b].tobytes(), owner[a:b].tobytes()), 16 * (b - a) + 40)
        yield from rows.flush()

    @task
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        costs, parts, ids, held = Costs(*common.value), [], [], 0
        for batch in batches:
            for doc_id, text in rows_in(batch, "doc_id", "text"):
                keys = signatures(shingle_set(text), partition, costs)
                parts.append(keys)
                ids.append(doc_id)
                held += len(keys)
                if held >= CHUNK_KEYS:
                    yield from dealt(parts, ids, costs)
                    parts, ids, held = [], [], 0
        if parts:
            yield from dealt(parts, ids, costs)

    return run


def _grouper():
    """Reads all keys of a partition; a key lies in one partition."""
    schema = pa.schema([("key", pa.int64()), ("rep", pa.int64()), ("a", pa.int64()), ("size", pa.int64())])

    @task
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, ids = [], []
        for batch in batches:
            for key_bytes, id_bytes in rows_in(batch, "keys", "ids"):
                keys.append(np.frombuffer(key_bytes, np.uint64))
                ids.append(np.frombuffer(id_bytes, np.int64))
        if not keys:
            return
        key, rep, size = buckets(np.concatenate(keys), np.concatenate(ids))
        # a bucket's ids are sorted, so its smallest one comes first
        first = np.concatenate([[True], key[1:] != key[:-1]]) if len(key) else np.zeros(0, bool)
        smallest = rep[np.maximum.accumulate(np.where(first, np.arange(len(key)), 0))] if len(key) else rep
        for at in range(0, len(key), 100_000):
            part = slice(at, at + 100_000)
            yield pa.RecordBatch.from_arrays([pa.array(c[part]) for c in (key, rep, smallest, size)], schema=schema)

    return run


def _set_maker():
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("shingles", pa.list_(pa.int64()))])

    @task
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = Rows(schema)
        for batch in batches:
            for doc_id, text in rows_in(batch, "doc_id", "text"):
                found = shingle_set(text)
                yield from rows.add((doc_id, len(found), found.view("int64")), 8 * len(found) + 40)
        yield from rows.flush()

    return run


def _only(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of ``texts`` whose id is in a stored table."""
    return texts.join(F.broadcast(ids) if scratch.measure(ids).broadcastable else ids, "doc_id", "left_semi")


def _with_sides(pairs: DataFrame, sets: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Columns of both sets of each pair; ``sets`` is stored, with a row per id
    and ``pairs``, how many pairs it is in."""
    for x in ("b", "a"):
        side = sets.select(F.col("doc_id").alias(x), *[F.col(c).alias(short + x) for c, short in columns.items()], F.col("pairs").alias("_pairs"))
        pairs = lookup_join(pairs, side, [x], ["a", "b"], "_pairs", 2_000)
    return pairs


def _members(pairs: DataFrame) -> DataFrame:
    """Stored ids in ``pairs`` with the number of their pairs."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("doc_id"))
    return scratch.store(ids.groupBy("doc_id").agg(F.count(F.lit(1)).alias("pairs")), "members")


def _likely_pairs(pairs: DataFrame, reps: DataFrame, partition: Partition, repeated: bool) -> DataFrame:
    """Stored rows of the stored ``pairs`` that sizes and parities allow."""
    if repeated:
        return pairs  # an id may have several sets
    payloads = scratch.store(reps.join(_members(pairs), "doc_id"), "payloads")
    both = _with_sides(pairs, payloads, {"payload": "p"}).select("a", "b", "pa", "pb")
    return scratch.store(both.mapInArrow(_likely(partition), "a long, b long"), "likely")


def _verified(texts: DataFrame, pairs: DataFrame, percent: int, repeated: bool) -> DataFrame:
    """Stored rows ``a, b`` of the stored ``pairs`` that are similar enough, by
    a whole-number test on the full sets."""
    members = _members(pairs)
    sets = _only(texts, members.select("doc_id")).mapInArrow(_set_maker(), "doc_id long, n long, shingles array<long>")
    sets = scratch.store((sets.distinct() if repeated else sets).join(members, "doc_id"), "sets")
    if repeated:
        # several sets of an id; a document of very many pairs is a skewed key, which Spark splits
        both = pairs
        for x in ("b", "a"):
            both = both.join(sets.select(F.col("doc_id").alias(x), F.col("n").alias("n" + x), F.col("shingles").alias("x" + x)), x)
    else:
        both = _with_sides(pairs, sets, {"n": "n", "shingles": "x"})
    shared = F.size(F.array_intersect("xa", "xb"))
    linked = F.lit(100) * shared >= F.lit(percent) * (F.col("na") + F.col("nb") - shared)
    return scratch.store(both.where(linked).select("a", "b"), "links")


def _common(reps: DataFrame, partition: Partition) -> tuple[np.ndarray, np.ndarray]:
    """Counts of the keys that most sets are indexed under, a bounded number."""
    counted = reps.mapInArrow(_counter(partition), "key long, sets long").groupBy("key").agg(F.sum("sets").alias("sets"))
    rows = counted.where(F.col("sets") >= COMMON).orderBy(F.col("sets").desc(), "key").limit(MOST_COMMON).toPandas()
    return rows["key"].to_numpy(np.int64).view(np.uint64), rows["sets"].to_numpy(np.int64)


def jaccard_components(docs: DataFrame, percent: int = 80) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_shingles, component_id``."""
    spark, partition = docs.sparkSession, Partition(percent)
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    sketched = scratch.store(texts.mapInArrow(_sketcher(), "doc_id long, n long, print binary, payload binary"), "sketches")
    classed = scratch.store(classes(sketched), "classed")
    known = classed.where(F.col("rep").isNotNull())
    ids = known.groupBy("doc_id").agg(F.count(F.lit(1)).alias("_count"), F.min("rep").alias("_least"))
    ids = scratch.store(ids.where(F.col("_count") > 1), "repeated")
    repeated = not ids.isEmpty()

    reps = known.where(F.col("doc_id") == F.col("rep")).select("doc_id", "n", "payload")
    reps = scratch.store(reps.distinct() if repeated else reps, "reps")
    rep_texts = _only(texts, reps.select("doc_id").distinct()).where(F.col("text").rlike(WORD))
    common = spark.sparkContext.broadcast(_common(rep_texts, partition))
    # a set has about 0.55 keys per element at 80 percent
    elements = reps.agg(F.sum("n").alias("n")).first()["n"] or 0
    tasks = max(1, -(-elements // TASK_KEYS))
    signed = rep_texts.mapInArrow(_signer(partition, 4 * tasks, common), "place long, keys binary, ids binary")
    grouped = signed.repartition(tasks, "place").mapInArrow(_grouper(), "key long, rep long, a long, size long")
    grouped = scratch.store(grouped, "shared")
    common.destroy()

    stars = scratch.store(grouped.where("a != rep").select("a", F.col("rep").alias("b")).distinct(), "stars")
    links = _verified(texts, _likely_pairs(stars, reps, partition, repeated), percent, repeated)
    if repeated:
        # rows of one doc_id are one node, whatever classes they are in
        same = lookup_join(known.select("doc_id", "rep"), ids, ["doc_id"], ["rep"], "_count", 20_000)
        links = links.unionByName(same.where("_least != rep").select(F.col("_least").alias("a"), F.col("rep").alias("b")))
    components = connected_components(links)

    sizes = reps.groupBy(F.col("doc_id").alias("rep")).agg(F.max("n").alias("n"))
    shared = grouped.where(F.col("size") > 2).join(sizes, "rep").select("key", "rep", "n", "size")
    payloads = lambda wanted: reps.join(wanted, "doc_id", "left_semi").select(F.col("doc_id").alias("rep"), "payload")
    hidden = hidden_pairs(shared, components, payloads, partial(tile_pairs, partition=partition))
    hidden = scratch.store(hidden.distinct(), "hidden")
    components = joined_components(components, _verified(texts, hidden, percent, repeated))

    result = with_components(classed.select("doc_id", "n", "rep"), "rep", components, "component_id")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return result.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))
