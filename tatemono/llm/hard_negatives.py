"""Hard negatives by inner product, with segment summaries as a filter.

Vectors become whole numbers ``floor(256 * x)``. A vector is cut into segments
of ``SEGMENT`` components; each segment's mean and deviation are stored with
it. For two segments of n components with means m, k and deviations s, t the
inner product lies within ``n * (m * k - s * t)`` and ``n * (m * k + s * t)``,
so sums over the segments bound a score from both sides. Summaries of two
neighbours merge into that of one segment of twice the length; bounds begin
with one segment for the whole vector and halve the segments as long as a
candidate stays in doubt. Only what passes the finest level is scored.

Anchors and candidates are dealt into blocks of bounded size, and each pair of
blocks is one task's work. Two searches follow each other:

1. Positives: the best rows of the anchor's label. A block drops candidates
   whose upper bound is below the anchor's k-th best lower bound.
2. Negatives: for each positive the best rows of other labels whose score lies
   between a share of the positive's score and that score. A block drops
   candidates whose bounds miss the interval, and those whose upper bound is
   below the k-th best lower bound of candidates that surely lie inside.

A window merges the blocks after each search.

Nulls and edges: a row without vec_id or label takes no part, nor does a
vector that is NULL or holds a NULL or non-finite component. Every other row
counts, also those that repeat a vec_id or a vector; an anchor's own row is the
only one it does not meet. Vectors of different lengths meet on their common
components, and an empty vector scores 0. Values beyond the range of a long
stop at its ends and scores are taken modulo 2**64; blocks with values so large
that bounds might round are scored without them. An anchor without a positive,
or a positive without a negative, gives no row. An empty table gives an empty
result. Other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tatemono.sources import scratch

SCALE = 256
EVERY = 100  # anchors are the ids divisible by this
MOVED = 7  # ids divisible by this have their label moved on, cyclically
LABELS = 10
POSITIVES = NEGATIVES = 5
LEAST_PERCENT = 80  # of the positive's score
SEGMENT = 4  # components of the finest segments
CANDIDATES = 8192  # per block
ANCHORS = 1024  # per block
# whole numbers are exact in a double while sums of products stay below
_EXACT = float(1 << 52)
_ASKING = "anchor_"

_VECTORS = "row long, vec_id long, label long, w array<long>, means array<double>, deviations array<double>"


def _usable(table: DataFrame) -> DataFrame:
    """``row, vec_id, label, w`` of the rows that take part."""
    x = F.col("embedding").cast("array<double>")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf"))))
    present = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % MOVED == 0, (label + 1) % LABELS).otherwise(label)
    return table.where(present & ~bad).select(
        F.monotonically_increasing_id().alias("row"),
        F.col("vec_id").cast("long").alias("vec_id"),
        moved.alias("label"),
        F.transform(x, lambda v: F.floor(F.lit(SCALE) * v)).alias("w"),
    )


def summaries(w: np.ndarray, segment: int = SEGMENT) -> tuple[np.ndarray, np.ndarray]:
    """Mean and deviation of each segment; the last one is filled with zeros."""
    filled = np.zeros(-(-len(w) // segment) * segment)
    filled[: len(w)] = w
    parts = filled.reshape(-1, segment)
    return parts.mean(axis=1), parts.std(axis=1)


def _summarised(batches):
    for rows in batches:
        found = [summaries(w) for w in rows["w"]]
        rows["means"], rows["deviations"] = [m for m, _ in found], [d for _, d in found]
        yield rows


def _matrix(rows: pd.Series, width: int, kind: type) -> np.ndarray:
    """One row each, filled with zeros."""
    out = np.zeros((len(rows), width), kind)
    for i, row in enumerate(rows):
        out[i, : len(row)] = row
    return out


def levels(means: np.ndarray, deviations: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Means and deviations with one segment, two, four and so on, weighted by
    the root of a segment's length, so that a bound is a sum of products.
    ``means`` has a power of two of columns, one at least."""
    length, found = SEGMENT, []
    variance = deviations * deviations
    while True:
        root = np.sqrt(length)
        found.append((means * root, np.sqrt(variance) * root))
        if means.shape[1] == 1:
            return found[::-1]
        left, right = means[:, ::2], means[:, 1::2]
        variance = (variance[:, ::2] + variance[:, 1::2]) / 2 + ((left - right) / 2) ** 2
        means, length = (left + right) / 2, 2 * length


class Block:
    """Rows of one side of a pair of blocks."""

    def __init__(self, rows: pd.DataFrame, width: int, segments: int):
        self.rows = rows["row"].to_numpy(np.int64)
        self.ids = rows["vec_id"].to_numpy(np.int64)
        self.labels = rows["label"].to_numpy(np.int64)
        self.w = _matrix(rows["w"], width, np.int64)
        self.levels = levels(_matrix(rows["means"], segments, float), _matrix(rows["deviations"], segments, float))
        self.size = float(np.abs(self.w.astype(float)).max(initial=0.0))


def blocks(anchors: pd.DataFrame, candidates: pd.DataFrame) -> tuple[Block, Block]:
    """Both sides with as many components and segments."""
    width = max((len(w) for side in (anchors, candidates) for w in side["w"]), default=0)
    segments = 1 << max(0, -(-width // SEGMENT) - 1).bit_length()
    return Block(anchors, width, segments), Block(candidates, width, segments)


# what may stay of candidates with lower and upper bounds of their scores
Doubt = Callable[[np.ndarray, np.ndarray], np.ndarray]


def refine(left: Block, anchor: int, right: Block, places: np.ndarray, doubt: Doubt) -> tuple[np.ndarray, np.ndarray]:
    """Places of the candidates that stay in ``doubt`` at every level, and
    their exact scores."""
    if left.size * right.size * max(1, left.w.shape[1]) < _EXACT:
        for (am, ad), (cm, cd) in zip(left.levels, right.levels, strict=True):
            middle, reach = cm[places] @ am[anchor], cd[places] @ ad[anchor]
            reach += 1e-9 * (1.0 + np.abs(middle) + reach)  # rounding
            places = places[doubt(np.ceil(middle - reach), np.floor(middle + reach))]
            if not len(places):
                break
    return places, right.w[places] @ left.w[anchor]


def _kth_best(values: np.ndarray, k: int) -> float:
    return np.partition(values, len(values) - k)[len(values) - k] if len(values) >= k else -np.inf


def best(scores: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores, ties to smaller ids."""
    return np.lexsort((rows, ids, ~scores))[:k]


def positives_of(left: Block, anchor: int, right: Block, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and scores of the ``k`` best other rows of the anchor's label."""
    places = np.flatnonzero((right.labels == left.labels[anchor]) & (right.rows != left.rows[anchor]))
    places, scores = refine(left, anchor, right, places, lambda low, high: high >= _kth_best(low, k))
    order = best(scores, right.ids[places], right.rows[places], k)
    return places[order], scores[order]


def negatives_of(
    left: Block, anchor: int, right: Block, positives: set[int], k: int, percent: int
) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """For each score of a positive, places and scores of the ``k`` best rows
    of other labels that score between ``percent`` of it and it. The bounds are
    worked out once for all positives of the anchor."""
    spans = [(-(-percent * score // 100), score) for score in positives]
    spans = [(least, score) for least, score in spans if least <= score]
    if not spans:
        return {}

    def doubt(low: np.ndarray, high: np.ndarray) -> np.ndarray:
        stay = np.zeros(len(low), bool)
        for least, score in spans:
            surely = (low >= least) & (high <= score)
            stay |= (high >= max(least, _kth_best(low[surely], k))) & (low <= score)
        return stay

    places, scores = refine(left, anchor, right, np.flatnonzero(right.labels != left.labels[anchor]), doubt)
    found = {}
    for least, score in spans:
        inside = (scores >= least) & (scores <= score)
        own, own_scores = places[inside], scores[inside]
        order = best(own_scores, right.ids[own], right.rows[own], k)
        found[score] = own[order], own_scores[order]
    return found


_POSITIVE = {"anchor": "int64", "row": "int64", "vec_id": "int64", "score": "int64"}
_NEGATIVE = {"anchor": "int64", "number": "int64", "row": "int64", "vec_id": "int64", "score": "int64"}


def _frame(found: list[tuple], columns: dict[str, str]) -> pd.DataFrame:
    return pd.DataFrame(found, columns=list(columns)).astype(columns)


def _positive_search(k: int):
    def run(candidates: pd.DataFrame, anchors: pd.DataFrame) -> pd.DataFrame:
        if not len(anchors) or not len(candidates):  # a block may be empty
            return _frame([], _POSITIVE)
        anchors = anchors.rename(columns=lambda c: c.removeprefix(_ASKING))
        left, right = blocks(anchors, candidates)
        found = []
        for anchor, row in enumerate(left.rows.tolist()):
            places, scores = positives_of(left, anchor, right, k)
            found += [(row, right.rows[p], right.ids[p], s) for p, s in zip(places, scores, strict=True)]
        return _frame(found, _POSITIVE)

    return run


def _negative_search(k: int, percent: int):
    def run(candidates: pd.DataFrame, anchors: pd.DataFrame) -> pd.DataFrame:
        if not len(anchors) or not len(candidates):
            return _frame([], _NEGATIVE)
        anchors = anchors.rename(columns=lambda c: c.removeprefix(_ASKING))
        left, right = blocks(anchors, candidates)
        found = []
        for anchor, (row, scores) in enumerate(zip(left.rows.tolist(), anchors["scores"], strict=True)):
            scores = [int(score) for score in scores]
            known = negatives_of(left, anchor, right, set(scores), k, percent)
            for number, score in enumerate(scores):
                if score in known:
                    found += [(row, number, right.rows[p], right.ids[p], s) for p, s in zip(*known[score], strict=True)]
        return _frame(found, _NEGATIVE)

    return run


def _schema(columns: dict[str, str]) -> str:
    return ", ".join(f"{c} long" for c in columns)


def _first(rows: DataFrame, by: list[str | Column], k: int) -> DataFrame:
    """The ``k`` best rows of each group, numbered from 1."""
    order = Window.partitionBy(*by).orderBy(F.col("score").desc(), "vec_id", "row")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(
    table: DataFrame,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    every: int = EVERY,
    least_percent: int = LEAST_PERCENT,
    candidates: int = CANDIDATES,
    anchors: int = ANCHORS,
) -> DataFrame:
    """Per anchor and positive its hard negatives: ``anchor_id, positive_id,
    rank, negative_id, positive_score, negative_score``."""
    # stored, so that a row keeps its number
    vectors = scratch.store(scratch.store(_usable(table), "usable").mapInPandas(_summarised, _VECTORS), "vectors")
    asked = F.col("vec_id") % every == 0
    sizes = vectors.agg(F.count(F.lit(1)).alias("n"), F.count_if(asked).alias("a")).first()
    c_blocks, a_blocks = max(1, -(-sizes["n"] // candidates)), max(1, -(-sizes["a"] // anchors))
    place = F.xxhash64("row")  # rows are distinct, so blocks are near equal
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = vectors.select(F.pmod(place, F.lit(c_blocks)).cast("int").alias("c"), each(a_blocks).alias("a"), *vectors.columns)

    def met(asking: DataFrame, search, columns: dict[str, str]) -> DataFrame:
        # names of their own keep Spark from taking columns of one side for the other's
        own = [F.col(c).alias(f"{_ASKING}{c}") for c in asking.columns]
        right = asking.select(each(c_blocks).alias("c"), F.pmod(place, F.lit(a_blocks)).cast("int").alias("a"), *own)
        return left.groupBy("c", "a").cogroup(right.groupBy("c", "a")).applyInPandas(search, _schema(columns))

    own = vectors.where(asked)
    found = _first(met(own, _positive_search(positives), _POSITIVE), ["anchor"], positives)
    grouped = found.groupBy(F.col("anchor").alias("row")).agg(
        F.array_sort(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("found")  # a few each
    )
    asking = scratch.store(
        own.join(grouped, "row").withColumns({"positives": F.col("found.vec_id"), "scores": F.col("found.score")}).drop("found"), "asking"
    )
    chosen = _first(met(asking.drop("positives"), _negative_search(negatives, least_percent), _NEGATIVE), ["anchor", "number"], negatives)
    named = asking.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"), F.posexplode(F.arrays_zip("positives", "scores")).alias("number", "positive"))
    named = named.select(
        "anchor", "anchor_id", F.col("number").cast("long").alias("number"),
        F.col("positive.positives").alias("positive_id"), F.col("positive.scores").alias("positive_score"),
    )
    return chosen.join(named, ["anchor", "number"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
