"""Exact top-k by inner product: exhaustive term-at-a-time accumulation.

Vectors become whole-number rows ``floor(1024 * x)``. Candidates and queries
are dealt into blocks of bounded size, and every pair of blocks is one task's
work: the block's candidates form posting lists, one per component, with the
weights that are not zero. A query's weights scatter each list, times the
query's weight, into a dense array of scores, one per candidate. Partition
selection keeps the best of the block, and a window merges the blocks.

Nulls and edges: a vector that is NULL, or holds a NULL or non-finite
component, takes no part; nor does a row without vec_id. Vectors of different
lengths meet on their common components. An empty vector scores 0. Rows that share a vec_id are
queries and candidates each for itself; a query's own row is the only one it
does not meet. Values beyond the range of a long stop at
its ends, and scores are taken modulo 2**64. An empty table gives an empty
result. Other columns of the input are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tatemono.sources import scratch

SCALE = 1024
EVERY = 100  # queries are the ids divisible by this
TOP = 10
CANDIDATES = 16_384  # per block
QUERIES = 1024  # per block


def whole_vectors(table: DataFrame, scale: int = SCALE) -> DataFrame:
    """``row, vec_id, w``: whole-number vectors with a number per row."""
    x = F.col("embedding").cast("array<double>")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf"))))
    scaled = F.transform(x, lambda v: F.floor(F.lit(scale) * v))
    usable = table.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & ~bad)
    return usable.select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long"), scaled.alias("w"))


def _postings(vectors: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per component: the places of the vectors that have it, and their weights."""
    width = max((len(v) for v in vectors), default=0)
    dense = np.zeros((width, len(vectors)), np.int64)
    for place, v in enumerate(vectors):
        dense[: len(v), place] = v
    lists = []
    for row in dense:
        places = np.flatnonzero(row)
        lists.append((places, row[places]))
    return lists


def _best(scores: np.ndarray, ids: np.ndarray, top: int) -> np.ndarray:
    """Places of the ``top`` highest scores, ties to smaller ids."""
    if len(scores) > top:
        # everything that reaches the lowest chosen score, so ties are whole
        least = scores[np.argpartition(scores, len(scores) - top)[len(scores) - top :]].min()
        places = np.flatnonzero(scores >= least)
    else:
        places = np.arange(len(scores))
    return places[np.lexsort((ids[places], ~scores[places]))][:top]


def _search(top: int):
    columns = ("asking", "query_id", "vec_id", "score")

    def run(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):  # a block may be empty
            return pd.DataFrame({c: [] for c in columns}, dtype="int64")
        ids, rows = left["vec_id"].to_numpy(np.int64), left["row"].to_numpy(np.int64)
        lists = _postings(left["w"].tolist())
        found = []
        for asking, query, weights in zip(right["asking"].tolist(), right["query_id"].tolist(), right["weights"].tolist(), strict=True):
            scores = np.zeros(len(ids), np.int64)
            for term in np.flatnonzero(weights[: len(lists)]).tolist():
                places, values = lists[term]
                scores[places] += weights[term] * values
            others = np.flatnonzero(rows != asking)
            chosen = others[_best(scores[others], ids[others], top)]
            found.append((np.full(len(chosen), asking), np.full(len(chosen), query), ids[chosen], scores[chosen]))
        return pd.DataFrame(dict(zip(columns, (np.concatenate(c) for c in zip(*found, strict=True)), strict=True)))

    return run


def top_k(
    table: DataFrame, top: int = TOP, every: int = EVERY, candidates: int = CANDIDATES, queries: int = QUERIES
) -> DataFrame:
    """Per query its ``top`` best vectors: ``query_id, rank, vec_id, score``."""
    vectors = scratch.store(whole_vectors(table), "vectors")  # stored, so that a row keeps its number
    asked = vectors.where(F.col("vec_id") % every == 0)
    sizes = vectors.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("vec_id") % every == 0).alias("q")).first()
    n_blocks = max(1, -(-sizes["n"] // candidates))
    q_blocks = max(1, -(-sizes["q"] // queries))
    place = F.xxhash64("row")  # rows are distinct, so blocks are near equal
    every_q = F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1)))
    every_c = F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)))
    left = vectors.select(F.pmod(place, F.lit(n_blocks)).cast("int").alias("c"), every_q.alias("q"), "row", "vec_id", "w")
    right = asked.select(
        every_c.alias("c"), F.pmod(place, F.lit(q_blocks)).cast("int").alias("q"),
        F.col("row").alias("asking"), F.col("vec_id").alias("query_id"), F.col("w").alias("weights"),
    )
    found = (
        left.groupBy("c", "q")
        .cogroup(right.groupBy("c", "q"))
        .applyInPandas(_search(top), "asking long, query_id long, vec_id long, score long")
    )
    best = Window.partitionBy("asking").orderBy(F.col("score").desc(), F.col("vec_id"))
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return ranked.select("query_id", "rank", "vec_id", "score")
