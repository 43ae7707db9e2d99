"""Quality rules: base limits, then robust multivariate outliers.

Each document's statistics become a vector. Per language and source the
minimum-covariance-determinant estimate is found by concentration steps: the
three quarters of the vectors nearest to the current centre give the next
centre and covariance, until the determinant falls no more. Two starts are tried, medians with absolute deviations
and the plain moments, and the one with the smaller determinant is used. A
document whose squared Mahalanobis distance exceeds the cutoff is rejected.

DataFrame operations only. A step is two aggregations over narrow rows with
partial sums, so a hot group is no hot task. The cut at three quarters is found
on counts of distances in fine steps, not on sorted rows. Variances have a
floor, so that groups of nearly equal documents reject nothing that is only
slightly different.

Nulls and edges: a NULL text has no words. NULL languages and sources are
groups of their own. Groups of fewer than ``MIN_GROUP`` documents share one
estimate; if all of them together are fewer, the method keeps their documents.
Repeated rows are judged each for itself. An empty table gives an empty
result. Other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tatemono.llm.mixing import source_key
from tatemono.llm.text import SPACES
from tatemono.operators.joins import lookup_join
from tatemono.sources import scratch

WINDOW = 5
MIN_WORDS = 10
MOST_REPEATED_PERCENT = 20
SYMBOLS = "#*$%&|<>"

SHARE = 0.75  # of a group that the estimate covers
SHARE_QUANTILE = 6.6257  # of chi-square with 5 degrees of freedom at SHARE
CUTOFF = 36.0  # about the 0.999999 quantile
MIN_GROUP = 50
LEAST_FALL = 1e-6  # of the logarithm of the determinant; less counts as none
FINE = 64  # steps of the distance per factor e

# words and their characters that every document's rates count besides its own
PRIOR_WORDS, PRIOR_CHARS = 20, 110
# deviations below these say nothing
FLOORS = (0.3, 0.4, 0.05, 0.5, 0.05)
X = tuple(f"x{i}" for i in range(len(FLOORS)))
P = len(X)

_ANY_SPACE = r"[\x20\x09-\x0D]+"


def _repeated_words(windows: Column) -> Column:
    """Words covered by windows that occur twice or more, from the windows'
    hashes in order. Equal hashes are neighbours once sorted."""
    placed = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.aggregate(
        F.array_sort(
            F.flatten(
                F.transform(
                    F.filter(
                        F.arrays_zip(
                            F.slice(placed, 1, F.size(placed) - 1).alias("a"), F.slice(placed, 2, F.size(placed)).alias("b")
                        ),
                        lambda z: z["a"]["h"] == z["b"]["h"],
                    ),
                    lambda z: F.array(z["a"]["i"], z["b"]["i"]),
                )
            )
        ),
        F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("long").alias("n")),
        lambda acc, i: F.struct(i.alias("last"), (acc["n"] + F.least(F.lit(WINDOW), i - acc["last"])).alias("n")),
        lambda acc: acc["n"],
    )


def text_statistics(docs: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Columns ``keep`` and ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words``."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(*keep, text.alias("_text"))
    bare = F.btrim("_text", F.lit(SPACES))
    rows = rows.withColumn("_words", F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, _ANY_SPACE)))
    lines = F.filter(F.split("_text", "\n"), lambda line: F.btrim(line, F.lit(SPACES)) != "")
    rows = rows.withColumns({"_hashes": F.transform("_words", lambda w: F.xxhash64(w)), "_lines": lines})
    several = F.size("_hashes") >= WINDOW
    window = F.transform(
        F.sequence(F.lit(0), F.size("_hashes") - WINDOW),
        lambda i: F.xxhash64(*[F.get("_hashes", i + k) for k in range(WINDOW)]),
    )
    rows = rows.withColumn("_windows", F.when(several, window).otherwise(F.array().cast("array<bigint>")))
    # most texts repeat no window at all
    repeats = F.size(F.array_distinct("_windows")) < F.size("_windows")
    return rows.select(
        *keep,
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.translate("_text", SPACES, "")).cast("long").alias("word_chars"),
        (F.length("_text") - F.length(F.translate("_text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.when(repeats, _repeated_words(F.col("_windows"))).otherwise(F.lit(0).cast("long")).alias("n_repeat_words"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))


def _vector() -> dict[str, Column]:
    """Transformed statistics. Rates count some more words of usual length, so
    that a few words say little about a rate."""
    words, chars = F.col("n_words") + PRIOR_WORDS, F.col("word_chars") + PRIOR_CHARS
    parts = (
        F.log1p("n_words"),
        chars / words,
        F.sqrt(F.col("n_symbols") / chars),
        F.log1p("n_dup_lines"),
        F.col("n_repeat_words") / words,
    )
    return dict(zip(X, parts, strict=True))


def _moments(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """Per group count, centre ``m*`` and covariance ``s*_*`` of the vectors."""
    sums = [F.sum(x).alias(f"t{i}") for i, x in enumerate(X)]
    products = [F.sum(F.col(X[i]) * F.col(X[j])).alias(f"q{i}_{j}") for i in range(P) for j in range(i + 1)]
    grouped = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), *sums, *products)
    mean = lambda i: F.col(f"t{i}") / F.col("n")
    return grouped.select(
        *by,
        *[mean(i).alias(f"m{i}") for i in range(P)],
        *[(F.col(f"q{i}_{j}") / F.col("n") - mean(i) * mean(j)).alias(f"s{i}_{j}") for i in range(P) for j in range(i + 1)],
    )


def _factored(model: DataFrame, by: Sequence[str]) -> DataFrame:
    """Cholesky factor ``l*_*`` of covariance plus floors, and ``log_det``."""
    for j in range(P):
        for i in range(j, P):
            rest = F.col(f"s{i}_{j}")
            if i == j:
                rest = F.greatest(rest, F.lit(0.0)) + F.lit(FLOORS[i] ** 2)
            for k in range(j):
                rest = rest - F.col(f"l{i}_{k}") * F.col(f"l{j}_{k}")
            value = F.sqrt(F.greatest(rest, F.lit(FLOORS[i] ** 2 / 4))) if i == j else rest / F.col(f"l{j}_{j}")
            model = model.withColumn(f"l{i}_{j}", value)
    log_det = sum((F.log(f"l{i}_{i}") for i in range(P)), F.lit(0.0)) * 2
    factor = [f"l{i}_{j}" for i in range(P) for j in range(i + 1)]
    return model.select(*by, *[f"m{i}" for i in range(P)], *factor, log_det.alias("log_det"))


def _with_distance(rows: DataFrame, model: DataFrame, rows_of: DataFrame) -> DataFrame:
    """Joins the model of the row's group; ``d2`` by forward substitution."""
    dim = scratch.store(model.join(rows_of, "group"), "model")
    joined = lookup_join(rows, dim, ["group"], ["row"], "_count")
    for i in range(P):
        rest = F.col(X[i]) - F.col(f"m{i}")
        for k in range(i):
            rest = rest - F.col(f"l{i}_{k}") * F.col(f"z{k}")
        joined = joined.withColumn(f"z{i}", rest / F.col(f"l{i}_{i}"))
    d2 = sum((F.col(f"z{i}") * F.col(f"z{i}") for i in range(P)), F.lit(0.0))
    drop = [f"z{i}" for i in range(P)] + [c for c in model.columns if c[0] in "ml" and c[1].isdigit()]
    return joined.withColumn("d2", d2).drop(*drop)


def _cuts(distances: DataFrame, by: Sequence[str]) -> DataFrame:
    """Per group the fine step of distance that holds three quarters of its rows."""
    counted = distances.groupBy(*by, _fine()).agg(F.count(F.lit(1)).alias("n"))
    up_to = Window.partitionBy(*by).orderBy("fine").rowsBetween(Window.unboundedPreceding, 0)
    counted = counted.select(*by, "fine", F.sum("n").over(up_to).alias("below"), F.sum("n").over(Window.partitionBy(*by)).alias("all"))
    return counted.where(F.col("below") >= F.ceil(F.col("all") * SHARE)).groupBy(*by).agg(F.min("fine").alias("cut"))


def _fine() -> Column:
    return F.floor(F.log(F.col("d2") + F.lit(1e-9)) * FINE).cast("int").alias("fine")


def _starts(rows: DataFrame) -> DataFrame:
    """``group, start`` and moments: medians with scaled absolute deviations,
    and means with covariances."""
    medians = rows.groupBy("group").agg(
        F.count(F.lit(1)).alias("_count"), *[F.percentile_approx(x, 0.5).alias(f"m{i}") for i, x in enumerate(X)]
    )
    near = lookup_join(rows, scratch.store(medians, "medians"), ["group"], ["row"], "_count")
    spread = near.groupBy("group").agg(
        *[F.first(f"m{i}").alias(f"m{i}") for i in range(P)],
        *[F.percentile_approx(F.abs(F.col(x) - F.col(f"m{i}")), 0.5).alias(f"a{i}") for i, x in enumerate(X)],
    )
    deviation = lambda i, j: F.pow(F.col(f"a{i}") * 1.4826, F.lit(2.0)) if i == j else F.lit(0.0)
    robust = spread.select(
        "group",
        F.lit(0).alias("start"),
        *[f"m{i}" for i in range(P)],
        *[deviation(i, j).alias(f"s{i}_{j}") for i in range(P) for j in range(i + 1)],
    )
    return robust.unionByName(_moments(rows, ["group"]).withColumn("start", F.lit(1)))


def estimates(rows: DataFrame) -> DataFrame:
    """Stored model per group of ``rows`` (``row, group, x*``): centre, factor
    and the consistency factor ``scale``."""
    sizes = scratch.store(rows.groupBy("group").agg(F.count(F.lit(1)).alias("_count")), "groups")
    by = ["group", "start"]
    model = moving = _concentrated(rows, _factored(_starts(rows), by), sizes)
    while not moving.isEmpty():
        # what no longer falls has its result; ends, as a determinant has its floors
        further = _concentrated(rows, moving, sizes)
        before = model.select(*by, F.col("log_det").alias("_before"))
        fell = further.join(before, by).where(F.col("log_det") < F.col("_before") - F.lit(LEAST_FALL)).drop("_before")
        moving = scratch.store(fell, "moving")
        model = scratch.store(model.join(moving, by, "left_anti").unionByName(moving), "models")
    near = _with_distance(rows, model, sizes)
    cuts = _cuts(near, by).select("group", "start", F.greatest(F.exp((F.col("cut") + 1) / FINE) / SHARE_QUANTILE, F.lit(1.0)).alias("scale"))
    best = model.groupBy("group").agg(F.min_by("start", F.struct("log_det", "start")).alias("start"))
    return model.join(best, by).join(cuts, by).drop("start", "log_det")


def _concentrated(rows: DataFrame, model: DataFrame, sizes: DataFrame) -> DataFrame:
    """Stored model after one concentration step, for the groups and starts
    of ``model``."""
    by = ["group", "start"]
    near = _with_distance(rows, model, sizes).where(F.col("start").isNotNull())
    chosen = scratch.store(_cuts(near, by).join(sizes, "group"), "cuts")
    return scratch.store(_factored(_moments(_near_cut(near, chosen), by), by), "step")


def _near_cut(near: DataFrame, cuts: DataFrame) -> DataFrame:
    """Rows not beyond their group's cut."""
    dim = cuts.groupBy("group").agg(
        F.max("_count").alias("_count"), F.map_from_entries(F.collect_list(F.struct("start", "cut"))).alias("cuts")
    )
    joined = lookup_join(near, scratch.store(dim, "dim"), ["group"], ["row"], "_count")
    return joined.where(_fine() <= F.element_at("cuts", F.col("start"))).drop("cuts")


def judge_documents(docs: DataFrame, cutoff: float = CUTOFF, min_group: int = MIN_GROUP) -> DataFrame:
    """Per row: ``doc_id``, the statistics, ``base_failed`` and ``kept``."""
    keyed = docs.select(
        "doc_id", "text", F.concat_ws("/", source_key(F.col("lang")), source_key(F.col("source"))).alias("_group")
    )
    stats = text_statistics(keyed, ["doc_id", "_group"]).withColumns({"row": F.monotonically_increasing_id(), **_vector()})
    stats = scratch.store(stats.withColumn("base_failed", base_failed()), "statistics")
    counts = stats.groupBy("_group").agg(
        F.count(F.lit(1)).alias("_count"), F.count_if(~F.col("base_failed")).alias("_usable")
    )
    named = lookup_join(stats, scratch.store(counts, "counts"), ["_group"], ["row"], "_count")
    pooled = F.when(F.col("_usable") >= min_group, F.col("_group")).otherwise(F.lit("*"))
    rows = scratch.store(named.withColumn("group", pooled).drop("_group", "_usable"), "vectors")

    usable = rows.where(~F.col("base_failed")).select("row", "group", *X)
    model = scratch.store(estimates(usable), "estimates")
    sizes = scratch.store(
        rows.groupBy("group").agg(F.count(F.lit(1)).alias("_count"), F.count_if(~F.col("base_failed")).alias("usable")), "sizes"
    )
    judged = _with_distance(rows, model, sizes)
    inlier = F.coalesce((F.col("usable") < min_group) | (F.col("d2") / F.col("scale") <= cutoff), F.lit(True))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & inlier).alias("kept"),
    )
