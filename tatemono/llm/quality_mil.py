"""Quality scores by attention-based multiple-instance learning.

A document is a bag of passages. Every passage is encoded, a gated attention
learns from document labels how much each passage counts, and the document's
score is that of the weighted passage representation:

    h = tanh(W x + b),  a = softmax(w . (tanh(V h) * sigmoid(U h))),
    score = sigmoid(c . sum(a h) + d)

The model is fitted on the driver on a bounded sample of labelled documents
(``Fit.documents``, the first in the order of a hash of the id, without bags of
over ``Fit.passages`` passages), and scores every whole text in Arrow batches.
Inputs of a score are the text only. The features of a passage of few words
say little and are drawn towards the average.

Nulls and edges: a NULL or empty text is a bag of one passage of zeros and gets
a score too. Labels that are NULL, without id, or contradict each other for one
document are not learnt from; repeated labels count once. Without any label
every score is 0.5. Repeated documents are scored each for itself. An empty
table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tatemono.llm.passages import FEATURES, WORDS, encode
from tatemono.llm.text import Rows, rows_in, task

FOLDS, HELD_OUT = 3, 1


@dataclass(frozen=True)
class Fit:
    documents: int = 4000
    passages: int = 512
    hidden: int = 32
    gate: int = 16
    epochs: int = 12
    shrink: float = 8 / WORDS  # a passage of 8 words counts half
    batch: int = 32
    rate: float = 3e-3
    decay: float = 1e-4
    seed: int = 11


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class AttentionMil:
    """Parameters, scores and gradients of the model."""

    NAMES = ("W", "b", "V", "U", "w", "c", "d")

    def __init__(self, fit: Fit = Fit()):
        rng = np.random.default_rng(fit.seed)
        draw = lambda *shape: rng.normal(0, shape[0] ** -0.5, shape).astype(np.float32)
        self.fit_options = fit
        zeros = lambda n: np.zeros(n, np.float32)
        self.mean, self.scale = zeros(FEATURES), zeros(FEATURES) + 1
        self.W, self.b = draw(FEATURES, fit.hidden), zeros(fit.hidden)
        self.V, self.U, self.w = draw(fit.hidden, fit.gate), draw(fit.hidden, fit.gate), draw(fit.gate)
        self.c, self.d = zeros(fit.hidden), zeros(1)

    def _inputs(self, x: np.ndarray) -> np.ndarray:
        filled = x[:, -1:]  # words of the passage, as a share of a full one
        return np.clip((x - self.mean) / self.scale, -6, 6) * (filled / (filled + self.fit_options.shrink))

    def _forward(self, x: np.ndarray, starts: np.ndarray, sizes: np.ndarray):
        h = np.tanh(x @ self.W + self.b)
        t, g = np.tanh(h @ self.V), _sigmoid(h @ self.U)
        e = (t * g) @ self.w
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, starts), sizes))
        a = e / np.repeat(np.add.reduceat(e, starts), sizes)
        z = np.add.reduceat(a[:, None] * h, starts)
        return h, t, g, a, z, z @ self.c + self.d[0]

    def score(self, x: np.ndarray) -> float:
        """Score of one bag of encoded passages."""
        return float(_sigmoid(self._forward(self._inputs(x), np.array([0]), np.array([len(x)]))[-1])[0])

    def _gradients(self, x, starts, sizes, labels):
        h, t, g, a, z, logit = self._forward(x, starts, sizes)
        error = (_sigmoid(logit) - labels) / len(labels)
        out = {"c": z.T @ error, "d": np.array([error.sum()])}
        dz = np.repeat(error[:, None] * self.c, sizes, axis=0)
        da = (dz * h).sum(axis=1)
        de = a * (da - np.repeat(np.add.reduceat(a * da, starts), sizes))
        out["w"] = (t * g).T @ de
        dt = de[:, None] * self.w * g * (1 - t * t)
        dg = de[:, None] * self.w * t * g * (1 - g)
        out["V"], out["U"] = h.T @ dt, h.T @ dg
        dh = (dz * a[:, None] + dt @ self.V.T + dg @ self.U.T) * (1 - h * h)
        out["W"], out["b"] = x.T @ dh, dh.sum(axis=0)
        return out

    def fit(self, bags: list[np.ndarray], labels: np.ndarray) -> AttentionMil:
        """Adam over mini-batches of bags; the same for the same sample."""
        if not len(bags):
            return self
        fit, rng = self.fit_options, np.random.default_rng(self.fit_options.seed)
        every = np.concatenate(bags)
        self.mean = every.mean(axis=0, dtype=np.float64).astype(np.float32)
        self.scale = (every.std(axis=0, dtype=np.float64) + 1e-3).astype(np.float32)
        del every
        first = {n: np.zeros_like(getattr(self, n)) for n in self.NAMES}
        second = {n: np.zeros_like(getattr(self, n)) for n in self.NAMES}
        step = 0
        for epoch in range(fit.epochs):
            rate = fit.rate * (1 - epoch / fit.epochs)
            order = rng.permutation(len(bags))
            for at in range(0, len(order), fit.batch):
                chosen = order[at : at + fit.batch]
                sizes = np.array([len(bags[i]) for i in chosen])
                starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
                x = self._inputs(np.concatenate([bags[i] for i in chosen]))
                step += 1
                for n, slope in self._gradients(x, starts, sizes, labels[chosen]).items():
                    value = getattr(self, n)
                    slope = slope + fit.decay * value
                    first[n] = 0.9 * first[n] + 0.1 * slope
                    second[n] = 0.999 * second[n] + 0.001 * slope * slope
                    move = first[n] / (1 - 0.9**step) / (np.sqrt(second[n] / (1 - 0.999**step)) + 1e-8)
                    setattr(self, n, value - rate * move)
        return self


def fold(doc_id: Column) -> Column:
    """Remainder of the checksum of the id as text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS


def training_ids(labels: DataFrame, fit: Fit = Fit()) -> DataFrame:
    """``doc_id, label`` of the documents to learn from, at most ``fit.documents``."""
    usable = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
    usable = usable.where(fold(F.col("doc_id")) != HELD_OUT)
    agreed = usable.groupBy("doc_id").agg(F.min("quality").alias("label"), F.max("quality").alias("other"))
    agreed = agreed.where(F.col("label") == F.col("other")).select(F.col("doc_id").cast("long"), "label")
    mixed = F.xxhash64(F.lit(fit.seed), F.col("doc_id"))
    return agreed.orderBy(mixed, "doc_id").limit(fit.documents)


def train(docs: DataFrame, labels: DataFrame, fit: Fit = Fit()) -> AttentionMil:
    """The model of a bounded sample of labelled documents."""
    rows_of = pa.schema([("doc_id", pa.int64()), ("passages", pa.binary())])

    @task
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = Rows(rows_of)
        for batch in batches:
            for doc_id, text in rows_in(batch, "doc_id", "text"):
                bag = encode(text)
                if len(bag) <= fit.passages:
                    yield from rows.add((doc_id, bag.astype(np.float16).tobytes()), bag.nbytes)
        yield from rows.flush()

    chosen = {r["doc_id"]: r["label"] for r in training_ids(labels, fit).collect()}  # at most fit.documents
    if not chosen:
        return AttentionMil(fit)
    spark = docs.sparkSession
    ids = spark.createDataFrame([(i,) for i in chosen], "doc_id long")
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    # one text per id, the smallest, so that repeated rows do not swell the sample
    texts = texts.join(F.broadcast(ids), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"))
    found = texts.mapInArrow(run, "doc_id long, passages binary").toArrow().to_pydict()
    order = np.argsort(np.array(found["doc_id"], np.int64))
    bags = [np.frombuffer(found["passages"][i], np.float16).reshape(-1, FEATURES).astype(np.float32) for i in order]
    return AttentionMil(fit).fit(bags, np.array([chosen[found["doc_id"][i]] for i in order], np.float32))


def _scores(model: AttentionMil):
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            batch = pa.record_batch([texts], ["text"])
            yield pa.array([model.score(encode(text)) for (text,) in rows_in(batch, "text")], pa.float64())

    return run


def quality_score(text: Column, model: AttentionMil) -> Column:
    """Score of every whole text, from 0 to 1."""

    @F.arrow_udf("double")
    def scored(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from task(_scores(model))(texts)

    return scored(text)


def score_documents(docs: DataFrame, labels: DataFrame, fit: Fit = Fit()) -> DataFrame:
    """Per row: ``doc_id, held_out, score, predicted``."""
    model = train(docs, labels, fit)
    rows = docs.select("doc_id", quality_score(F.col("text").cast("string"), model).alias("score"))
    return rows.select(
        "doc_id",
        (fold(F.col("doc_id")) == HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, fit: Fit = Fit()) -> DataFrame:
    """Rows of ``docs`` that the classifier does not reject, all columns."""
    model = train(docs, labels, fit)
    return docs.where(quality_score(F.col("text").cast("string"), model) >= 0.5)
