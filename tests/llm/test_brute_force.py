"""The classifier's score by plain loops, and the outliers' verdict by a plain
minimum covariance determinant with the same starts."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tatemono.llm import outliers, quality_mil
from tatemono.llm.passages import FEATURES, encode


def plain_score(model, bag):
    """Attention of every passage, number by number."""
    sigmoid = lambda v: 1 / (1 + math.exp(-v))
    tables = {n: getattr(model, n).astype(float).tolist() for n in model.NAMES}
    W, b, V, U, w, c, (d,) = (tables[n] for n in model.NAMES)
    hidden, logits = [], []
    for passage in bag.astype(float).tolist():
        weight = passage[-1] / (passage[-1] + model.fit_options.shrink)
        x = [
            max(-6.0, min(6.0, (v - float(m)) / float(s))) * weight
            for v, m, s in zip(passage, model.mean, model.scale, strict=True)
        ]
        h = [math.tanh(b[j] + sum(x[i] * W[i][j] for i in range(FEATURES))) for j in range(len(b))]
        gated = 0.0
        for k in range(len(w)):
            t = math.tanh(sum(h[j] * V[j][k] for j in range(len(b))))
            gated += w[k] * t * sigmoid(sum(h[j] * U[j][k] for j in range(len(b))))
        hidden.append(h)
        logits.append(gated)
    total = sum(math.exp(e) for e in logits)
    pooled = [sum(math.exp(e) / total * h[j] for e, h in zip(logits, hidden, strict=True)) for j in range(len(b))]
    return sigmoid(d + sum(cj * pj for cj, pj in zip(c, pooled, strict=True)))


def test_scores_are_those_of_plain_loops(spark):
    rng = random.Random(5)
    words = ["the", "of", "river", "stone", "BUY", "now!!!", "###", "1234", "été", "a" * 30]
    texts = [" ".join(rng.choices(words, k=n)) for n in (0, 1, 5, 63, 64, 65, 200, 700)]
    texts.append("\n".join(["same line of words"] * 40))
    model = quality_mil.AttentionMil()
    draw = np.random.default_rng(6)
    bags = [encode(t.encode()) for t in texts]
    every = np.concatenate(bags)
    model.mean, model.scale = every.mean(axis=0), every.std(axis=0) + np.float32(1e-3)
    for name in ("b", "c", "d"):
        setattr(model, name, draw.normal(0, 1, getattr(model, name).shape).astype(np.float32))
    model.w = draw.normal(0, 4, model.w.shape).astype(np.float32)  # so that attention is far from even
    docs = spark.createDataFrame(list(enumerate([*texts, None])), "doc_id int, text string")
    got = {r["doc_id"]: r["s"] for r in docs.select("doc_id", quality_mil.quality_score(F.col("text"), model).alias("s")).collect()}
    for i, bag in enumerate([*bags, encode(b"")]):
        assert got[i] == pytest.approx(plain_score(model, bag), abs=2e-4)
    assert max(got.values()) - min(got.values()) > 0.1


def plain_distance(x, centre, factor):
    return (np.linalg.solve(factor, (x - centre).T) ** 2).sum(axis=0)


def plain_cut(d2):
    """The fine step that holds three quarters, and the steps."""
    fine = np.floor(np.log(d2 + 1e-9) * outliers.FINE)
    return np.sort(fine)[math.ceil(len(fine) * outliers.SHARE) - 1], fine


def plain_factor(cov):
    return np.linalg.cholesky(cov + np.diag(np.square(outliers.FLOORS)))


def plain_step(x, model):
    cut, fine = plain_cut(plain_distance(x, *model))
    near = x[fine <= cut]
    return near.mean(axis=0), plain_factor(np.cov(near.T, bias=True))


def plain_inliers(x):
    """Which rows of a group pass the method."""
    middle = lambda v: np.sort(v, axis=0)[math.ceil(len(v) / 2) - 1]
    median = middle(x)
    spread = middle(np.abs(x - median)) * 1.4826
    log_det = lambda model: 2 * np.log(np.diag(model[1])).sum()
    ends = []
    for start in ((median, plain_factor(np.diag(spread**2))), (x.mean(axis=0), plain_factor(np.cov(x.T, bias=True)))):
        model = plain_step(x, start)
        while log_det(further := plain_step(x, model)) < log_det(model) - outliers.LEAST_FALL:
            model = further
        ends.append(model)
    best = min(ends, key=log_det)
    d2 = plain_distance(x, *best)
    scale = max(math.exp((plain_cut(d2)[0] + 1) / outliers.FINE) / outliers.SHARE_QUANTILE, 1.0)
    return d2 / scale


def test_verdicts_are_those_of_a_plain_estimate(spark):
    rng = random.Random(9)
    rows = []
    for group, (mean, size) in {("en", "web"): (5, 160), ("en", None): (7, 90), ("de", "web"): (6, 120), ("fr", "x"): (5, 12)}.items():
        for i in range(size):
            lines = [
                " ".join("".join(rng.choices("abcdefghij", k=max(1, round(rng.gauss(mean, 1.5))))) for _ in range(rng.randint(4, 40)))
                for _ in range(rng.randint(1, 8))
            ]
            if i % 17 == 0:
                lines.append(" ".join("#$%&*|"[: rng.randint(1, 6)] * 4 for _ in range(rng.randint(5, 80))))
            if i % 19 == 0:
                lines += [" ".join("".join(rng.choices("xyz", k=rng.randint(15, 40))) for _ in range(30))]
            if i % 23 == 0:
                lines += [line for n in range(rng.randint(1, 60)) for line in (f"l {n}", f"l {n}")]
            rows.append((len(rows), "\n".join(lines), *group))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    judged = {r["doc_id"]: r for r in outliers.judge_documents(docs).collect()}
    groups = {}
    for doc_id, _, lang, source in rows:
        r = judged[doc_id]
        words, chars = r["n_words"] + outliers.PRIOR_WORDS, r["word_chars"] + outliers.PRIOR_CHARS
        vector = (math.log1p(r["n_words"]), chars / words, math.sqrt(r["n_symbols"] / chars), math.log1p(r["n_dup_lines"]), r["n_repeat_words"] / words)
        assert r["base_failed"] == (r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"])
        if r["base_failed"]:
            assert not r["kept"]
        else:
            groups.setdefault((lang, source), []).append((doc_id, vector))
    rejected = 0
    for members in groups.values():
        if len(members) < outliers.MIN_GROUP:  # the pool of small groups is small itself
            assert all(judged[i]["kept"] for i, _ in members)
            continue
        for (doc_id, _), d2 in zip(members, plain_inliers(np.array([v for _, v in members])), strict=True):
            if abs(d2 / outliers.CUTOFF - 1) > 1e-6:
                assert judged[doc_id]["kept"] == (d2 <= outliers.CUTOFF), (doc_id, d2)
            rejected += d2 > outliers.CUTOFF
    assert 10 < rejected < len(rows) / 4
