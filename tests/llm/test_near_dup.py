"""Near duplicates and components against brute force."""

import random

import numpy as np
import pytest

from tatemono.llm import components, near_dup, shingles

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_set(text):
    words = (text or "").translate(LOWER).encode().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def plain_components(links, nodes):
    comp = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            m = min(comp[a], comp[b])
            if comp[a] != m or comp[b] != m:
                comp[a] = comp[b] = m
                changed = True
    return comp


def plain(rows):
    """One text per id."""
    sets = {i: plain_set(t) for i, t in rows}
    ids = sorted(sets)
    links = []
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            if sets[a] and sets[b]:
                m = len(sets[a] & sets[b])
                if 100 * m >= 75 * (len(sets[a]) + len(sets[b]) - m):
                    links.append((a, b))
    return {i: (len(sets[i]), c) for i, c in plain_components(links, ids).items()}


def corpus(seed=0):
    """Chains, families and copies round the threshold."""
    rng = random.Random(seed)
    word = lambda: "w%d" % rng.randrange(5000)
    rows, number = [], 0
    for size, copies in ((40, 25), (200, 20), (8, 12), (1000, 5)):
        base = [word() for _ in range(size)]
        for _ in range(copies):
            text = list(base)
            for _ in range(rng.randrange(0, max(2, size // 12))):
                text[rng.randrange(size)] = word()
            rows.append((number, rng.choice([" ", "\n", "\t "]).join(text)))
            number += 1
            if rng.random() < 0.4:
                base = text  # drifts, so that the ends of a chain are not alike
    rows += [(number + i, t) for i, t in enumerate(["", None, "one", "One", "a b c d", "A b c D", "a b c d e", "  \n", rows[0][1].upper()])]
    return rows


@pytest.mark.parametrize("seed", [0, 1])
def test_near_duplicates_against_brute_force(spark, seed):
    rows = corpus(seed)
    docs = spark.createDataFrame([(t, i, "k", 1) for i, t in rows], "text string, doc_id long, keys string, n int")
    got = near_dup.near_duplicates(docs).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == plain(rows)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_every_join_is_the_same_without_broadcasts(spark, never_broadcast, monkeypatch):
    monkeypatch.setattr(near_dup, "TILE", 3)
    monkeypatch.setattr(components, "SLICE_ROWS", 3)
    rows = corpus(2)[:40]
    docs = spark.createDataFrame([(t, i) for i, t in rows], "text string, doc_id long")
    got = near_dup.near_duplicates(docs).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == plain(rows)


def test_repeated_ids_and_missing_ids(spark):
    a, b = " ".join("a%d" % i for i in range(30)), " ".join("b%d" % i for i in range(30))
    rows = [(a, 1), (a, 2), (b, 3), (a, 4), (b, 4), (b, None), (b, None), ("c d e f g", 5), ("c d e f g", 5)]
    docs = spark.createDataFrame(rows, "text string, doc_id long")
    got = {(r["doc_id"], r["component_id"], r["kept"]) for r in near_dup.near_duplicates(docs).collect()}
    # document 4 has both texts, so it links them
    assert got == {(1, 1, True), (2, 1, False), (3, 1, False), (4, 1, False), (None, None, True), (5, 5, True)}
    kept = near_dup.drop_near_duplicates(docs)
    assert sorted((r["doc_id"] or -1, r["text"]) for r in kept.collect()) == [(-1, b), (-1, b), (1, a), (5, "c d e f g")]
    assert near_dup.near_duplicates(docs.limit(0)).count() == 0
    assert near_dup.drop_near_duplicates(docs.limit(0)).count() == 0


def test_dropping_keeps_columns_of_any_kind(spark):
    """Maps, names with dots and names that the steps use, with repeated ids."""
    text = " ".join("t%d" % i for i in range(30))
    rows = [(1, text, {"k": 2}, 5, [1], ({"a": 1},), 7, 0), (1, text, {"k": 1}, 4, [2], ({"a": 2},), 8, 1), (2, text, None, 3, None, None, 9, 2), (3, "else", {}, 2, [], ({},), 1, 3)]
    rows += [rows[0], (None, text, {"n": 1}, 1, None, None, 2, 4)]
    schema = "doc_id long, text string, m map<string,int>, `a.b` int, l array<int>, s struct<x: map<string,int>>, _number int, row int"
    docs = spark.createDataFrame(rows, schema)
    kept = near_dup.drop_near_duplicates(docs)
    assert kept.schema == docs.schema
    got = sorted((r["doc_id"] or -1, r["a.b"], r["m"], r["_number"]) for r in kept.collect())
    assert got == [(-1, 1, {"n": 1}, 2), (1, 4, {"k": 1}, 8), (3, 2, {}, 1)]


@pytest.mark.parametrize("chunk", [64, 1 << 20])
def test_hashes_follow_the_words(monkeypatch, chunk):
    monkeypatch.setattr(shingles, "CHUNK", chunk)
    rng = random.Random(9)
    words = ["w%d" % rng.randrange(30) for _ in range(400)] + ["L" * 200, "É", "日本"]
    text = "".join(w + rng.choice([" ", "\n", " \t", "\r\n"]) for w in words).encode()
    hashes = shingles.word_hashes(text)
    assert len(hashes) == len(words)
    by_word = {}
    for w, h in zip(words, hashes.tolist(), strict=True):
        assert by_word.setdefault(w.translate(LOWER), h) == h
    assert len(set(by_word.values())) == len(by_word)
    assert len(shingles.shingle_set(text)) == len(plain_set(text.decode()))


def test_signatures_estimate_similarity():
    minhash, rng = shingles.MinHash(32, 4), np.random.default_rng(0)
    values = rng.integers(0, 1 << 63, 4000, dtype=np.uint64)
    a, b = minhash.signature(np.sort(values[:3500])), minhash.signature(np.sort(values[500:]))
    assert abs((a == b).mean() - 0.75) < 0.13
    big = np.sort(values)
    assert (minhash.signature(big) == np.minimum(minhash.signature(big[:7]), minhash.signature(big[7:]))).all()


@pytest.mark.parametrize("seed", [0, 1])
def test_components_of_paths_stars_and_loops(spark, seed):
    rng = random.Random(seed)
    edges = [(i, i + 1) for i in range(60)] + [(1000, 100 + i) for i in range(40)] + [(7, 7), (5, 6), (6, 5)]
    edges += [(rng.randrange(2000, 2060), rng.randrange(2000, 2060)) for _ in range(40)]
    rng.shuffle(edges)
    nodes = {n for e in edges for n in e}
    found = components.connected_components(spark.createDataFrame(edges, "x long, y long")).collect()
    got = {n: n for n in nodes} | {r["node"]: r["component"] for r in found}
    assert got == plain_components(edges, nodes)
    assert components.connected_components(spark.createDataFrame([], "x long, y long")).count() == 0
