"""The Jaccard join against brute force."""

import random

import numpy as np
import pytest

from tatemono.llm import jaccard_join as join
from tatemono.llm.shingles import shingle_set

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
NOTHING = join.Costs(np.empty(0, np.uint64), np.empty(0))


def plain_set(text):
    words = (text or "").translate(LOWER).encode().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def plain(rows, percent=80):
    """Per id its set size and the smallest id reachable; one text per id."""
    sets = {i: plain_set(t) for i, t in rows}
    component = {i: i for i in sets}

    def root(i):
        while component[i] != i:
            i = component[i]
        return i

    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= percent * (len(sets[a]) + len(sets[b]) - shared):
                low, high = sorted((root(a), root(b)))
                component[high] = low
    return {i: (len(sets[i]), root(i)) for i in ids}


def family(rng, size, copies, word, edits):
    base = [word() for _ in range(size)]
    for _ in range(copies):
        text = list(base)
        for _ in range(rng.randrange(0, edits + 1)):
            text[rng.randrange(size)] = word()
        yield " ".join(text)


def corpus(seed):
    """Families round the threshold, and texts that share a common passage."""
    rng = random.Random(seed)
    word = lambda: "w%d" % rng.randrange(8000)
    texts = []
    for size, copies, edits in ((30, 25, 2), (200, 20, 8), (9, 12, 1), (5, 6, 1), (3, 5, 1), (900, 6, 30)):
        texts += family(rng, size, copies, word, edits)
    passage = " ".join(word() for _ in range(40))
    for extra in (2, 3, 5, 9, 14, 30):
        texts += [f"{passage} {' '.join(word() for _ in range(extra))}" for _ in range(12)]
    texts += ["", "  ", "One", "one", "a b c d e", "A B C D E", "é é", "x " * 3000]
    rng.shuffle(texts)
    return list(enumerate(texts))


def result(spark, rows, percent=80):
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = join.jaccard_components(table, percent).collect()
    assert len(found) == len(rows)
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found}


@pytest.mark.parametrize("percent", [80, 60, 95])
def test_components_equal_brute_force(spark, percent):
    rows = corpus(percent)
    assert result(spark, rows, percent) == plain(rows, percent)


def test_common_keys_in_slots_and_nothing_broadcast(spark, monkeypatch, never_broadcast):
    monkeypatch.setattr(join, "SLOT_KEYS", 3)
    monkeypatch.setattr(join, "COMMON", 2)
    rows = corpus(4)
    assert result(spark, rows) == plain(rows)


def random_pair(rng, size, differences):
    tokens = rng.integers(0, 1 << 63, size + differences, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    left = rng.integers(0, 2, differences).astype(bool)
    common, rest = tokens[:size], tokens[size:]
    return np.sort(np.concatenate([common, rest[left]])), np.sort(np.concatenate([common, rest[~left]]))


@pytest.mark.parametrize("seed", range(4))
def test_any_costs_find_every_linked_pair(seed):
    """Whatever the costs, a linked pair meets: one probes where the other is indexed."""
    rng, partition = np.random.default_rng(seed), join.Partition(80)
    for size in [*range(1, 40), 63, 80, 100, 127, 300, 1001]:
        for differences in {0, 1, size // 9, size // 5, size // 4}:
            a, b = random_pair(rng, size, differences)
            if 100 * size < 80 * (size + differences) or not len(a) or not len(b):
                continue
            every = np.concatenate([join.signatures(s, partition, NOTHING) for s in (a, b)]) & ~np.uint64(3)
            some = np.unique(every)
            costs = join.Costs(some, rng.integers(1, 1000, len(some)))
            keys = [join.signatures(s, partition, costs) for s in (a, b)]
            ids = np.repeat(np.array([5, 9]), [len(k) for k in keys])
            key, found, size_of = join.buckets(np.concatenate(keys), ids)
            assert found.tolist() == [5, 9] and size_of.tolist() == [2, 2], (size, differences)


def test_costs_steer_away_from_common_and_empty_subsets():
    rng, partition = np.random.default_rng(0), join.Partition(80)
    tokens = np.sort(rng.integers(0, 1 << 63, 210, dtype=np.uint64) * np.uint64(2))
    own = join.Subsets(tokens, partition, partition.band(len(tokens)))
    dear = own.subsets[:9]
    budgets = own.budgets(partition.differences(210, 210) + 1, join.Costs(dear, np.full(9, 1e6)))
    assert budgets.sum() == partition.differences(210, 210) + 1 and budgets.max() <= 2
    assert not budgets[:9].any()


def test_bands_reach_every_partner():
    for percent in (80, 75, 60, 95):
        partition = join.Partition(percent)
        for size in range(1, 3000):
            band = partition.band(size)
            low, high, segments, _ = partition.bands[band]
            assert low <= size <= high
            least = -(-percent * size // 100)
            below = partition.bands[band - 1] if band else (1, 0, 1, 1)
            assert least >= below[0]
            assert partition.differences(size, size) < segments
            if least <= below[1]:
                assert partition.differences(size, below[1]) < below[2]


def test_edge_rows(spark):
    """Rows without id or text, repeated ids, clashing further columns."""
    text = " ".join(f"t{i}" for i in range(30))
    rows = [(7, text, 1), (3, text, 2), (None, text, 3), (4, None, 4), (5, "", 5), (6, "alone here", 6), (6, text, 7), (8, "alone here", 8)]
    table = spark.createDataFrame(rows, "doc_id long, text string, rep long").withColumnRenamed("rep", "component_id")
    found = sorted((r["doc_id"] or -1, r["n_shingles"], r["component_id"]) for r in join.jaccard_components(table).collect())
    assert found == sorted(
        [(7, 26, 3), (3, 26, 3), (-1, 26, None), (4, 0, 4), (5, 0, 5), (6, 1, 3), (6, 26, 3), (8, 1, 3)],
    )
    assert join.jaccard_components(table.limit(0)).collect() == []


def test_sets_of_the_same_words_agree():
    assert np.array_equal(shingle_set(b"A b\tC d e f"), shingle_set(b"a B c\nd e F"))


@pytest.mark.parametrize("seed", range(3))
def test_parities_never_hide_a_link(seed):
    rng, partition = np.random.default_rng(seed), join.Partition(80)
    told = 0
    for size in [*range(1, 30), 64, 65, 120, 130, 700]:
        for differences in {0, 1, size // 9, size // 5, size // 4, size}:
            a, b = random_pair(rng, size, differences)
            rows = [(i, i, len(s).to_bytes(8, "little") + join.parities(s)) for i, s in enumerate((a, b)) if len(s)]
            if len(rows) < 2:
                continue
            found = list(join.tile_pairs(rows[:1], rows, partition))
            linked = 100 * size >= 80 * (size + differences)
            assert found == [(0, 1)] or (not found and not linked), (size, differences)
            told += not found
    assert told > 20
