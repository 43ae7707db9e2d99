"""The prefix trie against plain dictionaries."""

import hashlib
import random
import zlib

import pyarrow as pa
import pytest

from tatemono.llm import prefix_trie
from tatemono.llm.spill_queue import SpillingQueue

SCHEMA = "conv_id long, turn long, role string, text string, node string, depth int"
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def plain(rows):
    """Sorted result rows of the definition."""
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    members = {}
    paths = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -((-c) % 5))
        paths[c] = tuple(own.get(base, [])[:h] + turns[h:])
        for d in range(len(paths[c]) + 1):
            members.setdefault(paths[c][:d], []).append(c)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = children.get(node, [])
        leaves[node] = sum(leaves[b] for b in below) or 1
        size = len(node[-1][1].encode()) if node else 0
        saved[node] = sum(saved[b] for b in below) + (len(members[node]) - 1) * size
    out = []
    for node, convs in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in convs if paths[c] == node))
        parent = min(members[node[:-1]]) if node else None
        out.append((min(convs), len(node), parent, len(convs), len(children.get(node, [])), leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def got(spark, rows, **settings):
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(3)
    return sorted((tuple(r[c] for c in COLUMNS) for r in prefix_trie.trie(table, **settings).collect()), key=str)


def conversations(seed, n=60):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-20, 4 * n), n):
        length = rng.choice([1, 2, 3, 5, 9, 12])
        same = rng.random() < 0.4
        for turn in range(length):
            text = f"é {turn}" if same else f"text {rng.randrange(3)}"
            rows.append((c, turn if rng.random() < 0.95 else None, rng.choice(["user", "user", None]) if not same else "user", text))
    # copies of one conversation, a long one, equal rows, nothing in texts
    for c in range(1000, 1060):
        rows += [(c, t, "user", f"copy {t}") for t in range(10)]
    rows += [(2000, t, "assistant", "" if t % 2 else None) for t in range(150)]
    rows += [(2001, 0, "u", "twice")] * 14 + [(None, 0, "user", "no conversation")]
    return rows


@pytest.mark.parametrize("seed", [0, 1])
def test_equals_plain_dictionaries(spark, seed):
    rows = conversations(seed)
    assert got(spark, rows) == plain(rows)


def test_small_shards_small_pieces_nothing_broadcast(spark, monkeypatch, never_broadcast):
    monkeypatch.setattr(prefix_trie, "PIECE_BYTES", 9)
    monkeypatch.setattr(prefix_trie, "SLICE_ROWS", 4)
    rows = conversations(2)
    expected = plain(rows)
    assert got(spark, rows, least_load=1) == expected
    assert got(spark, rows, least_load=10**6) == expected


def test_few_conversations(spark):
    assert got(spark, [(None, 0, "user", "x")]) == []
    for rows in ([(3, 0, "user", "x")], [(5, 0, "a", "b:c"), (5, 1, "a:b", "c")], [(10, None, None, None), (11, None, None, None)]):
        assert got(spark, rows) == plain(rows)


def test_role_and_text_are_kept_apart(spark):
    rows = [(c, t, r, x) for c, r, x in ((0, "ab", "c"), (100, "a", "bc"), (200, "", "abc")) for t in range(12)]
    assert got(spark, rows) == plain(rows)


def test_queue_spills_and_merges():
    rng = random.Random(0)
    queue, expected = SpillingQueue(most=7, most_runs=3), []
    for step in range(3000):
        if expected and rng.random() < 0.4:
            expected.sort()
            assert queue.peek() == expected[0]
            assert queue.pop() == expected.pop(0)
        else:
            item = (rng.randrange(500), step)
            queue.push(item)
            expected.append(item)
    assert [queue.pop() for _ in range(len(expected))] == sorted(expected)
    assert not queue


def test_messages_wait_in_a_spilling_queue():
    """A wide shard: 500 leaves of a root, with room for three messages."""
    names = ["shard", "depth", "node", "parent", "n_convs", "ends", "bytes", "c_children", "c_leaves", "c_saved", "c_convs"]
    leaves = [("r", 1, f"n{i:03}", "r", 2, 2, 10, 0, 0, 0, 0) for i in range(500)]
    root = ("r", 0, "r", "above", 1003, 1, 0, 0, 0, 0, 0)
    batch = pa.RecordBatch.from_pylist([dict(zip(names, row, strict=True)) for row in [*leaves, root]])
    out = [r for part in prefix_trie.time_forward(3)(iter([batch])) for r in part.to_pylist()]
    assert out[-1] == {"node": "r", "n_children": 502, "n_leaves": 502, "saved_tokens": 5000, "up": "above", "n_convs": 1003}
