"""URL rules in a sorted digest array that is memory-mapped by the tasks.

The index file holds the 64-bit xxhash keys of all rules in sorted order, and
behind them the rules' full strings. It is written once to the shared folder,
handed to the executors by Spark, and memory-mapped there, so all tasks of a
machine share one copy. A URL's candidates are its host and all parent
domains that are no longer than a rule's, each with the path prefixes of the
lengths that rules have. No more of a URL than that reaches the probes. They are
probed together by vectorised binary search; every hit is confirmed on the
stored string, so a collision of keys decides nothing.

Nulls and edges: a NULL url, or one without ``://``, has an empty host and
path, and no rule fits. Repeated rows are judged each for itself. An empty
table or an empty rule list gives rows without rules. Other columns of the
input are ignored. Where no rule fits, the verdict is ``default``.
"""

from __future__ import annotations

import mmap
import struct
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tatemono.sources import scratch

ALLOW, BLOCK = "allow", "block"
MOST_BYTES = 1 << 30  # of an index file; a rule list is an input of bounded size


@dataclass(frozen=True)
class UrlRule:
    verdict: str
    host: str  # the rule fits this host and all its subdomains
    path: str  # and paths that start like this

    @property
    def text(self) -> str:
        return self.host + self.path


# The rules of the registered query.
RULES = (
    UrlRule(ALLOW, "org", "/"),
    UrlRule(BLOCK, "example.org", "/es/"),
    UrlRule(BLOCK, "example.org", "/en/1"),
    UrlRule(ALLOW, "com", "/fr/"),
    UrlRule(BLOCK, "com", "/de/"),
)

_HEAD = struct.Struct("<8sQQQ")  # magic, rules, path lengths, bytes of the longest host
_MAGIC = b"URLRULE2"
PROBE_BYTES = 8 << 20  # of candidates that are probed together


def _key(text: bytes) -> int:
    return xxhash.xxh64_intdigest(text)


def _stored(rule: UrlRule) -> bytes:
    """Host and path kept apart, so that ``a/b`` has one reading."""
    return rule.host.encode() + b"\0" + rule.path.encode()


def build_index(rules: Sequence[UrlRule]) -> bytes:
    """The index file; of rules with the same host and path, a block wins."""
    chosen: dict[bytes, str] = {}
    for rule in rules:
        text = _stored(rule)
        chosen[text] = BLOCK if BLOCK in (rule.verdict, chosen.get(text)) else rule.verdict
    entries = sorted((_key(text), text, verdict) for text, verdict in chosen.items())
    texts = b"".join(text for _, text, _ in entries)
    ends = np.cumsum([0, *(len(text) for _, text, _ in entries)]).astype("<u8")
    lengths = np.array(sorted({len(text.partition(b"\0")[2]) for text in chosen}), "<u8")
    parts = (
        _HEAD.pack(_MAGIC, len(entries), len(lengths), max((len(r.host.encode()) for r in rules), default=0)),
        np.array([k for k, _, _ in entries], "<u8").tobytes(),
        ends.tobytes(),
        lengths.tobytes(),
        bytes(v == BLOCK for _, _, v in entries),
        texts,
    )
    return b"".join(parts)


class RuleIndex:
    """Read access to a memory-mapped index file."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            self.map = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
        magic, rules, lengths, self.longest = _HEAD.unpack_from(self.map)
        if magic != _MAGIC:
            raise ValueError("not an index of URL rules")
        at = _HEAD.size
        self.keys = np.frombuffer(self.map, "<u8", rules, at)
        at += 8 * rules
        self.ends = np.frombuffer(self.map, "<u8", rules + 1, at)
        at += 8 * (rules + 1)
        self.lengths = np.frombuffer(self.map, "<u8", lengths, at).tolist()
        at += 8 * lengths
        self.blocks = np.frombuffer(self.map, "u1", rules, at)
        self.texts = at + rules

    def text(self, i: int) -> bytes:
        return self.map[self.texts + int(self.ends[i]) : self.texts + int(self.ends[i + 1])]

    def candidates(self, host: bytes, path: bytes) -> list[bytes]:
        """All ``host NUL path prefix`` strings a rule for the URL may have."""
        if len(host) > self.longest:
            dot = host.find(b".", len(host) - self.longest - 1)
            host = host[dot + 1 :] if dot >= 0 else b""
        if not host:
            return []
        prefixes = [path[:n] for n in self.lengths if n <= len(path)]
        found = []
        while True:
            found += [host + b"\0" + p for p in prefixes]
            dot = host.find(b".")
            if dot < 0:
                return found
            host = host[dot + 1 :]

    def judge(self, hosts: Sequence[bytes], paths: Sequence[bytes]) -> list[tuple[str, str] | None]:
        """Rule and verdict per URL; of several rules the longest, then the
        one with the longest host."""
        best: list[tuple[str, str] | None] = [None] * len(hosts)
        rank: list[tuple[int, int]] = [(-1, -1)] * len(hosts)
        texts: list[bytes] = []
        owner: list[int] = []
        held = 0
        for i, (host, path) in enumerate(zip(hosts, paths, strict=True)):
            mine = self.candidates(host, path)
            texts += mine
            owner += [i] * len(mine)
            held += sum(map(len, mine))
            if held > PROBE_BYTES:
                self._probe(texts, owner, best, rank)
                texts, owner, held = [], [], 0
        self._probe(texts, owner, best, rank)
        return best

    def _probe(self, texts: list[bytes], owner: list[int], best: list, rank: list) -> None:
        if not texts or not len(self.keys):
            return
        probes = np.fromiter(map(_key, texts), np.uint64, len(texts))
        left = np.searchsorted(self.keys, probes, "left")
        right = np.searchsorted(self.keys, probes, "right")
        for at in np.flatnonzero(right > left).tolist():
            for i in range(int(left[at]), int(right[at])):
                if self.text(i) == texts[at]:
                    host, _, path = texts[at].partition(b"\0")
                    order = (len(host) + len(path), len(host))
                    if order > rank[owner[at]]:
                        rank[owner[at]] = order
                        verdict = BLOCK if self.blocks[i] else ALLOW
                        best[owner[at]] = ((host + path).decode(), verdict)


def publish(docs: DataFrame, rules: Sequence[UrlRule]) -> str:
    """Writes the index to the shared folder and hands it to all executors;
    its file name there. Works for any file system Spark can write."""
    spark = docs.sparkSession
    data = build_index(rules)
    if len(data) > MOST_BYTES:
        raise ValueError(f"the rule list needs {len(data)} bytes, more than {MOST_BYTES}")
    jvm = spark._jvm
    # executors that join later fetch the file too, so it outlives any scope
    path = jvm.org.apache.hadoop.fs.Path(f"{scratch.lasting_path(spark, 'url-rules')}.bin")
    out = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path)
    for at in range(0, len(data), 1 << 20):
        out.write(bytearray(data[at : at + (1 << 20)]))
    out.close()
    spark.sparkContext.addFile(path.toString())
    return path.getName()


_open: dict[str, RuleIndex] = {}


def _index(name: str) -> RuleIndex:
    """Mapped once per Python worker."""
    if name not in _open:
        _open.clear()
        _open[name] = RuleIndex(SparkFiles.get(name))
    return _open[name]


def url_host(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def judge_urls(pages: DataFrame, rules: Sequence[UrlRule] = RULES, default: str = ALLOW) -> DataFrame:
    """Per row: ``page_id, host, path, rule, verdict``."""
    name = publish(pages, rules)

    @F.pandas_udf("struct<rule: string, verdict: string>")
    def judged(hosts: pd.Series, paths: pd.Series) -> pd.DataFrame:
        found = _index(name).judge([h.encode() for h in hosts], [p.encode() for p in paths])
        return pd.DataFrame([f or (None, default) for f in found], columns=["rule", "verdict"])

    parts = pages.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    # a rule sees the end of a host, with the character before, and the start of a path
    end = F.right("host", F.lit(max((len(r.host) for r in rules), default=0) + 1))
    start = F.left("path", F.lit(max((len(r.path) for r in rules), default=0)))
    parts = parts.withColumn("_judged", judged(end, start))
    return parts.select("page_id", "host", "path", "_judged.rule", "_judged.verdict")
