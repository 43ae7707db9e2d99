"""Secret scans with one combined deterministic automaton.

All rules are compiled into one automaton that reads each text's bytes once
and reports where a match of any rule ends. A second, reversed automaton of
that rule finds where the match starts, a third one how far it reaches; both
run only at matches. Matches of a rule are leftmost, longest, and do not
overlap. This holds for rules whose match that starts first also ends first,
as all rules here do.

The first three kinds are the base rules; the others add well-known key forms.

Nulls and edges: a NULL text counts as empty and has no span. Repeated rows
are scanned each for itself. Texts are scanned whole, whatever their length.
An empty table gives an empty result. Columns other than doc_id and text are
ignored by ``find_secrets`` and kept by ``redact``.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tatemono.llm.automaton import Dfa, Pattern
from tatemono.llm.text import Rows, rows_in, task


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern`` with at least ``least`` characters, counted after
    ``prefix`` where that is given. A match reaches on over ``tail``, which may
    be empty and is no part of the automata that look for matches."""

    kind: str
    pattern: Pattern
    prefix: Pattern | None = None
    least: int = 0
    tail: str = ""


_ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""

BASE = (
    Rule("assign", Pattern(_ASSIGN + "[A-Za-z0-9+/_.=-]+", True), Pattern(_ASSIGN, True), 6),
    # a run shorter than the bound holds no match, so the bound may be part of the pattern
    Rule("access", Pattern("AKIA[A-Z0-9]+"), least=20),
    # a shorter run holds no match, so here the bound may be part of the pattern
    Rule("hex", Pattern("[0-9a-f]{24,}")),
)
# Line ends may be written as escapes or have become spaces.
_GAP = r"([\x20\t\r\n]|\\[rn])+"
_HEADERS = rf"({_GAP}(Proc-Type|DEK-Info):[\x20A-Za-z0-9,-]*)*"
# A key's body up to its END line, or without one its run of base64 lines, of
# which the last may be short.
_KEY_BODY = (
    _HEADERS + r"(([A-Za-z0-9+/=\x20\t\r\n]|\\[rn])*-----END [A-Z ]*PRIVATE KEY-----"
    rf"|({_GAP}[A-Za-z0-9+/]{{16,}}={{0,2}})+((\r?\n|\\n)[A-Za-z0-9+/]{{1,15}}={{0,2}})?)?"
)
# Rules that can be inside a match at the same time multiply the states.
MORE = (
    Rule("private_key", Pattern("-----BEGIN [A-Z ]*PRIVATE KEY-----"), tail=_KEY_BODY),
    Rule("github", Pattern("gh[opsur]_[A-Za-z0-9]+"), least=40),
    Rule("slack", Pattern("xox[abprs]-[A-Za-z0-9-]+"), least=15),
)
RULES = BASE + MORE

SPANS = "array<struct<kind: string, start: int, end: int>>"


class Scanner:
    def __init__(self, rules: Sequence[Rule] = RULES):
        self.rules = tuple(rules)
        patterns = [r.pattern for r in self.rules]
        self.all = Dfa(patterns, anywhere=True)
        self.own = [Dfa([p], anywhere=True) for p in patterns]
        self.back = [Dfa([p], backwards=True) for p in patterns]
        self.ahead = [Dfa([Pattern(r.pattern.text + r.tail, r.pattern.ignore_case)]) for r in self.rules]
        self.prefix = [Dfa([r.prefix]) if r.prefix else None for r in self.rules]

    def matches(self, data: bytes) -> list[tuple[int, int, int]]:
        """``(start, rule, end)`` in bytes, by start, then by rule."""
        last = [0] * len(self.rules)  # where the rule's last match ended
        again: list[tuple[int, int] | None] = [None] * len(self.rules)
        found = []
        for end, tags in self.all.ends(data):
            for k in tags:
                if end <= last[k]:
                    continue
                if again[k] is not None:
                    # what ends here may have begun inside the last match, so
                    # the rule's own automaton follows from that match's end
                    state, at = again[k]
                    state = self.own[k].run(data, state, at, end)
                    again[k] = (state, end)
                    if state < self.own[k].accepting:
                        continue
                start = self.back[k].earliest(data, end, last[k])
                reach = self.ahead[k].longest(data, start)
                last[k], again[k] = reach, (self.own[k].start, reach)
                prefix = self.prefix[k]
                if reach - (prefix.longest(data, start) if prefix else start) >= self.rules[k].least:
                    found.append((start, k, reach))
        return sorted(found)

    def spans(self, data: bytes) -> list[tuple[int, str, int]]:
        """``(start, kind, end)`` in code points."""
        matches = self.matches(data)
        if data.isascii() or not matches:
            return [(s, self.rules[k].kind, e) for s, k, e in matches]
        points, before, at = {}, 0, 0
        for place in sorted({p for s, _, e in matches for p in (s, e)}):
            before += len(data[at:place].decode("utf-8", "replace"))
            at = place
            points[place] = before
        return [(points[s], self.rules[k].kind, points[e]) for s, k, e in matches]


@lru_cache(maxsize=4)
def scanner(rules: tuple[Rule, ...] = RULES) -> Scanner:
    """Compiled once per Python worker."""
    return Scanner(rules)


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per row: ``doc_id`` and ``spans``, an array of kind, start and end in
    code points, sorted by start and by the rules' order."""
    span = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
    schema = pa.schema([("doc_id", pa.int64()), ("spans", pa.list_(span))])

    @task
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled, rows = scanner(rules), Rows(schema)
        for batch in batches:
            for doc_id, text in rows_in(batch, "doc_id", "text"):
                spans = [{"kind": k, "start": s, "end": e} for s, k, e in compiled.spans(text or b"")]
                yield from rows.add((doc_id, spans), 40 + 60 * len(spans))
        yield from rows.flush()

    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return texts.mapInArrow(run, f"doc_id long, spans {SPANS}")


def listed(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def digest(found: DataFrame) -> DataFrame:
    """Counts of the base kinds, digest of the base spans, all spans as text."""
    of = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda s: s["kind"].isin([r.kind for r in BASE]))
    return found.select(
        "doc_id",
        *[of(r.kind).alias(f"n_{r.kind}") for r in BASE],
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )


def _redacted(text: str, found: list[tuple[int, str, int]]) -> str:
    parts, at = [], 0
    for start, kind, end in found:
        if start >= at:
            parts += [text[at:start], f"[{kind}]"]
        at = max(at, end)  # overlapping spans become one mark
    return "".join([*parts, text[at:]])


def _cleaned(rules: tuple[Rule, ...]):
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        compiled = scanner(rules)
        for texts in batches:
            found = []
            for (text,) in rows_in(pa.record_batch([texts], ["text"]), "text"):
                spans = compiled.spans(text) if text else []
                found.append(_redacted(text.decode("utf-8", "replace"), spans).encode() if spans else text)
            yield pa.array(found, pa.binary()).cast(pa.string())

    return run


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """All rows and columns of ``docs``; in the texts every span is replaced
    by its kind in brackets, and ``n_chars``, if there, follows. A text
    without a secret stays as it is."""

    @F.arrow_udf("string")
    def clean(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from task(_cleaned(rules))(texts)

    out = docs.withColumn("text", clean(F.col("text")))
    if "n_chars" in docs.columns:
        same = F.length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(F.col("text").isNotNull(), same).otherwise(F.col("n_chars")))
    return out.select(*[f"`{c}`" for c in docs.columns])
