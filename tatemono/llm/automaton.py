"""Regular expressions as minimal deterministic automata over bytes.

A small syntax is enough for scanning rules: literals, ``\\xHH`` and escaped
characters, classes, groups, alternation and the repeats ``? * + {m} {m,}
{m,n}``. Patterns become a nondeterministic automaton, subset construction
makes it deterministic, partition refinement makes it minimal, and the result
is one flat transition array over classes of bytes that behave alike.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np

ALL = frozenset(range(256))


class _Parser:
    """Syntax tree of a pattern: ``("set", bytes)``, ``("cat", parts)``,
    ``("alt", parts)`` or ``("rep", part, least, most)``."""

    def __init__(self, pattern: str, ignore_case: bool):
        self.p, self.i, self.ignore_case = pattern, 0, ignore_case

    def tree(self):
        node = self._alternatives()
        if self.i != len(self.p):
            raise ValueError(f"unbalanced pattern {self.p!r} at {self.i}")
        return node

    def _peek(self) -> str:
        return self.p[self.i] if self.i < len(self.p) else ""

    def _take(self) -> str:
        self.i += 1
        return self.p[self.i - 1]

    def _alternatives(self):
        parts = [self._sequence()]
        while self._peek() == "|":
            self._take()
            parts.append(self._sequence())
        return parts[0] if len(parts) == 1 else ("alt", parts)

    def _sequence(self):
        parts = []
        while self._peek() and self._peek() not in "|)":
            parts.append(self._repeats(self._atom()))
        return ("cat", parts)

    def _repeats(self, node):
        while self._peek() and self._peek() in "?*+{":
            sign = self._take()
            if sign == "{":
                end = self.p.index("}", self.i)
                low, comma, high = self.p[self.i : end].partition(",")
                self.i = end + 1
                least, most = int(low), (int(high) if high else None) if comma else int(low)
            else:
                least, most = {"?": (0, 1), "*": (0, None), "+": (1, None)}[sign]
            node = ("rep", node, least, most)
        return node

    def _escape(self) -> int:
        sign = self._take()
        if sign == "x":
            self.i += 2
            return int(self.p[self.i - 2 : self.i], 16)
        return {"n": 10, "t": 9, "r": 13}.get(sign, ord(sign))

    def _atom(self):
        sign = self._take()
        if sign == "(":
            node = self._alternatives()
            if self._take() != ")":
                raise ValueError(f"unbalanced group in {self.p!r}")
            return node
        if sign == "[":
            return ("set", self._class())
        return ("set", self._cased({self._escape() if sign == "\\" else ord(sign)}))

    def _class(self) -> frozenset[int]:
        negated = self._peek() == "^"
        self.i += negated
        chosen: set[int] = set()
        while self._peek() != "]":
            sign = self._take()
            low = high = self._escape() if sign == "\\" else ord(sign)
            if self._peek() == "-" and self.p[self.i + 1] != "]":
                self._take()
                sign = self._take()
                high = self._escape() if sign == "\\" else ord(sign)
            chosen.update(range(low, high + 1))
        self._take()
        chosen = self._cased(chosen)
        return ALL - chosen if negated else frozenset(chosen)

    def _cased(self, chosen: set[int]) -> frozenset[int]:
        if self.ignore_case:
            chosen = {c ^ 32 if 65 <= c & ~32 <= 90 and c < 128 else c for c in chosen} | chosen
        return frozenset(chosen)


def _reversed(node):
    kind = node[0]
    if kind == "cat":
        return ("cat", [_reversed(x) for x in reversed(node[1])])
    if kind == "alt":
        return ("alt", [_reversed(x) for x in node[1]])
    if kind == "rep":
        return ("rep", _reversed(node[1]), *node[2:])
    return node


class _Nfa:
    def __init__(self):
        self.free: list[list[int]] = []  # moves without a byte
        self.moves: list[list[tuple[frozenset[int], int]]] = []

    def state(self) -> int:
        self.free.append([])
        self.moves.append([])
        return len(self.free) - 1

    def add(self, node, at: int) -> int:
        """Adds a tree that begins in state ``at``; the state it ends in."""
        kind = node[0]
        if kind == "set":
            end = self.state()
            self.moves[at].append((node[1], end))
            return end
        if kind == "cat":
            for part in node[1]:
                at = self.add(part, at)
            return at
        if kind == "alt":
            end = self.state()
            for part in node[1]:
                start = self.state()
                self.free[at].append(start)
                self.free[self.add(part, start)].append(end)
            return end
        _, part, least, most = node
        for _ in range(least):
            at = self.add(part, at)
        end = self.state()
        if most is None:
            loop = self.state()
            self.free[at].append(loop)
            self.free[self.add(part, loop)].append(loop)
            self.free[loop].append(end)
        else:
            self.free[at].append(end)
            for _ in range(most - least):
                at = self.add(part, at)
                self.free[at].append(end)
        return end

    def closure(self, states) -> frozenset[int]:
        found, todo = set(states), list(states)
        while todo:
            for nxt in self.free[todo.pop()]:
                if nxt not in found:
                    found.add(nxt)
                    todo.append(nxt)
        return frozenset(found)


@dataclass(frozen=True)
class Pattern:
    text: str
    ignore_case: bool = False

    def tree(self):
        return _Parser(self.text, self.ignore_case).tree()


class Dfa:
    """A minimal automaton of several patterns.

    ``step[state + classes[byte]]`` is the next state, where states are
    multiples of the number of classes. Accepting states come last, from
    ``accepting`` on; ``tags`` has the patterns that end there. ``dead`` is the
    state that nothing leads out of, or -1.
    """

    def __init__(self, patterns: Sequence[Pattern], anywhere: bool = False, backwards: bool = False):
        nfa = _Nfa()
        start = nfa.state()
        if anywhere:
            nfa.moves[start].append((ALL, start))
        ends: dict[int, list[int]] = {}
        for k, pattern in enumerate(patterns):
            first = nfa.state()
            nfa.free[start].append(first)
            tree = pattern.tree()
            ends.setdefault(nfa.add(_reversed(tree) if backwards else tree, first), []).append(k)
        groups = self._byte_classes(nfa)
        table, tags = self._subsets(nfa, start, ends, groups)
        self._minimise(table, tags, groups)

    @staticmethod
    def _byte_classes(nfa: _Nfa) -> np.ndarray:
        sets = {chosen for moves in nfa.moves for chosen, _ in moves}
        rows = np.array([[b in chosen for chosen in sets] for b in range(256)])
        return np.unique(rows, axis=0, return_inverse=True)[1].ravel()

    @staticmethod
    def _subsets(nfa: _Nfa, start: int, ends: dict[int, list[int]], groups: np.ndarray):
        sample = [int(np.flatnonzero(groups == g)[0]) for g in range(groups.max() + 1)]
        first = nfa.closure([start])
        names, todo, table = {first: 0}, [first], []
        while todo:
            here = todo.pop(0)
            moves = [m for s in here for m in nfa.moves[s]]
            row = []
            for byte in sample:
                there = nfa.closure({to for chosen, to in moves if byte in chosen})
                if there not in names:
                    names[there] = len(names)
                    todo.append(there)
                row.append(names[there])
            table.append(row)
        tags = [tuple(sorted(k for s in states for k in ends.get(s, ()))) for states in names]
        return np.array(table), tags

    def _minimise(self, table: np.ndarray, tags: list[tuple[int, ...]], groups: np.ndarray) -> None:
        kinds = {t: i for i, t in enumerate(sorted(set(tags)))}
        block = np.array([kinds[t] for t in tags])
        while True:
            rows = np.column_stack([block, block[table]])
            finer = np.unique(rows, axis=0, return_inverse=True)[1].ravel()
            if finer.max() == block.max():
                break
            block = finer
        n = block.max() + 1
        one = np.array([int(np.flatnonzero(block == b)[0]) for b in range(n)])
        order = sorted(range(n), key=lambda b: (bool(tags[one[b]]), b))  # accepting states last
        place = np.empty(n, int)
        place[order] = np.arange(n)
        small = place[block[table[one[order]]]]
        small, same = np.unique(small, axis=1, return_inverse=True)  # bytes that no state tells apart
        width = small.shape[1]
        self.classes = bytes(same.ravel()[groups].astype(np.uint8))
        self.step = (small * width).ravel().tolist()
        self.start = int(place[block[0]]) * width
        plain = sum(not tags[one[b]] for b in range(n))
        self.accepting = plain * width
        self.tags = {i * width: tags[one[b]] for i, b in enumerate(order) if tags[one[b]]}
        stuck = [i for i in range(plain) if (small[i] == i).all()]
        self.dead = stuck[0] * width if stuck else -1

    def ends(self, data: bytes) -> Iterator[tuple[int, tuple[int, ...]]]:
        """``(end, patterns)`` at every position where patterns end."""
        step, state, accepting, tags = self.step, self.start, self.accepting, self.tags
        for at, c in enumerate(data.translate(self.classes), 1):
            state = step[state + c]
            if state >= accepting:
                yield at, tags[state]

    def run(self, data: bytes, state: int, begin: int, end: int) -> int:
        """The state after the bytes from ``begin`` to ``end``."""
        step, classes = self.step, self.classes
        for at in range(begin, end):
            state = step[state + classes[data[at]]]
        return state

    def longest(self, data: bytes, begin: int) -> int:
        """End of the longest match that begins there, or -1."""
        step, classes, state = self.step, self.classes, self.start
        found = begin if state >= self.accepting else -1
        for at in range(begin, len(data)):
            state = step[state + classes[data[at]]]
            if state == self.dead:
                break
            if state >= self.accepting:
                found = at + 1
        return found

    def earliest(self, data: bytes, end: int, least: int) -> int:
        """For an automaton of reversed patterns: the smallest start, from
        ``least`` on, of a match that ends there, or -1."""
        step, classes, state, found = self.step, self.classes, self.start, -1
        for at in range(end - 1, least - 1, -1):
            state = step[state + classes[data[at]]]
            if state == self.dead:
                break
            if state >= self.accepting:
                found = at
        return found
