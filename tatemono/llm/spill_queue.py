"""A priority queue of a task that holds a bounded number of items in memory."""

from __future__ import annotations

import heapq
import pickle
import tempfile
from collections.abc import Iterator
from itertools import chain

MOST_ITEMS = 200_000
_AT_ONCE = 1024  # items of a spilled run that are read together


class SpillingQueue:
    """Smallest item first. Beyond ``most`` items the heap is written as a
    sorted run to an unnamed temporary file, which is private to the task like
    Spark's own spills and vanishes with it. Of each run only a few items are
    in memory; once there are many runs, they are merged into one."""

    def __init__(self, most: int = MOST_ITEMS, most_runs: int = 64):
        self.most, self.most_runs = most, most_runs
        self._heap: list[tuple] = []
        self._heads: list[tuple] = []  # the next item of each run, with the run's number
        self._runs: dict[int, Iterator[tuple]] = {}
        self._made = 0

    def __bool__(self) -> bool:
        return bool(self._heap or self._heads)

    def push(self, item: tuple) -> None:
        heapq.heappush(self._heap, item)
        if len(self._heap) > self.most:
            self._heap.sort()
            self._add_run(iter(self._heap))
            self._heap = []
            if len(self._runs) > self.most_runs:
                merged = heapq.merge(*(chain([head], self._runs[number]) for head, number in self._heads))
                self._heads, self._runs = [], {}
                self._add_run(merged)

    def _add_run(self, items: Iterator[tuple]) -> None:
        number, self._made = self._made, self._made + 1
        run = _written(items)
        self._runs[number] = run
        self._advance(number)

    def _advance(self, number: int) -> None:
        item = next(self._runs[number], None)
        if item is None:
            del self._runs[number]
        else:
            heapq.heappush(self._heads, (item, number))

    def peek(self) -> tuple:
        if not self._heads or (self._heap and self._heap[0] <= self._heads[0][0]):
            return self._heap[0]
        return self._heads[0][0]

    def pop(self) -> tuple:
        if not self._heads or (self._heap and self._heap[0] <= self._heads[0][0]):
            return heapq.heappop(self._heap)
        item, number = heapq.heappop(self._heads)
        self._advance(number)
        return item


def _written(items: Iterator[tuple]) -> Iterator[tuple]:
    """Items from a temporary file, written at once."""
    file = tempfile.TemporaryFile()
    block: list[tuple] = []
    for item in items:
        block.append(item)
        if len(block) == _AT_ONCE:
            pickle.dump(block, file)
            block = []
    if block:
        pickle.dump(block, file)
    file.seek(0)

    def read() -> Iterator[tuple]:
        with file:
            while True:
                try:
                    yield from pickle.load(file)
                except EOFError:
                    return

    return read()
