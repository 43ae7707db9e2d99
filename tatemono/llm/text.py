"""Words, sizes and Arrow helpers shared by the text operators."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A word is a run of anything but blanks, tabs and line ends. ``bytes.split``
# cuts UTF-8 text at exactly the same six characters.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"


def word_count(text: Column) -> Column:
    """Number of words, 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def rows_in(batch: pa.RecordBatch, *names: str, at_once: int = 256) -> Iterator[tuple]:
    """Rows of some columns as Python values, strings as UTF-8 bytes. Few rows
    at once are turned into Python objects."""
    for at in range(0, batch.num_rows, at_once):
        part = batch.slice(at, at_once)
        columns = []
        for name in names:
            column = part.column(batch.schema.get_field_index(name))
            if pa.types.is_string(column.type):
                column = column.cast(pa.binary())
            elif pa.types.is_large_string(column.type):
                column = column.cast(pa.large_binary())
            columns.append(column.to_pylist())
        yield from zip(*columns, strict=True)


def _release_memory() -> None:
    """Gives memory that is free in this Python worker back to the machine.
    Workers outlive their tasks and serve other operators."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # another C library
        pass


def task(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A function over the batches of a task that releases memory at its end."""

    @wraps(run)
    def whole(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            _release_memory()

    return whole


class Rows:
    """Collects output rows and hands them on in batches of bounded bytes."""

    def __init__(self, schema: pa.Schema, most_bytes: int = 8 << 20, most_rows: int = 10_000):
        self.schema, self.most_bytes, self.most_rows = schema, most_bytes, most_rows
        self._rows: list[tuple] = []
        self._bytes = 0

    def add(self, row: tuple, size: int) -> Iterator[pa.RecordBatch]:
        self._rows.append(row)
        self._bytes += size
        if self._bytes >= self.most_bytes or len(self._rows) >= self.most_rows:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self._rows:
            columns = zip(*self._rows, strict=True)
            arrays = [pa.array(list(c), type=f.type) for c, f in zip(columns, self.schema, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, schema=self.schema)
        self._rows, self._bytes = [], 0
