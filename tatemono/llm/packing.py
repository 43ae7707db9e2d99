"""Packing tokenized documents into sequences by bounded-space online best fit.

A document's token ids, followed by an end id, are one piece, or several where
they are longer than a sequence. Pieces are packed as they come, task by task:
each goes to the open sequence with the least free space that still holds it.
The free spaces of the open sequences form a bitset, so that sequence is the
lowest set bit from the piece's length on. Only a fixed number of sequences
stays open; beyond it the fullest one is closed. A task needs memory for its
open sequences only, and a sequence never spans tasks. So that few sequences
are left open, partitions of little text are first brought together, whole
rows and no shuffle.

Nulls and edges: a NULL text counts as empty, and an empty text is the end id
alone. Repeated rows are packed each for itself. An empty table gives an empty
result. Other columns of the input are ignored.
"""

from __future__ import annotations

import json
import os
import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tatemono.llm.text import Rows, rows_in, task

LENGTH = 2048
OPEN = 256
TASK_BYTES = 8 << 20  # of text that is worth a task, so that few sequences stay open
VOCABULARY = "word_bpe_49k.json"
END_ID = 0

_COLUMNS = "doc_id long, piece int, start long, length long, ids binary, sequence_id long, offset long"
_SEQUENCE_BITS = 40  # sequences of a task are numbered below these


_LATIN_END = "\u0250"  # letters below it are whole characters in every normal form
_DOTTED = "\u0130"  # but this one, whose lower case ends in a combining dot

# The rules of a tokenizer whose words are encoded one by one.
_WORDWISE = {
    "normalizer": r"""{"type": "Sequence", "normalizers": [{"type": "NFC"},
        {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}""",
    "pre_tokenizer": r"""{"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
         "behavior": "Removed", "invert": true},
        {"type": "ByteLevel", "add_prefix_space": false, "trim_offsets": true, "use_regex": false}]}""",
    "post_processor": "null",
}


def _byte_names() -> dict[int, str]:
    """The characters by which byte-level vocabularies name bytes: printable
    ones name themselves, the others get the characters from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


_BYTE_NAMES = _byte_names()


class OpenBins:
    """Online best fit with at most ``most`` open bins of one capacity."""

    def __init__(self, capacity: int, most: int):
        self.capacity, self.most = capacity, most
        self.free = 0  # bit f is set if an open bin has f free places
        self.bins: dict[int, list[int]] = defaultdict(list)
        self.count = self.opened = 0

    def place(self, length: int) -> tuple[int, int]:
        """Bin number and offset for a piece."""
        fits = self.free >> length << length
        if fits:
            space = (fits & -fits).bit_length() - 1
            number = self._take(space)
        else:
            space, number = self.capacity, self.opened
            self.opened += 1
        if space > length:
            self.bins[space - length].append(number)
            self.free |= 1 << (space - length)
            self.count += 1
            if self.count > self.most:
                self._take((self.free & -self.free).bit_length() - 1)  # the fullest closes
        return number, self.capacity - space

    def _take(self, space: int) -> int:
        numbers = self.bins[space]
        number = numbers.pop()
        if not numbers:
            self.free &= ~(1 << space)
        self.count -= 1
        return number


class WordIds(dict):
    """Token ids of single words, as bytes of 32-bit numbers.

    The tokenizer lower-cases, and never joins text across white space or a
    letter with a full stop or comma, so a text's ids are those of its words in
    a row. Words come again and again; each is encoded once. Beyond ``most``
    words the table becomes the old one and a new one begins; words that are
    still in use move over.
    """

    def __init__(self, tokenizer: Tokenizer, most: int = 150_000, longest: int = 64):
        self.tokenizer, self.merges = tokenizer, tokenizer.model
        self.most, self.longest = most, longest
        self.old: dict[bytes, bytes] = {}

    def __missing__(self, word: bytes) -> bytes:
        found = self.old.get(word)
        if found is None:
            found = self._encoded(word)
        if len(word) <= self.longest:
            if len(self) >= self.most:
                self.old = dict(self)
                self.clear()
            self[word] = found
        return found

    def _encoded(self, word: bytes) -> bytes:
        if word.isalpha() and word.islower():  # both of ASCII letters only
            return self._merged(word.decode("ascii"))
        text = word.decode("utf-8")
        if text.isalpha() and max(text) < _LATIN_END and _DOTTED not in text:
            # letters in lower case are one piece, which only needs its bytes named
            return self._merged(text.lower().encode().decode("latin-1").translate(_BYTE_NAMES))
        if len(text) > 1 and text[-1] in ".," and text[-2].isalpha() and text[-2] < _LATIN_END and text[-2] != _DOTTED:
            return self[word[:-1]] + self[word[-1:]]
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _merged(self, piece: str) -> bytes:
        return array("I", [token.id for token in self.merges.tokenize(piece)]).tobytes()

    def text(self, text: bytes) -> bytes:
        # special tokens are told apart by case
        lower = text if b"<|" in text else text.lower()
        return b"".join(map(self.__getitem__, lower.split()))


class TextIds:
    """Token ids of whole texts, for any tokenizer."""

    def __init__(self, tokenizer: Tokenizer):
        self.tokenizer = tokenizer

    def text(self, text: bytes) -> bytes:
        return array("I", self.tokenizer.encode(text.decode("utf-8"), add_special_tokens=False).ids).tobytes()


def ids_of(path: str) -> WordIds | TextIds:
    """Encoder for a tokenizer's file: word by word only where its rules are
    known to allow that."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    tokenizer = Tokenizer.from_file(path)
    rules = json.loads(tokenizer.to_str())
    wordwise = all(rules[part] == json.loads(known) for part, known in _WORDWISE.items())
    return WordIds(tokenizer) if wordwise else TextIds(tokenizer)


_encoders: dict[str, WordIds | TextIds] = {}


def encoder(path: str) -> WordIds | TextIds:
    """One per Python worker."""
    if path not in _encoders:
        _encoders[path] = ids_of(path)
    return _encoders[path]


def vocabulary_path(name: str = VOCABULARY) -> str:
    return public_tokenizers.path(name)


def pack(
    docs: DataFrame, length: int = LENGTH, most_open: int = OPEN, vocabulary: str | None = None, end_id: int = END_ID
) -> DataFrame:
    """Per piece: ``doc_id, piece, start, length, ids, sequence_id, offset``.

    ``ids`` are little-endian unsigned 32-bit numbers. ``start`` counts the
    document's ids before the piece; ``offset`` is the place in the sequence.
    ``vocabulary`` is the tokenizer's file, the same on all machines.
    """
    path = vocabulary or vocabulary_path()
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("piece", pa.int32()),
            ("start", pa.int64()),
            ("length", pa.int64()),
            ("ids", pa.binary()),
            ("sequence_id", pa.int64()),
            ("offset", pa.int64()),
        ]
    )
    last = np.array([end_id], "<u4").tobytes()

    @task
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, bins, rows = encoder(path), OpenBins(length, most_open), Rows(schema)
        base = TaskContext.get().partitionId() << _SEQUENCE_BITS
        for batch in batches:
            for doc_id, text in rows_in(batch, "doc_id", "text"):
                ids = encode.text(text or b"") + last
                for piece, at in enumerate(range(0, len(ids), 4 * length)):
                    part = ids[at : at + 4 * length]
                    n = len(part) // 4
                    number, offset = bins.place(n)
                    yield from rows.add((doc_id, piece, at // 4, n, part, base + number, offset), len(part) + 60)
        yield from rows.flush()

    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    size = texts.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    return texts.coalesce(max(1, -(-size // TASK_BYTES))).mapInArrow(run, _COLUMNS)


def with_checksum(pieces: DataFrame) -> DataFrame:
    """The checksum of each piece's ids in place of the ids."""
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def checksum(ids: list[int]) -> int:
    """The same checksum of a list of ids."""
    return zlib.crc32(np.array(ids, "<u4").tobytes())
