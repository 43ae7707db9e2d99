"""Shingle sets and minimum hashes of texts, with numpy inside Spark tasks.

A word's hash is a polynomial over its bytes in 64-bit arithmetic, taken from
running sums over the whole text; a shingle's hash combines the hashes of its
words. Two different shingles agree with a chance of about 2**-64.
"""

from __future__ import annotations

import numpy as np
import xxhash

SHINGLE = 5
CHUNK = 1 << 20  # bytes of a long text that are hashed at once

_SEED = 20_240_501
_rng = np.random.default_rng(_SEED)


def _odd(n: int) -> np.ndarray:
    return _rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


_BYTE = _odd(256)  # a random value per byte
_ROOT = int(_odd(1)[0])  # base of the polynomial; odd, so it has an inverse
_PLACE = _odd(SHINGLE)  # factors of a shingle's words
_LENGTH = _odd(SHINGLE)  # sets short texts apart by their number of words
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def _powers(root: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.cumprod(np.concatenate([[np.uint64(1)], np.full(CHUNK, np.uint64(root))]), dtype=np.uint64)


_UP = _powers(_ROOT)
_DOWN = _powers(pow(_ROOT, -1, 1 << 64))


def _mixed(h: np.ndarray) -> np.ndarray:
    """Spreads every bit of a hash over all bits."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _chunk_hashes(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8)
    space = np.concatenate([[True], _SPACE[raw], [True]])
    edge = np.flatnonzero(space[1:] != space[:-1])
    starts, ends = edge[::2], edge[1::2]
    sums = np.concatenate([[np.uint64(0)], np.cumsum(_BYTE[raw] * _UP[: len(raw)], dtype=np.uint64)])
    value = (sums[ends] - sums[starts]) * _DOWN[starts]
    return _mixed(value ^ (ends - starts).astype(np.uint64))


def word_hashes(text: bytes) -> np.ndarray:
    """64-bit hashes of the words of a text, A-Z lower-cased. A long text is
    hashed in chunks cut between words."""
    data = text.translate(_LOWER)
    if len(data) <= CHUNK:
        return _chunk_hashes(data)
    parts, at = [], 0
    while at < len(data):
        end = min(at + CHUNK, len(data))
        if end < len(data):
            cut = max(data.rfind(c, at, end) for c in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c"))
            if cut <= at:  # a word longer than the chunk
                nexts = [i for c in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c") if (i := data.find(c, end)) >= 0]
                cut = min(nexts, default=len(data))
                word = data[at:cut].strip(b" \t\n\x0b\x0c\r")
                if word:
                    parts.append(np.array([xxhash.xxh3_64_intdigest(word)], np.uint64))
                at = cut
                continue
            end = cut
        parts.append(_chunk_hashes(data[at:end]))
        at = end
    return np.concatenate(parts) if parts else np.empty(0, np.uint64)


def shingle_set(text: bytes | None) -> np.ndarray:
    """Sorted distinct hashes of the 5-word shingles; of the whole sequence of
    a text with fewer words; empty without words."""
    words = word_hashes(text) if text else np.empty(0, np.uint64)
    n = len(words)
    if not n:
        return words
    if n < SHINGLE:
        whole = np.array([(words * _PLACE[:n]).sum(dtype=np.uint64)], np.uint64)
        return _mixed(whole ^ _LENGTH[n])
    value = words[: n - SHINGLE + 1] * _PLACE[0]
    for k in range(1, SHINGLE):
        value = value + words[k : n - SHINGLE + 1 + k] * _PLACE[k]
    return np.unique(_mixed(value))


class MinHash:
    """Minima of ``count`` functions ``(a * x + b) mod 2**64`` over a set."""

    def __init__(self, bands: int, rows: int, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.bands, self.rows = bands, rows
        n = bands * rows
        self.a = rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.b = rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2)
        self.place = rng.integers(0, 1 << 63, rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.band = rng.integers(0, 1 << 63, bands, dtype=np.uint64)

    def signature(self, values: np.ndarray) -> np.ndarray:
        best = np.full(len(self.a), np.uint64(0xFFFFFFFFFFFFFFFF))
        for at in range(0, len(values), 2048):
            part = values[at : at + 2048]
            np.minimum(best, (self.a[:, None] * part[None, :] + self.b[:, None]).min(axis=1), out=best)
        return best

    def keys(self, signature: np.ndarray) -> np.ndarray:
        """One 64-bit key per band."""
        grid = signature.reshape(self.bands, self.rows) * self.place
        return _mixed(grid.sum(axis=1, dtype=np.uint64) ^ self.band).view(np.int64)


def fingerprint(values: np.ndarray) -> bytes:
    """128-bit digest of a set."""
    return xxhash.xxh3_128_digest(values.tobytes())
