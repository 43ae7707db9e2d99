"""Passages of a text and their features, with numpy inside Spark tasks.

A passage is a run of 64 words. Its features are frequencies of byte pairs
(hashed), of kinds of characters, and of repeated words. They need neither a
vocabulary nor the language.
"""

from __future__ import annotations

import numpy as np

from tatemono.llm.shingles import CHUNK, _SPACE, word_hashes

WORDS = 64
PAIRS = 128

# kinds of bytes; what is in none of them is "other"
_KINDS = (
    b"abcdefghijklmnopqrstuvwxyz",
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    b"0123456789",
    b".",
    b",",
    b"!?",
    b"|",
    b"#*$%&<>",
    b"\"'()[]{}",
    b"@:/",
    b"-_=+;",
    bytes(range(128, 256)),
    b" ",
    b"\n",
)
_KIND = np.full(256, len(_KINDS), np.int64)
for _i, _chars in enumerate(_KINDS):
    _KIND[list(_chars)] = _i
_N_KINDS = len(_KINDS) + 1
_PAIR = (np.random.default_rng(5).integers(0, PAIRS, 1 << 16)).astype(np.int64)

FEATURES = PAIRS + _N_KINDS + 6


def _chunks(text: bytes):
    """Parts of a long text, cut at white space where there is any."""
    at = 0
    while at < len(text):
        end = min(at + CHUNK, len(text))
        if end < len(text):
            cut = max(text.rfind(c, at, end) for c in (b" ", b"\n"))
            end = cut if cut > at else end
        yield text[at:end]
        at = end


def _part_features(text: bytes) -> np.ndarray:
    raw = np.frombuffer(text, np.uint8)
    space = _SPACE[raw]
    starts = ~space & np.concatenate([[True], space[:-1]])
    n_words = int(starts.sum())
    if not n_words:
        return np.empty((0, FEATURES), np.float32)
    passage = np.maximum(np.cumsum(starts) - 1, 0) // WORDS
    n = int(passage[-1]) + 1
    size = np.bincount(passage, minlength=n).astype(np.float64)
    kinds = np.bincount(passage * _N_KINDS + _KIND[raw], minlength=n * _N_KINDS).reshape(n, _N_KINDS) / size[:, None]
    pair = _PAIR[(raw[:-1].astype(np.int64) << 8) | raw[1:]]
    pairs = np.bincount(passage[1:] * PAIRS + pair, minlength=n * PAIRS).reshape(n, PAIRS) / size[:, None]

    words = word_hashes(text)
    of = np.arange(len(words)) // WORDS
    count = np.bincount(of, minlength=n).astype(np.float64)
    same = np.zeros(len(words))
    same[1:] = (words[1:] == words[:-1]) & (of[1:] == of[:-1])
    order = np.lexsort((words, of))
    new = np.ones(len(words))
    new[1:] = (words[order][1:] != words[order][:-1]) | (of[order][1:] != of[order][:-1])
    distinct = np.bincount(of[order], weights=new, minlength=n) / count
    repeated = np.bincount(of, weights=same, minlength=n) / count
    letters = size - np.bincount(passage, weights=space, minlength=n)
    shape = np.column_stack([distinct, repeated, letters / count, np.sqrt(kinds[:, 7]), np.sqrt(kinds[:, 6]), count / WORDS])
    return np.hstack([np.sqrt(pairs), kinds, shape]).astype(np.float32)


def encode(text: bytes | None) -> np.ndarray:
    """One row of features per passage; a text without words is one passage of zeros."""
    parts = [_part_features(part) for part in _chunks(text or b"")]
    parts = [p for p in parts if len(p)]
    return np.concatenate(parts) if parts else np.zeros((1, FEATURES), np.float32)
