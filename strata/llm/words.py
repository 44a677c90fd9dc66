"""Words of whole Arrow text columns as 64-bit hashes, a slice of documents at a time.

Used inside tasks by the operators that count words or shingles; a slice
bounds the memory, and a document longer than a slice goes alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 18
# Longer words are hashed by blake2b: the rolling sums of words that repeat a
# pattern long enough (Thue-Morse words of 1024 bytes) are equal modulo 2**64.
LONG_WORD = 32
_SPACE = (0x20, *range(0x09, 0x0E))


def kinds(rule: str) -> np.ndarray:
    """Kind of every UTF-8 byte; a word is a run of one kind, kind 0 is skipped.

    ``visible``: all but white space is one kind. ``runs``: letters (with all
    bytes of other scripts), digits and the rest are three kinds. ``letters``:
    letters and digits are one kind, the rest is skipped.
    """
    out = np.full(256, 1, np.uint8)
    for b in range(128):
        c = chr(b)
        if b in _SPACE:
            out[b] = 0
        elif rule == "runs":
            out[b] = 1 if c.isalpha() else 2 if c.isdigit() else 3
        elif rule == "letters":
            out[b] = 1 if c.isalnum() else 0
    return out


def values(fold_case: bool) -> np.ndarray:
    """A fixed random number per byte; A-Z share those of a-z where case is folded."""
    out = np.random.default_rng(11).integers(0, 2 ** 64, 256, dtype=np.uint64)
    if fold_case:
        out[ord("A"):ord("Z") + 1] = out[ord("a"):ord("z") + 1]
    return out


def mixed(h: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit hashes (one to one)."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


_BASE = 0x9E3779B97F4A7C15
_powers = [np.empty(0, np.uint64), np.empty(0, np.uint64)]


def powers(n: int) -> list[np.ndarray]:
    """Powers of an odd number modulo 2**64 and of its inverse, ``n`` at least."""
    if len(_powers[0]) < n:
        for k, b in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(n, b, np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps)
    return _powers


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(first row, bytes, offsets)`` of consecutive documents; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    n = len(texts)
    if not n:
        return
    _, where, body = texts.buffers()
    offsets = np.frombuffer(where, np.int64)[texts.offset:texts.offset + n + 1]
    data = np.frombuffer(body, np.uint8) if body is not None else np.empty(0, np.uint8)
    first = 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        yield first, data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first]
        first = last


def words(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray,
          value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(hash of every word, word offsets of the documents)`` of one slice."""
    n = len(data)
    if not n:
        return np.empty(0, np.uint64), np.zeros(len(offsets), np.int64)
    k = kind[data]
    before, after = np.empty_like(k), np.empty_like(k)
    before[0], before[1:] = 0, k[:-1]
    after[-1], after[:-1] = 0, k[1:]
    before[offsets[:-1][offsets[:-1] < n]] = 0      # a word ends with its document
    after[offsets[1:][offsets[1:] > 0] - 1] = 0
    at = np.flatnonzero((k != 0) & (k != before))
    ends = np.flatnonzero((k != 0) & (k != after)) + 1
    up, down = powers(n)
    sums = np.empty(n + 1, np.uint64)
    sums[0] = 0
    np.cumsum(value[data] * up[:n], out=sums[1:])
    hashes = (sums[ends] - sums[at]) * down[at]
    long = np.flatnonzero(ends - at > LONG_WORD)
    if len(long):
        folds = value[ord("A")] == value[ord("a")]
        whole = (data[a:b].tobytes() for a, b in zip(at[long].tolist(), ends[long].tolist()))
        hashes[long] = [int.from_bytes(blake2b(w.lower() if folds else w, digest_size=8).digest(), "little")
                        for w in whole]
    return mixed(hashes), np.searchsorted(at, offsets)


def shingle_sets(hashes: np.ndarray, offsets: np.ndarray, words_: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each document; fewer words than a shingle: one shingle."""
    n = len(hashes)
    rolled = hashes[:max(0, n - words_ + 1)].copy()
    for k in range(1, words_):
        rolled = mixed(rolled * np.uint64(_BASE) + hashes[k:k + len(rolled)])
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        if b - a >= words_:
            yield np.unique(rolled[a:b - words_ + 1])
        elif b > a:
            h = np.uint64(b - a)
            with np.errstate(over="ignore"):
                for x in hashes[a:b]:
                    h = h * np.uint64(_BASE) + x
            yield mixed(np.array([h], np.uint64))
        else:
            yield np.empty(0, np.uint64)
