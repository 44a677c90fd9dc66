"""Packing documents into training sequences (operator 2).

Documents become token ids with the public tokenizer named by a path, ended
by one end id. A document longer than a sequence is cut into full sequences;
what is left of every document is a piece below the capacity. Pieces meet in
groups of bounded size, and each group is divided into windows by
Karmarkar-Karp multiway differencing: partial partitions are merged largest
against smallest, so their imbalances cancel and the windows come out near
equal. It starts with as many windows as the tokens need; the count rises
while any window exceeds the capacity.

Defined results: null text is empty and holds the end id alone; repeated rows
and ids are separate documents; an empty table gives an empty result. Other
columns are ignored. Each id lies in exactly one piece.
"""

from __future__ import annotations

import heapq
import os
import re
import unicodedata
import zlib
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import in_batches, saved
from strata.llm.words import LONG_WORD

CAPACITY = 2048
END_ID = 1
GROUP = 4096            # pieces in a packing group, about
GRAIN = 512             # a rest is cut into pieces of at most this many ids
CACHE_WORDS = 1_000_000  # distinct words a worker remembers before it starts afresh
_CHARS = 1 << 18        # characters split at a time; a longer document goes alone

PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"


class WordTokens:
    """Ids of whole texts through a cache of words.

    The vocabulary splits a text into words before merging, so a word's ids
    do not depend on its neighbours. Texts of characters below U+0180 (but
    U+0130), where normalisation keeps every character in place, are split
    here in one pass over their code points by the vocabulary's own rule, and
    each distinct word (a 64-bit hash of its code points) goes through the
    tokenizer once. Any other text, and any that may hold a special token,
    goes through the tokenizer whole. Both ways give the tokenizer's ids.
    """

    # The split pattern of the vocabulary file takes, in this
    # order, the endings 's 't 're 've 'm 'll 'd, a run of letters, one number
    # character, a run of anything else that is visible.
    ENDINGS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")
    SPACE, LETTER, NUMBER, OTHER = 0, 1, 2, 3
    TOP = 0x180

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")   # a task has one core
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.plain = re.compile("[\u0000-\u012f\u0131-\u017f]*").fullmatch
        kinds = []
        for c in map(chr, range(self.TOP)):
            group = unicodedata.category(c)[0]
            kinds.append(self.SPACE if c.isspace() and not "\x1c" <= c <= "\x1f" else
                         self.LETTER if group == "L" else
                         self.NUMBER if group == "N" else self.OTHER)
        self.kind = np.array(kinds, np.uint8)
        vocabulary = self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)      # ids that end a word
        self.last[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        rng = np.random.default_rng(20)
        self.value = rng.integers(0, 2 ** 64, self.TOP, dtype=np.uint64)
        self._clear()

    def _clear(self) -> None:
        self.hashes = np.empty(0, np.uint64)      # sorted
        self.starts = np.empty(0, np.int64)
        self.lengths = np.empty(0, np.int64)
        self.pool = np.empty(0, np.uint32)

    def _words(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the words of a lower-case text."""
        kind = self.kind[codes]
        before = np.empty_like(kind)
        before[0], before[1:] = self.SPACE, kind[:-1]
        starts = (kind != self.SPACE) & ((kind != before) | (kind == self.NUMBER))
        marks = np.flatnonzero(starts & (codes == ord("'")))
        if len(marks):
            padded = np.concatenate([codes, np.zeros(3, codes.dtype)])
            for e in self.ENDINGS:
                hit = marks
                for i, c in enumerate(e[1:], 1):
                    hit = hit[padded[hit + i] == ord(c)]
                starts[hit + 1] = False
                after = hit + len(e)
                after = after[after < len(codes)]
                starts[after] |= kind[after] == self.LETTER
        at = np.flatnonzero(starts)
        # a word ends where the next begins or at the next white space
        edge = np.flatnonzero(starts | ((kind == self.SPACE) & (before != self.SPACE)))
        ends = np.append(edge, len(codes))[np.searchsorted(edge, at) + 1]
        return at, ends

    def _learn(self, text: str, hashes: np.ndarray, at: np.ndarray, ends: np.ndarray) -> None:
        if len(self.hashes) + len(hashes) > CACHE_WORDS:
            self._clear()
        words = [text[a:b] for a, b in zip(at.tolist(), ends.tolist())]
        parts = [words[i:i + 1024] for i in range(0, len(words), 1024)]
        found = self.tokenizer.encode_batch_fast([" ".join(p) for p in parts],
                                                 add_special_tokens=False)
        ids = np.concatenate([np.array(e.ids, np.uint32) for e in found])
        n = np.diff(np.flatnonzero(self.last[ids]), prepend=-1)
        first = len(self.pool) + np.cumsum(n) - n
        spot = np.searchsorted(self.hashes, hashes)
        self.hashes = np.insert(self.hashes, spot, hashes)
        self.starts = np.insert(self.starts, spot, first)
        self.lengths = np.insert(self.lengths, spot, n)
        self.pool = np.concatenate([self.pool, ids])

    def _split(self, texts: list[str]) -> list[np.ndarray]:
        text = "\n".join(texts).lower() + "\n"
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        at, ends = self._words(codes)
        weights, back = _powers(len(codes))
        sums = np.empty(len(codes) + 1, np.uint64)
        sums[0] = 0
        np.cumsum(self.value[codes] * weights[:len(codes)], out=sums[1:])
        hashes = (sums[ends] - sums[at]) * back[at]
        # sums of long words that repeat a pattern may be equal modulo 2**64
        long = np.flatnonzero(ends - at > LONG_WORD)
        hashes[long] = [int.from_bytes(blake2b(text[a:b].encode(), digest_size=8).digest(), "little")
                        for a, b in zip(at[long].tolist(), ends[long].tolist())]
        one, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        spot = np.searchsorted(self.hashes, one)
        known = np.zeros(len(one), bool)
        inside = spot < len(self.hashes)
        known[inside] = self.hashes[spot[inside]] == one[inside]
        if not known.all():
            # learn these alone, or every word at hand where the cache starts afresh
            new = ~known if len(self.hashes) + (~known).sum() <= CACHE_WORDS else known | True
            self._learn(text, one[new], at[first[new]], ends[first[new]])
            spot = np.searchsorted(self.hashes, one)
        n = self.lengths[spot][which]
        stop = np.cumsum(n)
        total = int(stop[-1]) if len(stop) else 0
        ids = self.pool[np.repeat(self.starts[spot][which] - (stop - n), n) + np.arange(total)]
        # a lower-case text is as long as the text: its end is the next separator
        edge = np.searchsorted(at, np.cumsum([len(t) + 1 for t in texts]))
        return np.split(ids, np.append(0, stop)[edge][:-1])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text as uint32."""
        out: list = [None] * len(texts)
        here, size = [], 0

        def flush():
            for i, ids in zip(here, self._split([texts[i] for i in here])):
                out[i] = ids

        for i, t in enumerate(texts):
            if "<|" in t or not self.plain(t):
                out[i] = np.array(self.tokenizer.encode(t, add_special_tokens=False).ids, np.uint32)
                continue
            if here and size + len(t) > _CHARS:
                flush()
                here, size = [], 0
            here.append(i)
            size += len(t)
        if here:
            flush()
        return out


_POWERS: list[np.ndarray] = [np.empty(0, np.uint64), np.empty(0, np.uint64)]


def _powers(n: int) -> list[np.ndarray]:
    """Powers of an odd number modulo 2**64 and of its inverse, ``n`` at least."""
    if len(_POWERS[0]) < n:
        base = 0x9E3779B97F4A7C15
        for k, b in enumerate((base, pow(base, -1, 1 << 64))):
            steps = np.full(n, b, np.uint64)
            steps[0] = 1
            _POWERS[k] = np.cumprod(steps)
    return _POWERS


_WORKER: dict[str, WordTokens] = {}     # one cache per Python worker and path


def cut(ids: np.ndarray, capacity: int, grain: int) -> list[tuple[int, int, int]]:
    """``(start, length, crc32)``: full sequences first, then grains of the rest."""
    out, n, start = [], len(ids), 0
    data = ids.astype("<u4")
    while start < n:
        step = capacity if n - start >= capacity else min(grain, n - start)
        out.append((start, step, zlib.crc32(data[start:start + step].tobytes())))
        start += step
    return out


def token_pieces(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id",
                 text_col: str = "text", capacity: int = CAPACITY, grain: int = GRAIN,
                 end_id: int = END_ID) -> DataFrame:
    """``(doc_id, start, length, ids_crc32, doc_tokens)`` per piece; nothing moves.

    The tokenizer is read from its path once per Python worker.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if tokenizer_path not in _WORKER:
            _WORKER[tokenizer_path] = WordTokens(tokenizer_path)
        words = _WORKER[tokenizer_path]
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                texts = [t or "" for t in part.column(1).to_pylist()]
                cols: list[list] = [[], [], [], [], []]
                for doc, ids in zip(part.column(0).to_pylist(), words.encode(texts)):
                    ids = np.append(ids, np.uint32(end_id))
                    for start, length, crc in cut(ids, capacity, grain):
                        for col, v in zip(cols, (doc, start, length, crc, len(ids))):
                            col.append(v)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols],
                                                 ["doc_id", "start", "length", "ids_crc32",
                                                  "doc_tokens"])

    return in_batches(docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"),
                                  F.col(f"`{text_col}`").cast("string").alias("text")), run, PIECES)


def differencing(sizes: list[int], windows: int) -> tuple[np.ndarray, np.ndarray]:
    """Karmarkar-Karp: ``(window of each size, sum of each window)``.

    A partial partition is its window sums in descending order, windows that
    are still empty left out. The two with the widest spread merge: the
    larger sums of one meet the smaller sums of the other.
    """
    n = len(sizes)
    child_a, child_b = [], []                 # of joined windows, numbered from n
    parts, heap = {}, []
    for i, s in enumerate(sizes):
        parts[i] = (np.array([s], np.int64), np.array([i], np.int64))
        heap.append((-s, i))
    heapq.heapify(heap)
    key = n
    while len(heap) > 1:
        (sa, na), (sb, nb) = (parts.pop(heapq.heappop(heap)[1]) for _ in range(2))
        if len(sa) < len(sb):
            sa, na, sb, nb = sb, nb, sa, na
        free = windows - len(sa)              # empty windows take the largest of b
        more = sb[free:]
        if len(more):
            meet = np.arange(len(sa) - 1, len(sa) - 1 - len(more), -1)
            ids = np.arange(n + len(child_a), n + len(child_a) + len(more))
            child_a.extend(na[meet].tolist())
            child_b.extend(nb[free:].tolist())
            sa[meet] += more
            na[meet] = ids
        sa, na = np.concatenate([sa, sb[:free]]), np.concatenate([na, nb[:free]])
        order = np.argsort(-sa, kind="stable")
        sa, na = sa[order], na[order]
        spread = sa[0] - sa[-1] if len(sa) == windows else sa[0]
        parts[key] = (sa, na)
        heapq.heappush(heap, (-int(spread), key))
        key += 1
    sums, nodes = parts[heap[0][1]]
    where = np.empty(n + len(child_a), np.int64)
    where[nodes] = np.arange(len(nodes))
    for k in range(len(child_a) - 1, -1, -1):
        where[child_a[k]] = where[child_b[k]] = where[n + k]
    return where[:n], sums


def pack_group(sizes: list[int], capacity: int) -> np.ndarray:
    """The window of each size; as many windows as it takes to keep all within ``capacity``."""
    total = sum(sizes)
    windows = max(1, -(-total // capacity))
    while True:
        where, sums = differencing(sizes, windows)
        top = int(sums.max())
        if top <= capacity:
            return where
        # the mean must leave room for the excess over it
        room = capacity - (top - total / windows)
        windows = max(windows + 1, int(-(-total // room)) if room > 0 else 0)


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
         capacity: int = CAPACITY, grain: int = GRAIN, end_id: int = END_ID,
         group: int = GROUP) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` per piece.

    Only pieces' numbers move, dealt over groups by a hash of their row, so
    neither a hot source nor repeated rows widen a group. Sequence ids are
    unique, not dense.
    """
    rows = saved(token_pieces(docs, tokenizer_path, id_col, text_col, capacity, grain, end_id)) \
        .withColumn("row", F.monotonically_increasing_id())
    full = rows.where(F.col("length") == capacity).select(
        *[c for c in rows.columns if c != "row"], (F.col("row") * 2 + 1).alias("sequence_id"),
        F.lit(0).cast("bigint").alias("offset"))
    rest = rows.where(F.col("length") < capacity)
    groups = max(1, -(-rest.count() // group))

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("row")
        window = pack_group(part["length"].tolist(), capacity)
        part = part.assign(sequence_id=(part["bin"].astype("int64") * (1 << 32) + window) * 2)
        part["offset"] = part.groupby("sequence_id")["length"].cumsum() - part["length"]
        return part.drop(columns=["bin", "row"])

    packed = rest.withColumn("bin", F.pmod(F.xxhash64("row"), F.lit(groups)).cast("bigint")) \
        .groupBy("bin").applyInPandas(run, PIECES + ", sequence_id bigint, offset bigint")
    return full.unionByName(packed)
