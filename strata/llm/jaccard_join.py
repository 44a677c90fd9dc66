"""N-gram Jaccard join by grouped prefixes (operator 1).

Two documents link when the Jaccard likeness of their word-shingle sets
reaches a threshold. All shingles have one global order, rare ones first; two
sets that link share a shingle of their prefixes (the first 15 % or so).

1. Documents with the same set are one set from the start.
2. Shingles in the lowest part of the hash range, always enough for a prefix,
   are counted; those in one set alone come first in the order and generate
   nothing, so a set whose prefix holds only such shingles is done.
3. Sets with identical prefixes and size collapse into one group. Pairs of
   groups that share a prefix shingle are filtered by size and position: what
   stands from the shingle on bounds the overlap, and of two groups that may
   link one holds it early (in the first 8 % or so). Where no group of
   compatible size does, the shingle ties nothing; elsewhere groups are tied
   to one leader per shingle and size class, not to each other, and ties are
   followed to candidate classes.
4. Classes are expanded to their sets, which meet in tiles of bounded size and
   work. There all shingles are counted anew, rare ones come first, and the
   same filter by size and position, now on whole sets, leaves the pairs that
   are verified by exact intersection. A class of several tiles is verified by
   pairs of tiles.

Sets are distinct 64-bit shingle hashes; likeness is compared in integers.

Defined results: null and empty texts, and texts without a word, have an
empty set, link with nothing and are their own component; fewer words than a
shingle are one shingle; rows that share an id share a component only where
their sets link; rows with a null id link like any other, but never name a
component: one without any id is null.
Other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm import words as W
from strata.llm.common import bitmap, bitmap_bits, boxed, components, dealt_join, in_batches, marked, saved

WORDS, SHARE = 4, (85, 100)     # words of a shingle; least intersection / union
TILE = 1 << 20                  # shingles in a tile, about
WORK = 1 << 32                  # sets times shingles in a tile, about
_KIND, _VALUE = W.kinds("visible"), W.values(True)
_OTHER = np.uint64(0x5851F42D4C957F2D)


def prefix_length(n: int, share: tuple[int, int]) -> int:
    """How many first shingles two linking sets must share one of."""
    return n - -(-n * share[0] // share[1]) + 1


def region(share: tuple[int, int]) -> int:
    """Upper end of the counted hash range: it holds 1.7 prefixes on average."""
    return int(min(0.5, 1.7 * (1 - share[0] / share[1])) * 2 ** 64)


def _slices(texts: pa.Array, words: int) -> Iterator[tuple[int, list[np.ndarray], np.ndarray, np.ndarray]]:
    """``(first row, sets, s, s2)`` of a slice; ``s`` and ``s2`` are two hashes of each set."""
    for first, data, offsets in W.slices(texts):
        sets = list(W.shingle_sets(*W.words(data, offsets, _KIND, _VALUE), words))
        n = np.array([len(x) for x in sets])
        s, s2 = np.zeros(len(sets), np.uint64), np.zeros(len(sets), np.uint64)
        filled = n > 0
        if filled.any():
            every = np.concatenate(sets)
            starts = (np.cumsum(n) - n)[filled]
            s[filled] = W.mixed(np.add.reduceat(W.mixed(every), starts))
            s2[filled] = W.mixed(np.add.reduceat(W.mixed(every ^ _OTHER), starts))
        yield first, sets, s.view(np.int64), s2.view(np.int64)


def _emitted(x: np.ndarray, share: tuple[int, int], limit: int) -> int:
    """How many of a sorted set's first hashes are counted: the region, at least a prefix."""
    return max(prefix_length(len(x), share), int(np.searchsorted(x, np.uint64(limit))))


def set_rows(docs: DataFrame, words: int, share: tuple[int, int]) -> DataFrame:
    """``(doc_id, n, r, low, s, s2)`` per row: set size, counted shingles, those of them in the
    region, the set's name; null if empty.

    A ``key`` beside id and text is kept.
    """
    limit = region(share)
    kept = docs.columns[2:]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, sets, s, s2 in _slices(batch.column(1), words):
                n = np.array([len(x) for x in sets], np.int64)
                r = np.array([_emitted(x, share, limit) if len(x) else 0 for x in sets], np.int64)
                low = np.array([np.searchsorted(x, np.uint64(limit)) for x in sets], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(sets)), pa.array(n), pa.array(r), pa.array(low),
                     pa.array(s, mask=n == 0), pa.array(s2, mask=n == 0),
                     *[batch.column(2).slice(first, len(sets)) for _ in kept]],
                    ["doc_id", "n", "r", "low", "s", "s2", *kept])

    return in_batches(docs, run, "doc_id bigint, n bigint, r bigint, low bigint, s bigint, s2 bigint"
                      + "".join(f", {k} bigint" for k in kept))


def counted_shingles(docs: DataFrame, words: int, share: tuple[int, int]) -> DataFrame:
    """``(h, s)`` of every distinct set in a task: copies are gone before anything moves."""
    limit = region(share)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            for _, sets, s, s2 in _slices(batch.column(1), words):
                hs, ss = [], []
                for x, a, b in zip(sets, s.tolist(), s2.tolist()):
                    if len(x) and (a, b) not in seen:
                        seen.add((a, b))
                        hs.append(x[:_emitted(x, share, limit)])
                        ss.append(a)
                if hs:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(hs).view(np.int64)),
                         pa.array(np.repeat(np.array(ss, np.int64), [len(x) for x in hs]))],
                        ["h", "s"])

    return in_batches(docs, run, "h bigint, s bigint")


def set_bytes(docs: DataFrame, words: int, marks) -> DataFrame:
    """``(s, s2, hashes)`` of the sets whose name the bitmap lets through, once per task."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            for _, sets, s, s2 in _slices(batch.column(1), words):
                rows = []
                for i in np.flatnonzero(marked(marks.value, s)).tolist():
                    key = (int(s[i]), int(s2[i]))
                    if len(sets[i]) and key not in seen:
                        seen.add(key)
                        rows.append((*key, sets[i].tobytes()))
                if rows:
                    a, b, x = zip(*rows)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(x, pa.binary())],
                        ["s", "s2", "hashes"])

    return in_batches(docs, run, "s bigint, s2 bigint, hashes binary")


def prefixes(tokens: DataFrame, sets: DataFrame, share: tuple[int, int]) -> DataFrame:
    """``(id, n, prefix, skip)`` of the sets whose prefix holds a shingle of another set.

    ``prefix`` lists those shingles alone; the order is: counted region by
    number of sets and hash, then the other shingles by hash. ``skip``
    shingles of the region, the set's own, come before.
    """
    frequent = tokens.groupBy("h").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    low = (F.col("h") >= 0) & (F.col("h") < F.lit(min(region(share), 2 ** 63 - 1)))
    place = F.struct((~low).alias("outer"), F.when(low, F.col("df")).otherwise(0).alias("df"), "h")
    common = dealt_join(tokens, frequent, ["h"]).groupBy("s").agg(F.collect_set(place).alias("t"))
    a, b = share
    length = F.expr(f"n - ((n * {a} + {b - 1}) div {b}) + 1")
    # shingles of this set alone come first and fill the prefix from the front
    take = length - (F.col("r") - F.size("t"))
    inner = F.size(F.filter("t", lambda x: ~x["outer"]))
    return common.join(sets, "s").withColumn("take", take).where("take > 0").select(
        F.col("sid").alias("id"), "n",
        F.slice(F.transform(F.array_sort("t"), lambda x: x["h"]), F.lit(1),
                F.col("take").cast("int")).alias("prefix"),
        (F.col("low") - inner).alias("skip"))


def early(n, p, share: tuple[int, int]):
    """Whether two sets of ``n`` that first share their ``p``-th shingle (from 0) may link.

    Of any two sets that link, one holds the first shared shingle early: the
    overlap is at most the smaller of the two rests ``n - p``, which is too
    little for sets that both hold it later than this.
    """
    return share[1] * (n - p) >= share[0] * (n + p)


def size_class(share: tuple[int, int]):
    """Sets whose classes differ by two or more are too unlike in size to link."""
    width = math.log(share[1] / share[0]) * 1.0001 if share[0] < share[1] else 1e-9
    return F.floor(F.log(F.col("n").cast("double")) / F.lit(width)).cast("bigint")


def candidate_ties(pre: DataFrame, share: tuple[int, int]) -> DataFrame:
    """``(a, b)``: ties whose classes hold every pair of sets that may link."""
    groups = pre.groupBy("n", "prefix").agg(F.min("id").alias("g"), F.min("skip").alias("skip"))
    members = dealt_join(pre.drop("skip"), groups.drop("skip"), ["n", "prefix"]).where("id <> g").select(
        F.col("id").alias("a"), F.col("g").alias("b"))
    keys = groups.select("g", "n", size_class(share).alias("c"), "skip", F.posexplode("prefix").alias("pos", "h")) \
        .select("g", "c", "h", early(F.col("n"), F.col("skip") + F.col("pos"), share).alias("early"))
    leaders = keys.groupBy("h", "c").agg(F.min("g").alias("lead"), F.count(F.lit(1)).alias("k"),
                                         F.max("early").alias("early"))
    # size classes of a shingle: a hundred or two at most
    near = Window.partitionBy("h").orderBy("c").rangeBetween(-1, 1)
    above = Window.partitionBy("h").orderBy("c")
    led_by = leaders.withColumns({"some": F.max("early").over(near), "next": F.lead("c").over(above),
                                  "next_early": F.lead("early").over(above), "next_lead": F.lead("lead").over(above)})
    led = dealt_join(keys.select("g", "h", "c"), led_by.where("k > 1 AND some").select("h", "c", "lead"), ["h", "c"]) \
        .where("g <> lead").select(F.col("g").alias("a"), F.col("lead").alias("b"))
    next_ = led_by.where("next = c + 1 AND (early OR next_early) AND lead <> next_lead").select(
        F.col("lead").alias("a"), F.col("next_lead").alias("b"))
    return members.unionByName(led).unionByName(next_).distinct()


def _candidates(token: np.ndarray, start: np.ndarray, n: np.ndarray, df: np.ndarray, share: tuple[int, int]):
    """A function of ``(set, last)``: later sets below ``last`` that may link with it.

    ``token`` lists the shingles of each set, rare ones first; sets ascend by size.
    """
    a, b = share
    length = n - -(-n * a // b) + 1
    owner = np.repeat(np.arange(len(n)), length)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(length) - length, length)
    entry = token[start[owner] + place]
    seen = df[entry] > 1
    owner, place, entry = owner[seen], place[seen], entry[seen]
    # a shingle that no set holds early ties nothing
    some = np.zeros(len(df), bool)
    some[entry[early(n[owner], place, share)]] = True
    seen = some[entry]
    owner, place, entry = owner[seen], place[seen], entry[seen]
    of_set = np.searchsorted(owner, np.arange(len(n) + 1))
    order = np.argsort(entry, kind="stable")            # by shingle, then by set
    lists = np.searchsorted(entry[order], np.arange(len(df) + 1))
    by, rest = owner[order], n[owner[order]] - place[order]

    def later(i: int, last: int) -> np.ndarray:
        marks = np.zeros(last - i, bool)
        for e in range(of_set[i], of_set[i + 1]):
            lo, hi = lists[entry[e]], lists[entry[e] + 1]
            lo, hi = lo + np.searchsorted(by[lo:hi], i, "right"), lo + np.searchsorted(by[lo:hi], last)
            if lo < hi:
                most = np.minimum(rest[lo:hi], n[i] - place[e])     # of the overlap
                j = by[lo:hi]
                marks[j[b * most >= a * (n[i] + n[j] - most)] - i] = True
        return np.flatnonzero(marks) + i

    return later


def verify(sets: list[np.ndarray], side: np.ndarray, copies: np.ndarray, share: tuple[int, int],
           count: bool) -> tuple[np.ndarray, np.ndarray]:
    """``(root of each set, links of each set)`` among the sets of a tile or two.

    Pairs that the filter leaves are intersected. With ``count`` all of them
    are, and a set's links are the copies of the sets it links with (pairs of
    one side only where there is one side). Without, sets that are already in
    the class of another are not compared with it again.
    """
    a, b = share
    size = np.array([len(x) for x in sets], np.int64)
    order = np.argsort(size, kind="stable")
    n = size[order]
    stop = np.cumsum(n)
    start = stop - n
    _, token, df = np.unique(np.concatenate([sets[i] for i in order]), return_inverse=True, return_counts=True)
    rare = np.argsort(df, kind="stable")
    rank = np.empty(len(df), np.int64)
    rank[rare] = np.arange(len(df))
    owner = np.repeat(np.arange(len(n)), n)
    token = np.sort(owner * len(df) + rank[token]) - owner * len(df)      # rare ones first in each set
    later = _candidates(token, start, n, df[rare], share)
    flag = np.zeros(len(df), np.uint8)
    links, label = np.zeros(len(n), np.int64), np.arange(len(n))
    two = len(np.unique(side)) > 1
    where, weight = side[order], copies[order]

    for i in range(len(n)):
        # larger sets that may link
        last = int(np.searchsorted(n, n[i] * b // a, "right"))
        if last <= i + 1:
            continue
        rest = later(i, last)
        rest = rest[where[rest] != where[i]] if two and count else rest if count else rest[label[rest] != label[i]]
        if not len(rest):
            continue
        mine = token[start[i]:stop[i]]
        flag[mine] = 1
        if n[rest].sum() * 4 > stop[last - 1] - start[i + 1]:
            own = np.add.reduceat(flag[token[start[i + 1]:stop[last - 1]]],
                                  start[i + 1:last] - start[i + 1], dtype=np.int64)[rest - i - 1]
        else:
            ends = np.cumsum(n[rest])
            at = np.arange(ends[-1]) + np.repeat(start[rest] - (ends - n[rest]), n[rest])
            own = np.add.reduceat(flag[token[at]], ends - n[rest], dtype=np.int64)
        flag[mine] = 0
        hit = rest[own * b >= a * (n[i] + n[rest] - own)]
        links[i] += weight[hit].sum()
        links[hit] += weight[i]
        for other in np.unique(label[hit]).tolist():
            if other != label[i]:
                label[label == other] = label[i]
    out, back = np.empty(len(n), np.int64), np.empty(len(n), np.int64)
    out[order] = order[label]
    back[order] = links
    return out, back


def tiles(nodes: DataFrame, share: tuple[int, int], tile: int, work: int) -> DataFrame:
    """``nodes`` with ``(lo, hi, side)``: the pairs of tiles that a set takes part in."""
    sized = nodes.withColumn("c", size_class(share))

    def wanted() -> Column:
        """Tiles that sets are dealt over: by their shingles, and by sets times shingles."""
        return F.greatest(F.lit(1), F.ceil(F.sum("n") / F.lit(tile)), F.ceil(F.sqrt(
            F.count(F.lit(1)).cast("double") * F.sum("n") / F.lit(work)))).cast("bigint")

    whole = sized.groupBy("component").agg(wanted().alias("all"))
    wide = dealt_join(sized, whole, ["component"])
    zero = F.lit(0).cast("bigint")
    alone = wide.where(F.col("all") == 1).select(
        *nodes.columns, zero.alias("lo"), zero.alias("hi"), zero.alias("side"))
    large = wide.where(F.col("all") > 1)
    parts = large.groupBy("component", "c").agg(wanted().alias("k"))

    def near(step: int) -> DataFrame:
        return parts.select("component", (F.col("c") - step).alias("c"), F.col("k").alias(f"k{step + 1}"))

    # one row per class and size class, dealt anew from the sets that they count
    around = near(0).join(near(1), ["component", "c"], "left").join(near(-1), ["component", "c"], "left")
    spread = dealt_join(large, around, ["component", "c"])
    me = F.col("c") * (1 << 24) + F.pmod(F.xxhash64("id"), F.col("k1"))

    def pairs(step: int, k):
        there = (F.col("c") + step) * (1 << 24)
        every = F.when(k > 0, F.sequence(F.lit(0).cast("bigint"), k - 1)) \
            .otherwise(F.array().cast("array<bigint>"))
        return F.transform(every, lambda j: F.struct(
            F.least(me, there + j).alias("lo"), F.greatest(me, there + j).alias("hi")))

    return alone.unionByName(spread.select(
        *nodes.columns, me.alias("side"), F.explode(F.concat(
            pairs(0, F.col("k1")), pairs(1, F.coalesce("k2", zero)),
            pairs(-1, F.coalesce("k0", zero)))).alias("t"))
        .select(*nodes.columns, "t.lo", "t.hi", "side"))


def verified(docs: DataFrame, nodes: DataFrame, words: int, share: tuple[int, int], tile: int,
             count: bool) -> DataFrame:
    """``(id, root, links)`` of every node in every pair of tiles it takes part in."""
    marks = docs.sparkSession.sparkContext.broadcast(bitmap(nodes, "s", bitmap_bits(nodes.count())))
    # tasks that hold copies of a set each send it: one of them goes on
    held = set_bytes(docs, words, marks).groupBy("s", "s2").agg(F.any_value("hashes").alias("hashes"))
    rows = tiles(nodes, share, tile, WORK).join(held, ["s", "s2"])

    def run(key: tuple, table: pa.Table) -> pa.Table:
        ids, at = np.unique(table.column("id").to_numpy(), return_index=True)
        if key[1] != key[2] and len(np.unique(table.column("side").to_numpy())) == 1:
            # no set is in the other tile; the tile's own pairs meet in (lo, lo)
            return pa.table({"id": ids, "root": ids, "links": np.zeros(len(ids), np.int64)})
        held = table.column("hashes")
        sets = [np.frombuffer(held[i].as_buffer(), np.uint64) for i in at.tolist()]
        roots, links = verify(sets, table.column("side").to_numpy()[at],
                              table.column("copies").to_numpy()[at], share, count)
        return pa.table({"id": ids, "root": ids[roots], "links": links})

    out = saved(rows.select("component", "lo", "hi", "side", "id", "copies", "hashes")
                .groupBy("component", "lo", "hi").applyInArrow(run, "id bigint, root bigint, links bigint"))
    marks.destroy()
    return out


def linked_sets(own: DataFrame, rows: DataFrame, words: int, share: tuple[int, int], tile: int,
                count: bool) -> tuple[DataFrame, DataFrame]:
    """``(found, classes)``: verified links, and every distinct set with its component.

    Sets are numbered, so that neither null nor repeated document ids tie or
    part them; ``first`` is the smallest document id of a set.
    """
    sets = saved(rows.where("n > 0").groupBy("s", "s2").agg(
        F.min("doc_id").alias("first"), F.max("n").alias("n"), F.max("r").alias("r"), F.max("low").alias("low"),
        F.count(F.lit(1)).alias("copies")).withColumn("sid", F.monotonically_increasing_id()))
    pre = saved(prefixes(counted_shingles(own, words, share), sets, share))
    ties = components(candidate_ties(pre, share))
    nodes = saved(ties.join(sets, F.col("id") == F.col("sid")).select(
        "id", "component", "s", "s2", "n", "copies"))
    found = verified(own, nodes, words, share, tile, count)
    linked = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    classes = sets.join(linked, F.col("sid") == F.col("id"), "left").select(
        "sid", F.coalesce("component", "sid").alias("component"), "first", "copies", "s", "s2")
    return found, classes


def jaccard_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    words: int = WORDS, share: tuple[int, int] = SHARE, tile: int = TILE,
                    count: bool = True) -> DataFrame:
    """Per row: ``doc_id, n_shingles, component_id`` and, with ``count``, ``n_links``.

    ``component_id`` is the smallest id reachable by links, ``n_links`` the
    number of other rows that a row links with.
    """
    own = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"),
                      F.col(f"`{text_col}`").cast("string").alias("text"))
    rows = saved(set_rows(own, words, share))
    found, classes = linked_sets(own, rows, words, share, tile, count)
    # the smallest document id names a component, whatever its sets are numbered
    names = classes.groupBy("component").agg(F.min("first").alias("component_id"))
    links = found.groupBy(F.col("id").alias("lid")).agg(F.sum("links").alias("other"))
    named = dealt_join(classes, names, ["component"]) \
        .join(links, F.col("sid") == F.col("lid"), "left").select(
        F.col("s").alias("ks"), F.col("s2").alias("ks2"), "component_id",
        (F.coalesce("other", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    out = rows.join(named, (F.col("s") == F.col("ks")) & (F.col("s2") == F.col("ks2")), "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"))
    return out if count else out.drop("n_links")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     words: int = WORDS, share: tuple[int, int] = SHARE) -> DataFrame:
    """``docs`` with one row of every component, all columns as they were.

    The row of the smallest id stays, rows without an id come last; rows that
    tie are ordered by their text's hash, and of rows alike in id and text one
    stays. Rows without a word have no component and stay.
    """
    text = F.col(f"`{text_col}`").cast("string")
    own = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), text.alias("text"))
    keys = own.withColumn("key", F.xxhash64("text"))
    rows = saved(set_rows(keys, words, share))
    _, classes = linked_sets(own, rows, words, share, TILE, False)
    whole = rows.where("n > 0").join(classes.select("s", "s2", "component"), ["s", "s2"])
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")
    # a component of one row keeps it: only rows of larger ones are decided
    tops = whole.groupBy("component").agg(F.min(place).alias("top"), F.count(F.lit(1)).alias("k")) \
        .where("k > 1").select("component", "top")
    judged = saved(dealt_join(whole, tops, ["component"]).select(
        F.col("doc_id").alias("g_id"), F.col("key").alias("g_key"), (place == F.col("top")).alias("stays"))
        .groupBy("g_id", "g_key", "stays").agg(F.count(F.lit(1)).alias("g_n")))
    keyed = docs.select(boxed(docs), F.col(f"`{id_col}`").cast("bigint").alias("id"),
                        F.xxhash64(text).alias("key"))
    match = F.col("id").eqNullSafe(F.col("g_id")) & (F.col("key") == F.col("g_key"))
    out = keyed.join(judged.where("not stays"), match, "left_anti")
    again = judged.where("stays and g_n > 1")
    if not again.isEmpty():
        one = out.join(again, match, "left_semi").dropDuplicates(["id", "key"])
        out = out.join(again, match, "left_anti").unionByName(one)
    return out.select("doc.*")
