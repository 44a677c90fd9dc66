"""Conversation prefix trie (operator 13): how much a cache of shared prefixes saves.

Every distinct sequence of a conversation's first ``d`` turns is a node of
depth ``d``; the root has none. Nodes are found by whole-sequence collapse:

1. A turn is hashed with its place, a prefix is named by its depth and the
   sums of those hashes (two of 60 bits), so a conversation's name is one
   aggregate and the names of its prefixes are running sums.
2. Identical conversations collapse into one weighted sequence with the list
   of its conversations (in blocks of ids, so no list is unbounded); the
   smallest id represents it and only its turns go on.
3. Sequences that are a proper prefix of another go by an anti-join with the
   parents of all prefixes; what is left are the leaves.
4. The weighted prefixes of all sequences are aggregated to nodes. Sums over a
   subtree need no walk: the turns below a node are counted sequence by
   sequence (each sequence's total less what stands above the node), once
   with the weight of the conversations and once for distinct nodes, where
   every node belongs to the sequence of its smallest member and a sequence
   owns the end of its path. All is linear in the turns of distinct sequences.

The names are checked: all places of a node must end in one turn (by SHA-256)
and have one parent, which by induction makes the sequences equal; otherwise
the query fails.

Defined results: rows without a conversation id belong to none and are left
out; a null turn comes first; rows that share a turn are ordered by role and
text (the first 64 characters of each, then SHA-256), equal rows both count;
null role or text is empty; a conversation may have no turn at all and then
ends at the root. Other columns are ignored. An empty table gives no node.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import dealt_join, saved
from strata.llm.ordered import in_order, positions, running

ENDS = 1024             # ids of conversations in one block of an end list, at most
SHARED, GROUP = 9, 5    # rebuilt conversations: up to 8 turns of the group's first
_LANES = ("g1", "g2")


def turn_rows(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
              role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``(c, pos, block, th, bytes)``: turns numbered within their conversation."""
    role = F.coalesce(F.col(f"`{role_col}`").cast("string"), F.lit(""))
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = conversations.select(
        F.col(f"`{conv_col}`").cast("bigint").alias("c"), F.col(f"`{turn_col}`").cast("bigint").alias("t"),
        F.left(role, F.lit(64)).alias("role"), F.left(text, F.lit(64)).alias("start"),
        F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256).alias("th"),
        F.octet_length(text).cast("bigint").alias("bytes")).where("c IS NOT NULL")
    ordered = in_order(rows, ["c"], [F.col("t").asc_nulls_first(), F.col("role").asc(),
                                     F.col("start").asc(), F.col("th").asc()])
    return saved(positions(ordered.select("c", "row", "block", "th", "bytes"), ["c"])
                 .select("c", "pos", "block", "th", "bytes"))


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(turns, conversations)`` after every conversation got a shared beginning.

    Conversation ``c`` becomes the first ``h`` turns of conversation
    ``c - c % 5``, then its own from the ``h + 1``-th; ``h = crc32(c) % 9``.
    """
    size = turns.groupBy("c").agg(F.count(F.lit(1)).alias("k"))
    base = F.col("c") - F.col("c") % GROUP
    own = size.select("c", base.alias("base"),
                      (F.crc32(F.col("c").cast("string").cast("binary")) % SHARED).alias("h"))
    convs = saved(own.join(size.select(F.col("c").alias("base"), "k"), "base", "left").select(
        "c", "base", "h", F.least("h", F.coalesce("k", F.lit(0))).alias("m")))
    heads = turns.where(F.col("pos") < SHARED).select(F.col("c").alias("base"), "pos", "th", "bytes")
    front = convs.join(heads, "base").where("pos <= h").select(
        "c", F.lit(-1).cast("bigint").alias("block"), F.col("pos").alias("at"), "th", "bytes")
    tail = dealt_join(turns, convs, ["c"]).where("pos > h").select(
        "c", "block", (F.col("m") + F.col("pos") - F.col("h")).alias("at"), "th", "bytes")
    return saved(front.unionByName(tail)), convs.select("c")


def _lane(k: int) -> Column:
    """60 bits of the hash of a turn and its place."""
    mixed = F.sha2(F.concat(F.col("at").cast("string"), F.lit(":"), F.col("th")), 256)
    return F.conv(F.substring(mixed, 1 + 15 * k, 15), 16, 10).cast("decimal(20,0)")


def _name(d: Column, *lanes: Column) -> Column:
    return F.concat_ws(":", d.cast("string"), *[x.cast("string") for x in lanes])


def prefix_nodes(turns: DataFrame, convs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(nodes, ends)`` of conversations given as ``(c, block, at, th, bytes)`` and ``(c)``.

    ``at`` counts 1, 2, ... within a conversation, ``block`` ascends with it.

    nodes: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``,
    ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens`` (over the
    subtree: bytes of the last turn for every conversation but the first),
    ``node`` (its name). The node's turn is the ``depth``-th of ``conv_id``.
    ends: ``(node, part, ids)``, the ids of the conversations that end at a
    node, ascending within a part and over the parts, joined by commas.
    """
    zero, none = F.lit(0).cast("bigint"), F.lit(0).cast("decimal(38,0)")
    keyed = turns.select("*", *[_lane(k).alias(g) for k, g in enumerate(_LANES)])
    wholes = keyed.groupBy("c").agg(
        F.count(F.lit(1)).alias("d"), F.sum("bytes").alias("bytes"), *[F.sum(g).alias(g) for g in _LANES])
    named = saved(dealt_join(convs, wholes, ["c"], "left").select(
        "c", _name(F.coalesce("d", zero), *[F.coalesce(F.col(g).cast("decimal(38,0)"), none)
                                            for g in _LANES]).alias("node"),
        F.coalesce("d", zero).alias("length"), F.coalesce("bytes", zero).alias("all")))
    sequences = saved(named.groupBy("node").agg(
        F.min("c").alias("c"), F.count(F.lit(1)).alias("w"), F.min("length").alias("length"),
        F.min("all").alias("all")))
    ends = named.groupBy("node", F.floor(F.col("c") / ENDS).alias("part")).agg(
        F.array_join(F.sort_array(F.collect_list("c")), ",").alias("ids"))

    # the prefixes of every sequence, along the turns of its smallest conversation
    kept = dealt_join(keyed, sequences.select("c"), ["c"], "left_semi") \
        .withColumns({g: F.col(g).cast("decimal(38,0)") for g in _LANES})
    sums = running(kept, ["c"], "at", [*_LANES, "bytes"])
    root = sequences.select(
        "c", zero.alias("d"), _name(zero, none, none).alias("node"), F.lit(None).cast("string").alias("parent"),
        F.lit(None).cast("string").alias("th"), zero.alias("bytes"), zero.alias("upto"))
    paths = saved(root.unionByName(sums.select(
        "c", F.col("at").alias("d"), _name(F.col("at"), *[F.col(f"r_{g}") for g in _LANES]).alias("node"),
        _name(F.col("at") - 1, *[F.col(f"r_{g}") - F.col(g) for g in _LANES]).alias("parent"),
        "th", "bytes", F.col("r_bytes").alias("upto"))))

    parents = paths.select(F.col("parent").alias("node")).where("node IS NOT NULL").distinct()
    leaves = dealt_join(sequences, parents, ["node"], "left_anti").select("c", F.lit(1).alias("leaf"))
    weights = sequences.select("c", "w", "all").join(leaves, "c", "left")
    steps = saved(dealt_join(paths, weights, ["c"]))
    one = F.when((F.min("th").eqNullSafe(F.max("th"))) & (F.min("parent").eqNullSafe(F.max("parent"))),
                 F.min("parent")).otherwise(F.raise_error(F.lit("two prefixes share a name")))
    nodes = saved(steps.groupBy("node").agg(
        F.min("c").alias("conv_id"), F.min("d").alias("depth"), F.sum("w").alias("n_convs"),
        F.sum(F.coalesce("leaf", zero)).cast("bigint").alias("n_leaves"), one.alias("parent"),
        F.sum(F.col("w") * F.col("all")).alias("weighed"), F.min(F.col("upto") - F.col("bytes")).alias("above")))

    # a sequence owns the nodes of which its conversation is the smallest member
    owned = nodes.groupBy(F.col("conv_id").alias("c")).agg(F.min("depth").alias("from"))
    tops = dealt_join(steps, owned, ["c"]).where("d = `from`").select(
        "c", "from", (F.col("all") - F.col("upto") + F.col("bytes")).alias("own"))
    below = dealt_join(steps, tops, ["c"]).groupBy("node").agg(
        F.sum(F.when(F.col("from") > F.col("d"), F.col("own"))
              .otherwise(F.col("all") - F.col("upto") + F.col("bytes"))).alias("once"))
    children = nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node")) \
        .agg(F.count(F.lit(1)).alias("n_children"))
    tree = nodes.join(below, "node").join(children, "node", "left")
    up = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    out = dealt_join(tree, up, ["parent"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", zero).alias("n_children"),
        "n_leaves", (F.col("weighed") - F.col("n_convs") * F.col("above") - F.col("once"))
        .cast("bigint").alias("saved_tokens"), "node")
    return out, ends


def ends_digest(ends: DataFrame) -> DataFrame:
    """``(node, sha)``: SHA-256 of all parts of a node's end list, joined by commas.

    A digest reads its input in order: the parts of a node stream through one
    task, a part at a time; only very large lists have several.
    """
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, digest = None, None
        for batch in batches:
            done = []
            for node, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if node != here:
                    if here is not None:
                        done.append((here, digest.hexdigest()))
                    here, digest = node, hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in zip(*done)],
                                                 ["node", "sha"])
        if here is not None:
            yield pa.RecordBatch.from_arrays([pa.array([here]), pa.array([digest.hexdigest()])],
                                             ["node", "sha"])

    return ends.repartition("node").sortWithinPartitions("node", "part").select("node", "ids") \
        .mapInArrow(run, "node string, sha string")


def shared_prefixes(conversations: DataFrame) -> DataFrame:
    """The nodes of rebuilt conversations, each with the digest of its end list."""
    nodes, ends = prefix_nodes(*rebuilt(turn_rows(conversations)))
    # a join on the digests' own nodes: one row each
    return nodes.join(ends_digest(ends), "node", "left").select(
        *[c for c in nodes.columns if c != "node"],
        F.coalesce("sha", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"))
