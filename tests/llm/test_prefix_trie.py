import hashlib
import math
import zlib
from collections import defaultdict

import pytest
from conversation_cases import SCHEMA, as_frame, edge_conversations
from llm_cases import CLASHES, rows_of

from pyspark.sql import functions as F
from strata.llm import prefix_trie as P


def by_null(*values):
    return tuple((v is not None, v if v is not None else 0) for v in values)


def rebuilt(rows):
    convs = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            convs[c].append((t, role or "", text or ""))
    own = {c: [m[1:] for m in sorted(v, key=lambda m: (by_null(m[0]), m[1:]))] for c, v in convs.items()}
    out = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = own.get(c - int(math.fmod(c, 5)), [])[:h] + own[c][h:]
    return out


def brute(rows):
    """Nodes by walking every prefix, children and subtree explicitly."""
    conv = rebuilt(rows)
    members, kids = defaultdict(list), defaultdict(list)
    for c, s in conv.items():
        for d in range(len(s) + 1):
            members[tuple(s[:d])].append(c)
    for k in members:
        if k:
            kids[k[:-1]].append(k)
    saved, leaves, out = {}, {}, []
    for k in sorted(members, key=len, reverse=True):
        saved[k] = (len(members[k]) - 1) * (len(k[-1][1].encode()) if k else 0) + sum(saved[x] for x in kids[k])
        leaves[k] = sum(leaves[x] for x in kids[k]) or 1
        ends = ",".join(str(c) for c in sorted(members[k]) if len(conv[c]) == len(k))
        out.append((min(members[k]), len(k), min(members[k[:-1]]) if k else None, len(members[k]),
                    len(kids[k]), leaves[k], saved[k], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=lambda r: [(x is not None, str(type(x)), x) for x in r])


@pytest.mark.parametrize("seed", [5, 6])
def test_nodes_match_brute_force(spark, seed):
    rows = edge_conversations(seed)
    assert rows_of(P.shared_prefixes(as_frame(spark, rows, 7))) == brute(rows)


def test_end_lists_of_several_parts(spark, monkeypatch):
    monkeypatch.setattr(P, "ENDS", 2)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    rows = [(c, 0, "user", "same") for c in range(40)] + [(c, 1, "assistant", str(c % 3)) for c in range(0, 40, 4)]
    try:
        assert rows_of(P.shared_prefixes(as_frame(spark, rows))) == brute(rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_clashing_columns_and_empty_table(spark):
    rows = edge_conversations()
    extra = [F.lit("clash").alias(x) for x in [*CLASHES, "c", "d", "at", "pos", "block", "node", "bytes"]]
    assert rows_of(P.shared_prefixes(as_frame(spark, rows).select("*", *extra))) == brute(rows)
    assert P.shared_prefixes(spark.createDataFrame([], SCHEMA)).count() == 0


def test_general_interface_names_the_ends(spark):
    turns = P.turn_rows(as_frame(spark, [(1, 0, "user", "a"), (2, 0, "user", "a"), (2, 1, "user", "b")]))
    nodes, ends = P.prefix_nodes(turns.withColumnRenamed("pos", "at"), turns.select("c").distinct())
    ids = {r["node"]: r["ids"] for r in ends.collect()}
    assert {(r["depth"], r["n_convs"], ids.get(r["node"])) for r in nodes.collect()} == {
        (0, 2, None), (1, 2, "1"), (2, 1, "2")}
