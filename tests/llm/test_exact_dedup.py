import hashlib
import re
from collections import defaultdict

import pytest
from llm_cases import (  # noqa: F401
    clashing_docs, edge_docs, edge_rows, no_docs, prose, rows_of)

from strata.llm import exact_dedup as X


def brute(rows):
    groups = defaultdict(list)
    for i, text in rows:
        t = text or ""
        groups[re.sub(r"[\x20\x09-\x0D]", "", t)].append((i, t))
    out = []
    for norm, members in groups.items():
        best = min(members, key=lambda m: (-len(m[1]), m[0] is None, m[0] or 0))
        sha = hashlib.sha256(norm.encode()).hexdigest()
        out += [(i, best[0], len(members), sha) for i, _ in members]
    return sorted(out, key=lambda r: [(x is not None, x) for x in r])


@pytest.mark.parametrize("bits", [64, 3])
def test_groups_match_brute_force(edge_docs, bits):
    # three bits force identifiers that stand for several chunks
    got = rows_of(X.exact_groups(edge_docs, bits=bits), "doc_id", "keep_id", "group_size", "text_sha256")
    assert got == brute([(r[0], r[1]) for r in edge_rows()])


def test_one_row_of_each_group_is_kept(edge_docs, no_docs):
    kept = rows_of(X.exact_groups(edge_docs).where("kept"), "text_sha256")
    assert len(kept) == len(set(kept)) == len({r[3] for r in brute([r[:2] for r in edge_rows()])})
    assert X.exact_groups(no_docs).count() == 0


def test_drop_copies_keeps_columns_and_single_rows(clashing_docs, no_docs):
    out = X.drop_copies(clashing_docs)
    assert out.columns == clashing_docs.columns
    got = rows_of(out, "doc_id", "text")
    norms = [re.sub(r"\s", "", t or "") for _, t in got]
    assert len(norms) == len(set(norms)) == len({re.sub(r"\s", "", r[1] or "") for r in edge_rows()})
    assert (3, prose(1, 60).replace(" ", "\n\t")) in got        # the longest spelling
    assert X.drop_copies(no_docs).count() == 0


def test_chunks_rejoin_and_resynchronise(spark):
    a = "".join(prose(5, 2000).split())
    df = spark.createDataFrame([("x" * 37 + a,), (a,), ("漢" * 9000,)], "norm string") \
        .select("norm", X.chunks(X.F.col("norm")).alias("c"))
    rows = df.collect()
    for r in rows:
        assert "".join(r["c"]) == r["norm"] and max(map(len, r["c"])) <= X.CHUNK_MAX
    assert len(set(rows[0]["c"]) & set(rows[1]["c"])) >= len(rows[1]["c"]) - 4
    assert "Python" not in df._jdf.queryExecution().toString()
