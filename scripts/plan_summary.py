"""Summarize the physical plan of every registered query (PLANS.md).

    python scripts/plan_summary.py [--sf-dir DIR] > PLANS.md

Per query: scans with their read schema and pushed filters, the number of
shuffles, join strategies, aggregate kinds, and any Python evaluation.
Iterative queries run their loop while being built; their plan is the
final (result) query. A second table has the plans with broadcasts off, as
they are when both sides of a join are beyond the threshold.
"""

from __future__ import annotations

import argparse
import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from strata.config import local_session  # noqa: E402
from strata.plans.queries import QUERIES  # noqa: E402
from strata.plans.roundtrips import QUERIES as FILE_QUERIES  # noqa: E402


def formatted(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def summarize(text: str) -> dict:
    tree = text.split("\n\n")[0]
    scans = re.findall(r"Location: InMemoryFileIndex \[file:[^\]]*/([a-z]+)(?:\.parquet|-[0-9a-f]+[/a-z]*)\]\n"
                       r"(?:PartitionFilters: \[.*?\]\n)?(?:PushedFilters: (\[.*?\])\n)?"
                       r"ReadSchema: (struct<.*?>)", text)
    joins = re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin"
                       r"|CartesianProduct)", tree)
    named = [f"{t}: {schema}" + (f" pushed {pf if len(pf) < 200 else pf[:160] + '...'}" if pf else "")
             for t, pf, schema in scans]
    if "Scan ExistingRDD" in tree:
        named.append("checkpointed points")
    if "LocalTableScan" in tree:
        named.append("driver rows (bounded list)")
    return {
        "scans": named,
        "exchanges": tree.count("Exchange") - tree.count("BroadcastExchange"),
        "broadcasts": tree.count("BroadcastExchange"),
        "joins": sorted(set(joins)),
        "aggregates": sorted(set(re.findall(r"(HashAggregate|ObjectHashAggregate|SortAggregate)", tree))),
        "window_limit": "WindowGroupLimit" in tree,
        "top_k": "TakeOrderedAndProject" in tree,
        "python": any(n in text for n in ("BatchEvalPython", "ArrowEvalPython", "InPandas", "MapInArrow")),
    }


def table(spark, sf_dir: str) -> None:
    print("| query | scans (read schema, pushed filters) | shuffles | broadcasts | joins | "
          "aggregates | other |")
    print("| --- | --- | --- | --- | --- | --- | --- |")
    for name, query in (QUERIES | FILE_QUERIES).items():
        s = summarize(formatted(query(spark, sf_dir)))
        other = [x for x, on in (("WindowGroupLimit", s["window_limit"]),
                                 ("top-k", s["top_k"]), ("Arrow batches", s["python"])) if on]
        print(f"| {name} | {'<br>'.join(s['scans'])} | {s['exchanges']} | "
              f"{s['broadcasts']} | {', '.join(s['joins']) or '-'} | "
              f"{', '.join(s['aggregates']) or '-'} | {', '.join(other) or '-'} |")


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.01")
    args = ap.parse_args()
    spark = local_session(cores=8, shuffle_partitions=16)
    print("# Physical plans of the registered queries\n")
    print(f"Generated by `scripts/plan_summary.py` on `{args.sf_dir}` (initial adaptive plans; "
          "AQE may later coalesce partitions, switch a join to broadcast from runtime sizes, "
          "or split skewed partitions). The corpus operators' plans depend on their data; the "
          "README has their measured figures.\n")
    table(spark, args.sf_dir)
    for key in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        spark.conf.set(key, "-1")
    print("\n## With broadcasts off\n")
    print("Two shuffles of a side are the price of a map-side collapse: `best_answer` first "
          "merges copies of a question row, then moves it by id; `nested_answers` first counts "
          "copies of an answer row, then collects its block.\n")
    table(spark, args.sf_dir)
    spark.stop()


if __name__ == "__main__":
    main()
