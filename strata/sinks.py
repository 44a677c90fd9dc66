"""Sinks (K1-K4): ranked lists, the cluster report as text, tables, SQL.

Only bounded results reach the driver: a ranking has one row per term,
a report one row per cluster.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.ordering import sort_bounded
from strata.operators.cluster import REPORT_HEADER, report_line
from strata.sources.lines import numbered_lines
from strata.sources.memory import local_relation


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """K1/K3: write any result (ranking, report, grouped table)."""
    df.write.format(fmt).mode(mode).save(path)


def ranking_lines(ranking: DataFrame) -> list[str]:
    """K1: ``(term,count)`` lines as the reference prints them."""
    return [f"({r['term']},{r['n']})" for r in ranking.collect()]


def write_ranking(ranking: DataFrame, path: str) -> None:
    """K1 to a text file: the ranking's lines in order, committed by Spark's writer.

    A ranking has one row per listed term, so it is one file. A write
    replaces what an earlier one left.
    """
    line = F.format_string("(%s,%d)", "term", "n").alias("line")
    sort_bounded(ranking.select(line, "n", "term"), F.desc("n"), F.asc("term")).select("line") \
        .write.mode("overwrite").text(path)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(pos, line)`` of a written ranking or report, in the order of its lines."""
    return numbered_lines(spark, path).select(F.col("position").alias("pos"), F.col("value").alias("line"))


def report_text(report: DataFrame) -> list[str]:
    """K2: header, rule and one formatted line per cluster, in report order."""
    lines = report.select(report_line(), "median_score", "label", "size")
    ordered = sort_bounded(lines, "median_score", "label", "size")
    return list(REPORT_HEADER) + [r["line"] for r in ordered.collect()]


def write_report(report: DataFrame, path: str) -> None:
    """K2 to a text file: the report has one row per cluster (k rows), so it
    is written as one ordered file."""
    spark = report.sparkSession
    header = local_relation(spark, [(i, h) for i, h in enumerate(REPORT_HEADER)],
                            "pos int, line string")
    body = report.select(F.lit(len(REPORT_HEADER)).alias("pos"), "median_score", "label", "size",
                         report_line())
    ordered = header.select("pos", F.lit(None).cast("bigint").alias("median_score"),
                            F.lit(None).cast("string").alias("label"),
                            F.lit(None).cast("bigint").alias("size"), "line") \
        .unionByName(body)
    sort_bounded(ordered, "pos", "median_score", "label", "size").select("line") \
        .write.mode("overwrite").text(path)


def sql_on(df: DataFrame, query: str, name: str = "t") -> DataFrame:
    """K4: run ``query`` with ``{name}`` bound to ``df`` (no global view)."""
    return df.sparkSession.sql(query, **{name: df})
