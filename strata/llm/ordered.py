"""Order within keys that may hold any share of the rows.

Rows are range-partitioned by key and order and sorted, so a key of very many
rows lies in several neighbouring partitions, its *blocks*. Whatever needs the
rows before a row is put together from one partition's rows and one row per
block; no key is collected anywhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import saved

_BLOCK = 33     # bits of a row's number within its partition


def in_order(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """``rows`` written once in the order of ``(keys, order)``, numbered by ``row``.

    ``row`` ascends in that order and is dense within a partition; ``block`` is
    the partition. Rows that tie in every order column stand in one partition.
    """
    by = [*[F.col(k).asc() for k in keys], *order]
    return saved(rows.repartitionByRange(*by).sortWithinPartitions(*by)
                 .withColumn("row", F.monotonically_increasing_id())
                 .withColumn("block", F.shiftrightunsigned("row", _BLOCK)))


def _offsets(blocks: DataFrame, keys: list[str], sums: list[str]) -> DataFrame:
    """Of every block but a key's first: what the blocks before it sum up to (``b_<name>``)."""
    before = Window.partitionBy(*keys).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return blocks.select(*keys, "block", *[F.sum(s).over(before).alias(f"b_{s}") for s in sums]) \
        .where(F.col(f"b_{sums[0]}").isNotNull())


def positions(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``in_order`` with ``pos``: 1, 2, ... within their key."""
    blocks = rows.groupBy(*keys, "block").agg(F.min("row").alias("low"),
                                              F.count(F.lit(1)).alias("k"))
    before = Window.partitionBy(*keys).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    first = blocks.select(*keys, "block", "low",
                          F.coalesce(F.sum("k").over(before), F.lit(0)).alias("passed"))
    # a block and key name at most one partition's rows: nothing hot to split
    return rows.join(first, [*keys, "block"]).withColumn(
        "pos", F.col("row") - F.col("low") + 1 + F.col("passed")).drop("low", "passed")


def running(rows: DataFrame, keys: list[str], order: str, sums: list[str]) -> DataFrame:
    """``rows`` with ``r_<name>``: the sum of each column over the key's rows up to this one.

    ``block`` must ascend with ``order`` within a key and hold a bounded number of its rows.
    """
    upto = Window.partitionBy(*keys, "block").orderBy(order) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    blocks = rows.groupBy(*keys, "block").agg(*[F.sum(s).alias(s) for s in sums])
    within = rows.select("*", *[F.sum(s).over(upto).alias(f"r_{s}") for s in sums])
    out = within.join(_offsets(blocks, keys, sums), [*keys, "block"], "left")
    return out.select(*rows.columns, *[
        (F.col(f"r_{s}") + F.coalesce(f"b_{s}", F.lit(0))).alias(f"r_{s}") for s in sums])
