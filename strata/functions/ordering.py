"""Ordering of small, parameter-bounded results, and id blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType


def sort_bounded(df: DataFrame, *cols: str | Column) -> DataFrame:
    """Global order for a result whose size is bounded by a parameter
    (one row per listed term, per cluster, per label combination).

    One exchange into a single partition satisfies the sort, so no
    range-partition sampling job runs. Data-sized results use ``orderBy``.
    """
    return df.repartition(1).orderBy(*cols)


def id_block(df: DataFrame, id_col: str, block_size: int) -> Column:
    """Block number of an integral id: ``floor(id / block_size)``, exact.

    With unique ids a block holds at most ``block_size`` of them, so lists
    grouped per (key, block) stay bounded however large a key is.
    """
    if block_size <= 0:
        raise ValueError("block_size must be positive")
    if not isinstance(df.schema[id_col].dataType, IntegralType):
        raise ValueError(f"{id_col} must be an integral id to cut blocks, "
                         f"not {df.schema[id_col].dataType.simpleString()}")
    b = int(block_size)
    return F.expr(f"(`{id_col}` - pmod(`{id_col}`, {b})) div {b}")
