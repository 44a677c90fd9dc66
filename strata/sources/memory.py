"""In-memory rows as a DataFrame (tests and small literal inputs)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DataType, StructType

ARTICLE_SCHEMA = "title string, text string"


def local_relation(spark: SparkSession, rows: Sequence[tuple], schema: str | StructType) -> DataFrame:
    """A small driver-side relation as a ``LocalRelation``.

    Built from an Arrow table, so the plan holds the rows with exact size
    statistics (a broadcast decision can be checked) and no Python worker
    reads them, whatever the session's Arrow setting; a DataFrame over a
    parallelized Python list has neither. The caller bounds the rows.
    """
    struct = DataType.fromDDL(schema) if isinstance(schema, str) else schema
    arrow_schema = to_arrow_schema(struct)
    rows = list(rows)
    columns = [pa.array([r[i] for r in rows], type=field.type)
               for i, field in enumerate(arrow_schema)]
    return spark.createDataFrame(pa.Table.from_arrays(columns, schema=arrow_schema)).to(struct)


def from_rows(spark: SparkSession, rows: Iterable, schema: str) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)


def articles(spark: SparkSession, pairs: Iterable[tuple[str, str]],
             id_col: str | None = "doc_id") -> DataFrame:
    """``(title, text)`` pairs, with a 0-based id in input order."""
    rows = [(i, t, x) for i, (t, x) in enumerate(pairs)]
    df = local_relation(spark, rows, f"{id_col or '_id'} bigint, {ARTICLE_SCHEMA}")
    return df if id_col else df.drop("_id")
