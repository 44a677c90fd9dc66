"""Wide survey source (CSV with header, no quoting).

The header gives the column names; the first column is a string key, all
others are doubles (minutes). Lines are read as text and each is accounted
for: the first line of every file is its header, any other line is a data
line, however it looks. A data line is parsed whole, whatever columns the
caller selects later.
"""

from __future__ import annotations

import operator
from collections.abc import Iterable, Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType


def header_columns(spark: SparkSession, path: str) -> list[str]:
    """Names from the first line (one small job reading one row)."""
    first = spark.read.text(path).first()
    if first is None:
        raise ValueError(f"no header line in {path}")
    return first["value"].split(",")


def survey_schema(columns: Sequence[str]) -> StructType:
    """First column string, all others double.

    The fields are declared non-null as in the reference, but a file read
    makes every field nullable, so non-null is enforced on the data, not by
    the schema flag.
    """
    columns = list(columns)
    if not columns:
        raise ValueError("no columns")
    if len(set(columns)) != len(columns):
        raise ValueError("duplicate column names in header")
    return StructType([StructField(columns[0], StringType(), False)]
                      + [StructField(c, DoubleType(), False) for c in columns[1:]])


def file_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(value, first, file)``: every line, whether it is the first of its file, and the file.

    A task reads a block of a file in order, so the first line is the first
    row of the block that starts at 0. One pass over Arrow batches; lines are
    handed through unparsed.
    """
    def mark(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None
        for batch in batches:
            files, starts = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            first = []
            for block in zip(files, starts):
                first.append(block != before and block[1] == 0)
                before = block
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(first, pa.bool_()), batch.column(1)],
                                             ["value", "first", "file"])

    lines = spark.read.text(path).select("value", "_metadata.file_path", "_metadata.file_block_start")
    return lines.mapInArrow(mark, "value string, first boolean, file string")


def read_survey(spark: SparkSession, path: str, strict: bool = True):
    """S3 + S5.

    strict -> ``(columns, DataFrame)``: a file whose first line is another
    header, and any data line that does not parse (wrong field count, so also
    a blank line or a header repeated in mid-file; a bad or empty number) fail
    the query, whatever columns it selects.

    lenient -> ``(columns, DataFrame, rejects)``: such lines come back in
    ``rejects`` (``line, file``) instead. Every line is a header, a row or a reject.
    """
    columns = header_columns(spark, path)
    schema = survey_schema(columns)
    header = ",".join(columns)
    lines = file_lines(spark, path).where(~(F.col("first") & (F.col("value") == header)))
    fields = F.split(F.col("value"), ",", -1)
    typed = lines.select(
        F.col("value").alias("_line"), F.col("file").alias("_file"), F.size(fields).alias("_n"),
        F.get(fields, 0).alias(columns[0]),
        *[F.get(fields, i).try_cast("double").alias(c) for i, c in enumerate(columns) if i])
    # a blank line has one empty field: no row, even where the header has one column
    ok = reduce(operator.and_, [F.col(f"`{c}`").isNotNull() for c in schema.names],
                (F.col("_n") == len(columns)) & (F.col("_line") != ""))
    names = [F.col(f"`{c}`") for c in schema.names]
    if strict:
        bad = F.raise_error(F.concat(F.lit("malformed survey line: "), F.substring("_line", 1, 80)))
        return columns, typed.where(F.when(ok, F.lit(True)).otherwise(bad)).select(*names)
    return (columns, typed.where(ok).select(*names),
            typed.where(~ok).select(F.col("_line").alias("line"), F.col("_file").alias("file")))


def write_survey(survey: DataFrame, path: str, files: int | None = None) -> None:
    """Headed files that ``read_survey`` reads back: a string key, all other columns double.

    The format has no quotes: a key with a comma or a line break fails the
    write, as does a null, which no double stands for. Rows are dealt over
    ``files`` files by their key (default: the session's shuffle partitions).
    """
    key, *rest = survey.columns
    if any("," in c for c in survey.columns):
        raise ValueError("a column name holds a comma")
    plain = F.col(f"`{key}`").cast("string")
    ok = F.coalesce(~plain.rlike("[,\n\r]") & (plain != ""), F.lit(False))
    for c in rest:
        ok = ok & F.col(f"`{c}`").isNotNull()
    checked = survey.where(F.when(ok, F.lit(True)).otherwise(
        F.raise_error(F.concat_ws(" ", F.lit("a survey file can't hold the row of"), plain))))
    files = files or int(survey.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    checked.select(plain.alias(key), *[F.col(f"`{c}`").cast("double").alias(c) for c in rest]) \
        .repartition(files, F.col(f"`{key}`")) \
        .write.mode("overwrite").option("header", True).option("quote", "").csv(path)
