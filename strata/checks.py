"""Data-quality checks and dataset pinning (A16, S4 non-null, P13 schema, K5).

Counts are taken by a job of their own or, with ``Observed``, on the job that
uses the data.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


class DataCheckError(AssertionError):
    """A data-level expectation failed."""


def expect_count(df: DataFrame, expected: int, what: str = "rows") -> int:
    """Fail when ``df`` does not hold exactly ``expected`` rows."""
    n = df.count()
    if n != expected:
        raise DataCheckError(f"{expected} {what} expected, {n} found")
    return n


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> dict[str, int]:
    """Nulls per column, all columns in one aggregate pass."""
    cols = list(columns or df.columns)
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols]).first()
    return {c: int(row[c]) for c in cols}


def check_not_null(df: DataFrame, columns: Sequence[str] | None = None) -> None:
    """The reference's schemas are non-null; fail on any null."""
    bad = {c: n for c, n in null_counts(df, columns).items() if n}
    if bad:
        raise DataCheckError(f"null values in non-null columns: {bad}")


def guard_not_null(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Lazy form of ``check_not_null``: the query fails when it reads a row
    with a null in one of ``columns``. It is a filter, so it holds whatever
    columns the caller selects later, at no extra pass over the data."""
    cols = list(columns or df.columns)
    if not cols:
        return df
    first_null = F.coalesce(*[F.when(F.col(c).isNull(), F.lit(c)) for c in cols])
    return df.where(F.when(first_null.isNull(), F.lit(True)).otherwise(
        F.raise_error(F.concat(F.lit("null value in non-null column "), first_null))))


class Observed:
    """A16 and S4 on the job that uses the data: rows and nulls counted as they pass.

    ``df`` is the input with the counters in it. After an action over ``df``
    has run (a write, a checkpoint, a collect), ``verify`` reads the counters
    and raises where they miss what was expected; no pass of its own is made.

    Every row of ``df`` must pass, so no limit may stand above it. Where a lost
    executor makes Spark run tasks again, rows may be counted twice; a
    count that misses is therefore taken once more from the data before
    ``verify`` raises.
    """

    def __init__(self, df: DataFrame, rows: int | None = None, not_null: Sequence[str] = (),
                 what: str = "rows"):
        self._source, self._rows, self._what = df, rows, what
        self._columns = list(not_null)
        self._observation = Observation()
        self.df = df.observe(
            self._observation, F.count(F.lit(1)).alias("rows"),
            *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"null_{i}") for i, c in enumerate(self._columns)])

    def counts(self) -> tuple[int, dict[str, int]]:
        """``(rows, nulls per column)`` of the action that has run."""
        got = self._observation.get
        return int(got["rows"]), {c: int(got[f"null_{i}"]) for i, c in enumerate(self._columns)}

    def verify(self) -> int:
        n, nulls = self.counts()
        if self._rows is not None and n != self._rows:
            n = expect_count(self._source, self._rows, self._what)
        if any(nulls.values()):
            check_not_null(self._source, self._columns)
        return n


def check_schema(df: DataFrame, schema: StructType) -> None:
    """Names and types must equal ``schema`` (nullability is not compared:
    file sources make every field nullable)."""
    got = [(f.name, f.dataType) for f in df.schema.fields]
    want = [(f.name, f.dataType) for f in schema.fields]
    if got != want:
        raise DataCheckError(f"schema mismatch: {got} != {want}")


@contextmanager
def persisted(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> Iterator[DataFrame]:
    """K5: pin ``df`` for the block and release it afterwards.

    A lost executor loses only cached blocks; they are recomputed from
    lineage. For data that must survive without recomputation use
    ``strata.operators.cluster.reliable`` (a reliable checkpoint).
    """
    df.persist(level)
    try:
        yield df
    finally:
        df.unpersist()
