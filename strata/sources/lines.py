"""Lines of text files with their place: file and line number, whatever the splits.

Tasks number the lines of their blocks; the lines of earlier blocks are
counted by a second, value-free read and summed up over one row per block. The
numbers depend on the files alone, not on how Spark divides them.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.config import ensure_checkpoint_dir, find_package

# Up to this many blocks their line counts are sent to every task (some 40 MB
# at most); more are joined, and then the lines move.
SENT_BLOCKS = 1 << 18
# Codes of what a line can't hold as it is; every backslash in
# an escaped text begins one of them.
ESCAPES = (("\\", "\\s"), ("\n", "\\n"), ("\r", "\\r"), ("<", "\\l"))
NULL_CODE = "\\0"


def escaped(text: Column) -> Column:
    """``text`` in one line, without ``<``; null has a code of its own."""
    for raw, code in ESCAPES:
        text = F.replace(text, F.lit(raw), F.lit(code))
    return F.coalesce(text, F.lit(NULL_CODE))


def unescaped(text: Column) -> Column:
    """The text that ``escaped`` was given."""
    out = text
    for raw, code in reversed(ESCAPES[1:]):
        out = F.replace(out, F.lit(code), F.lit(raw))
    raw, code = ESCAPES[0]      # last: what it gives back begins no code
    return F.when(text != NULL_CODE, F.replace(out, F.lit(code), F.lit(raw)))


def mark_blocks(files: pa.Array, starts: np.ndarray) -> np.ndarray:
    """Where in a batch a block of a file begins that the row before is not in."""
    codes = files.dictionary_encode().indices.to_numpy()
    return np.flatnonzero((np.diff(codes) != 0) | (np.diff(starts) != 0)) + 1


def _in_blocks(lines: DataFrame) -> DataFrame:
    """``(value, file, block, i)``: every line with its number within its block, from 0."""
    find = mark_blocks

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, passed = None, 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            starts = batch.column(2).to_numpy()
            edges = [0, *find(batch.column(1), starts).tolist(), n]
            if (batch.column(1)[0].as_py(), int(starts[0])) != here:
                passed = 0
            i = np.arange(n, dtype=np.int64)
            i[:edges[1]] += passed
            for a, b in zip(edges[1:-1], edges[2:]):
                i[a:b] -= a
            here, passed = (batch.column(1)[n - 1].as_py(), int(starts[-1])), int(i[-1]) + 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(i)], ["value", "file", "block", "i"])

    return lines.mapInArrow(run, "value string, file string, block bigint, i bigint")


def numbered_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """``(value, file, line, position)``: line number within its file, and over all files by name.

    Both count from 0 without gaps. The lines of the blocks are counted when
    this is called (and kept in the checkpoint folder), so the files must not
    change until the result has been read.
    """
    ensure_checkpoint_dir(spark)
    find_package(spark)
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"),
                                         F.col("_metadata.file_block_start").alias("block"))
    sizes = lines.groupBy("file", "block").agg(F.count(F.lit(1)).alias("n"))
    # one row per block: as many as the read has tasks, or a few times that
    in_file = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    in_all = Window.orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)
    none = F.lit(0).cast("bigint")
    before = sizes.select("file", "block", F.coalesce(F.sum("n").over(in_file), none).alias("own"),
                          F.coalesce(F.sum("n").over(in_all), none).alias("all")).checkpoint(eager=True)
    if before.count() <= SENT_BLOCKS:
        before = F.broadcast(before)
    return _in_blocks(lines).join(before, ["file", "block"]).select(
        "value", "file", (F.col("own") + F.col("i")).alias("line"), (F.col("all") + F.col("i")).alias("position"))


def file_name(path: Column) -> Column:
    """The last part of a file's path."""
    return F.element_at(F.split(path, "/"), -1)
