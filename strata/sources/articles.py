"""Article source, one article per line of text files.

Line layout: a fixed-length prefix, the title, the separator
``</title><text>``, the text, a fixed-length suffix. Parsing is two column
expressions on ``spark.read.text``. Articles written by ``write_articles`` may
hold line breaks, nulls and the separator itself: these are escaped, and
``escaped=True`` reads them back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.sources.lines import escaped as escape
from strata.sources.lines import numbered_lines, unescaped

# Fixed values of the line layout.
TITLE_TEXT_SEPARATOR = "</title><text>"
PREFIX_LENGTH = 14
SUFFIX_LENGTH = 16
# What this library writes in their place.
PREFIX, SUFFIX = "<page> <title>", "</text>  </page>"


def _parts(value: str = "value"):
    """(ok, title, text) columns; positions are 1-based as in Spark SQL."""
    v = f"`{value}`"
    pos = f"instr({v}, '{TITLE_TEXT_SEPARATOR}')"          # 0 when absent
    text_start = f"({pos} + {len(TITLE_TEXT_SEPARATOR)})"
    text_len = f"(length({v}) - {SUFFIX_LENGTH} - {text_start} + 1)"
    ok = F.expr(f"{pos} > {PREFIX_LENGTH} AND {text_len} >= 0")
    title = F.expr(f"substring({v}, {PREFIX_LENGTH + 1}, {pos} - {PREFIX_LENGTH + 1})")
    text = F.expr(f"substring({v}, {text_start}, {text_len})")
    return ok, title, text


def parse_articles(lines: DataFrame, value: str = "value", strict: bool = True,
                   escaped: bool = False, keep: Sequence[str] = ()):
    """Lines -> ``(title, text, *keep)``.

    strict: a malformed line (no separator, too short) fails the query, as
    in the reference. lenient: returns ``(articles, rejects)`` where
    ``rejects`` holds the malformed lines. ``keep``: other columns of
    ``lines`` that go along.
    """
    ok, title, text = _parts(value)
    if escaped:
        title, text = unescaped(title), unescaped(text)
    keep = list(keep)
    if strict:
        # a filter, not a column: the check runs whatever columns are selected
        bad = F.raise_error(F.concat(F.lit("malformed article line: "),
                                     F.substring(F.col(value), 1, 80)))
        return lines.where(F.when(ok, F.lit(True)).otherwise(bad)) \
            .select(title.alias("title"), text.alias("text"), *keep)
    good = lines.where(ok).select(title.alias("title"), text.alias("text"), *keep)
    rejects = lines.where(~ok).select(F.col(value).alias("line"), *keep)
    return good, rejects


def read_articles(spark: SparkSession, path: str | Sequence[str], strict: bool = True,
                  id_col: str | None = None, escaped: bool = False, located: bool = False):
    """Read article files.

    ``id_col`` adds the line's position over all files in the order of their
    names: 0, 1, ... by file and line, whatever the splits. It holds as long as
    the files do; ids that outlive them are written with the articles
    (``store_articles``). ``located`` adds ``file`` and ``at`` (line number in
    the file, from 0), to the rejects as well.
    """
    if not (id_col or located):
        return parse_articles(spark.read.text(path), strict=strict, escaped=escaped)
    lines = numbered_lines(spark, path).withColumnRenamed("line", "at")
    keep = (["file", "at"] if located else []) + ([id_col] if id_col else [])
    if id_col:
        lines = lines.withColumnRenamed("position", id_col)
    parsed = parse_articles(lines, strict=strict, escaped=escaped, keep=keep)
    return parsed


def article_lines(articles: DataFrame, title: str = "title", text: str = "text") -> DataFrame:
    """``(value)``: one line per article, whatever its title and text hold."""
    part = lambda c: escape(F.col(f"`{c}`").cast("string"))
    return articles.select(F.concat(F.lit(PREFIX), part(title), F.lit(TITLE_TEXT_SEPARATOR),
                                    part(text), F.lit(SUFFIX)).alias("value"))


def write_articles(articles: DataFrame, path: str, title: str = "title", text: str = "text") -> None:
    """Text files that ``read_articles(..., escaped=True)`` reads back as they were."""
    article_lines(articles, title, text).write.mode("overwrite").text(path)


def store_articles(articles: DataFrame, path: str, id_col: str = "doc_id") -> DataFrame:
    """Appends ``articles`` to a Parquet table with ids assigned once, and returns the whole table.

    An article keeps its id from then on: later appends number on from the
    largest id, and reading the table under other splits changes nothing.
    """
    spark = articles.sparkSession
    try:
        start = spark.read.parquet(path).agg(F.coalesce(F.max(id_col) + 1, F.lit(0))).first()[0]
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        start = 0
    articles.withColumn(id_col, F.monotonically_increasing_id() + F.lit(start)) \
        .write.mode("append").parquet(path)
    return spark.read.parquet(path)
