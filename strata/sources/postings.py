"""Postings source, comma-separated lines without quoting.

Fields: posting type, id, accepted answer (may be empty), parent id (may
be empty), score, tags (may be missing). Parsing is column expressions
over ``spark.read.text``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.sources.lines import numbered_lines

POSTING_SCHEMA = ("posting_type int, id int, accepted_answer int, parent_id int, "
                  "score int, tags string")


def _fields(value: str, id_type: str):
    f = F.split(F.col(value), ",", -1)
    raw = [F.get(f, i) for i in range(5)]
    # The reference splits like Java's String.split: trailing empty fields
    # vanish, so a tag exists only if some field from the sixth on is non-empty.
    rest = F.array_join(F.slice(f, 6, F.greatest(F.size(f) - 5, F.lit(1))), "")
    tags = F.when((F.size(f) >= 6) & (rest != ""), F.get(f, 5))
    ints = {
        "posting_type": F.col("_f0").try_cast("int"),
        "id": F.col("_f1").try_cast(id_type),
        "accepted_answer": F.nullif(F.col("_f2"), F.lit("")).try_cast(id_type),
        "parent_id": F.nullif(F.col("_f3"), F.lit("")).try_cast(id_type),
        "score": F.col("_f4").try_cast("int"),
    }
    return f, raw, tags, ints


def parse_postings(lines: DataFrame, value: str = "value", strict: bool = True, id_type: str = "int",
                   keep: Sequence[str] = ()):
    """Lines -> postings, with the columns ``keep`` of ``lines``.

    strict: a line with fewer than five fields or a bad integer fails the
    query (as the reference's parser). lenient: ``(postings, rejects)``.
    ``id_type``: of the three id fields.
    """
    f, raw, tags, ints = _fields(value, id_type)
    keep = list(keep)
    staged = lines.select(F.col(value), *keep, F.size(f).alias("_n"),
                          *[r.alias(f"_f{i}") for i, r in enumerate(raw)],
                          tags.alias("tags"))
    typed = staged.select(value, *keep, "_n", "_f2", "_f3", "tags",
                          *[e.alias(k) for k, e in ints.items()])
    ok = ((F.col("_n") >= 5) & F.col("posting_type").isNotNull() & F.col("id").isNotNull()
          & F.col("score").isNotNull()
          & ((F.col("_f2") == "") | F.col("accepted_answer").isNotNull())
          & ((F.col("_f3") == "") | F.col("parent_id").isNotNull()))
    cols = ["posting_type", "id", "accepted_answer", "parent_id", "score", "tags", *keep]
    if strict:
        # a filter, not a column: the check runs whatever columns are selected
        bad = F.raise_error(F.concat(F.lit("malformed posting line: "), F.col(value)))
        return typed.where(F.when(ok, F.lit(True)).otherwise(bad)).select(*cols)
    return typed.where(ok).select(*cols), typed.where(~ok).select(F.col(value).alias("line"), *keep)


def read_postings(spark: SparkSession, path: str | Sequence[str], strict: bool = True,
                  id_type: str = "int", located: bool = False):
    """Postings of text files; ``located`` adds ``file`` and ``at`` (line number, from 0), to the
    rejects as well."""
    if not located:
        return parse_postings(spark.read.text(path), strict=strict, id_type=id_type)
    lines = numbered_lines(spark, path).withColumnRenamed("line", "at")
    return parse_postings(lines, strict=strict, id_type=id_type, keep=("file", "at"))


def posting_lines(postings: DataFrame) -> DataFrame:
    """``(value)``: six unquoted fields per posting, null as an empty field.

    The format has no quotes, so a tag with a comma or a line break, and an
    empty one (it would read as none), fail the query.
    """
    bad = F.col("tags").rlike("[,\n\r]") | (F.col("tags") == "")
    tags = F.when(F.coalesce(bad, F.lit(False)), F.raise_error(F.concat(
        F.lit("a postings file can't hold the tag: "), F.col("tags")))).otherwise(F.col("tags"))
    fields = [F.col(c).cast("string") for c in ("posting_type", "id", "accepted_answer", "parent_id", "score")]
    return postings.select(F.array_join(F.array(*fields, tags), ",", "").alias("value"))


def write_postings(postings: DataFrame, path: str) -> None:
    posting_lines(postings).write.mode("overwrite").text(path)
