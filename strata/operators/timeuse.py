"""Survey time use by life period.

A wide survey table (one string key, all other columns double minutes)
is classified by column name, summed per activity group, labelled, and
averaged per (working, sex, age). Four routes give the same result: DataFrame
API (A13), SQL text (A14), schema-checked rows and a user-defined aggregate (A15).

Scale notes: the summary is one narrow stage (filter, arithmetic, labels);
the grouped result is one partial aggregate over at most 12 keys, so each
task ships at most 12 rows however the respondents are distributed.
"""

from __future__ import annotations

import operator
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from strata.functions.ordering import sort_bounded
from strata.operators.aggregators import Aggregator, Mean, aggregate

# Activity-code prefixes of each group; the first group
# whose list has a prefix of the column name wins, in this order.
PRIMARY_PREFIXES = ("t01", "t03", "t11", "t1801", "t1803")
WORK_PREFIXES = ("t05", "t1805")
OTHER_PREFIXES = ("t02", "t04", "t06", "t07", "t08", "t09", "t10", "t12", "t13",
                  "t14", "t15", "t16", "t18")

# Labels and bounds of the summary columns.
WORKING, NOT_WORKING = "working", "not working"
MALE, FEMALE = "male", "female"
YOUNG, ACTIVE, ELDER = "young", "active", "elder"
MINUTES_PER_HOUR = 60.0

KEYS = ("working", "sex", "age")
MEASURES = ("primaryNeeds", "work", "other")

SUMMARY_SCHEMA = StructType(
    [StructField(k, StringType(), True) for k in KEYS]
    + [StructField(m, DoubleType(), True) for m in MEASURES])


def classify_columns(columns: Sequence[str]) -> tuple[list[str], list[str], list[str]]:
    """``(primary, work, other)`` column names.

    Each list comes out in reverse header order, as the reference builds
    them by prepending; the order fixes the order of addition in P10.
    Columns matching no prefix (``t17...``, non-activity columns) are left out.
    """
    groups: tuple[list[str], list[str], list[str]] = ([], [], [])
    for name in columns:
        for group, prefixes in zip(groups, (PRIMARY_PREFIXES, WORK_PREFIXES, OTHER_PREFIXES)):
            if name.startswith(prefixes):
                group.insert(0, name)
                break
    return groups


def working_status(telfs: Column) -> Column:
    """Code below 3 is "working" (no lower bound, as the reference)."""
    return F.when(telfs < 3, WORKING).otherwise(NOT_WORKING)


def sex_label(tesex: Column) -> Column:
    return F.when(tesex == 1, MALE).otherwise(FEMALE)


def age_band(teage: Column) -> Column:
    """15..22 young, 23..55 active, anything else elder (22.5 too)."""
    return (F.when((teage >= 15) & (teage <= 22), YOUNG)
            .when((teage >= 23) & (teage <= 55), ACTIVE)
            .otherwise(ELDER))


def hours(columns: Sequence[str]) -> Column:
    """P10: ``(((0.0 + c1) + c2) + ...) / 60``; empty group -> 0.0, any null -> null."""
    total = reduce(operator.add, [F.col(c) for c in columns], F.lit(0.0))
    return total / MINUTES_PER_HOUR


def time_use_summary(survey: DataFrame, primary: Sequence[str], work: Sequence[str],
                     other: Sequence[str]) -> DataFrame:
    """One row per respondent in the labour force (``telfs <= 4``).

    The filter is written before the projection, so it reaches the scan.
    """
    return survey.where(F.col("telfs") <= 4).select(
        working_status(F.col("telfs")).alias("working"),
        sex_label(F.col("tesex")).alias("sex"),
        age_band(F.col("teage")).alias("age"),
        hours(primary).alias("primaryNeeds"),
        hours(work).alias("work"),
        hours(other).alias("other"))


def summarize(survey: DataFrame) -> DataFrame:
    """P8 + summary: classify the survey's own header, then summarize."""
    return time_use_summary(survey, *classify_columns(survey.columns))


def time_use_grouped(summary: DataFrame) -> DataFrame:
    """A13 + O2: rounded means per (working, sex, age), sorted by the keys
    (at most 2 x 2 x 3 rows, sorted in one partition)."""
    grouped = summary.groupBy(*KEYS).agg(*[F.round(F.avg(m), 1).alias(m) for m in MEASURES])
    return sort_bounded(grouped, *KEYS)


GROUPED_SQL = """
SELECT working, sex, age,
       ROUND(AVG(primaryNeeds), 1) AS primaryNeeds,
       ROUND(AVG(work), 1) AS work,
       ROUND(AVG(other), 1) AS other
FROM {summed}
GROUP BY working, sex, age
ORDER BY working, sex, age
"""


def time_use_grouped_sql(summary: DataFrame) -> DataFrame:
    """The same aggregate as SQL text.

    The DataFrame is bound as a query parameter, not registered under a
    session-global view name, so concurrent callers cannot collide.
    """
    return summary.sparkSession.sql(GROUPED_SQL, summed=summary)


def time_use_summary_typed(summary: DataFrame) -> DataFrame:
    """The summary as rows of ``SUMMARY_SCHEMA``.

    Columns are looked up by name and cast; a null measure fails the query
    when it is read (the reference's record holds primitive doubles).
    """
    cols = [F.col(k).cast("string").alias(k) for k in KEYS]
    for m in MEASURES:
        v = F.col(m).cast("double")
        cols.append(F.when(v.isNull(), F.raise_error(F.lit(f"null {m} in a summary row")))
                    .otherwise(v).alias(m))
    return summary.select(*cols).to(SUMMARY_SCHEMA)


def time_use_grouped_typed(typed: DataFrame) -> DataFrame:
    """A13 over rows checked against ``SUMMARY_SCHEMA``."""
    if [(f.name, f.dataType) for f in typed.schema.fields] != \
            [(f.name, f.dataType) for f in SUMMARY_SCHEMA.fields]:
        typed = time_use_summary_typed(typed)
    return time_use_grouped(typed)


def time_use_grouped_aggregated(typed: DataFrame, mean: type[Aggregator] = Mean) -> DataFrame:
    """A15 as a user-defined aggregate: means in user code over typed rows.

    Each task ships at most one state per (working, sex, age), as in the
    built-in form, so neither the rows nor a dominant group reach one worker.
    """
    if [(f.name, f.dataType) for f in typed.schema.fields] != \
            [(f.name, f.dataType) for f in SUMMARY_SCHEMA.fields]:
        typed = time_use_summary_typed(typed)
    means = aggregate(typed, KEYS, {m: mean(m) for m in MEASURES})
    return sort_bounded(means.select(*KEYS, *[F.round(m, 1).alias(m) for m in MEASURES]), *KEYS)
