"""Wide time-use survey: column classification, recoding, row-wise sums, group averages.

Scale notes: the summary is a narrow projection (the filter on ``telfs`` is pushed below it and
into the parquet scan), and the three grouped forms are one hash aggregate on three low-
cardinality keys with partial aggregation, then a one-partition sort of at most 12 rows.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.functions import col, quote_identifier, round_half_up, sort_bounded

# Fixed values of the activity classification (column-name prefixes).
PRIMARY_PREFIXES = ("t01", "t03", "t11", "t1801", "t1803")
WORK_PREFIXES = ("t05", "t1805")
OTHER_PREFIXES = ("t02", "t04", "t06", "t07", "t08", "t09", "t10", "t12", "t13", "t14", "t15", "t16", "t18")

GROUP_KEYS = ("working", "sex", "age")
MEASURES = ("primaryNeeds", "work", "other")

SUMMARY_SCHEMA = T.StructType([
    T.StructField("working", T.StringType()),
    T.StructField("sex", T.StringType()),
    T.StructField("age", T.StringType()),
    T.StructField("primaryNeeds", T.DoubleType()),
    T.StructField("work", T.DoubleType()),
    T.StructField("other", T.DoubleType()),
])


def classify_columns(names: Sequence[str]) -> tuple[list[str], list[str], list[str]]:
    """Split column names into primary-needs, work and other activity groups.

    Names already classified as primary or work are removed before the "other" test, so the
    longer prefixes (t1801, t1803, t1805) win over t18.  Input order is kept; names matching
    no prefix (t17.., t50.., metadata) belong to no group.
    """
    names = list(names)
    primary = [n for n in names if n.startswith(PRIMARY_PREFIXES)]
    work = [n for n in names if n.startswith(WORK_PREFIXES)]
    taken = set(primary) | set(work)
    other = [n for n in names if n not in taken and n.startswith(OTHER_PREFIXES)]
    return primary, work, other


def working_status(telfs: Column) -> Column:
    """P6: 'working' when 1 <= telfs < 3."""
    return F.when((telfs < 3) & (telfs >= 1), F.lit("working")).otherwise(F.lit("not working"))


def sex_label(tesex: Column) -> Column:
    """P7: 'male' when tesex = 1, else 'female'."""
    return F.when(tesex == 1, F.lit("male")).otherwise(F.lit("female"))


def age_band(teage: Column) -> Column:
    """Young 15-22, active 23-55 (closed ranges), elder otherwise."""
    return (F.when((teage <= 22) & (teage >= 15), F.lit("young"))
            .when((teage <= 55) & (teage >= 23), F.lit("active"))
            .otherwise(F.lit("elder")))


def hours(columns: Sequence[str | Column], group: str) -> Column:
    """Row-wise sum of the group's minute columns, in hours."""
    cols = [col(c) for c in columns]
    if not cols:
        raise ValueError(f"activity group {group!r} has no columns")
    return functools.reduce(operator.add, cols) / F.lit(60)


def time_usage_summary(df: DataFrame, primary: Sequence[str | Column], work: Sequence[str | Column],
                       other: Sequence[str | Column]) -> DataFrame:
    """Per respondent in the labour force (telfs != 5): working, sex, age and hours per group."""
    return (df.where(F.col("telfs") != 5)
            .select(working_status(F.col("telfs")).alias("working"),
                    sex_label(F.col("tesex")).alias("sex"),
                    age_band(F.col("teage")).alias("age"),
                    hours(primary, "primary").alias("primaryNeeds"),
                    hours(work, "work").alias("work"),
                    hours(other, "other").alias("other")))


def summary_from_frame(df: DataFrame) -> DataFrame:
    """Classify ``df.columns`` and summarise in one call."""
    primary, work, other = classify_columns(df.columns)
    return time_usage_summary(df, primary, work, other)


def time_usage_typed(summary: DataFrame) -> DataFrame:
    """The summary pinned to ``SUMMARY_SCHEMA`` (names, types, order), checked."""
    missing = [f.name for f in SUMMARY_SCHEMA.fields if f.name not in summary.columns]
    if missing:
        raise ValueError(f"summary lacks columns {missing}")
    out = summary.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in SUMMARY_SCHEMA.fields])
    got = [(f.name, f.dataType) for f in out.schema.fields]
    want = [(f.name, f.dataType) for f in SUMMARY_SCHEMA.fields]
    if got != want:
        raise TypeError(f"typed summary schema {got} != {want}")
    return out


def time_usage_grouped(summary: DataFrame) -> DataFrame:
    """Average hours per (working, sex, age), rounded HALF_UP to 1 decimal, sorted."""
    grouped = summary.groupBy(*GROUP_KEYS).agg(*[F.round(F.avg(m), 1).alias(m) for m in MEASURES])
    return sort_bounded(grouped, *GROUP_KEYS)  # at most 2 x 2 x 3 groups


def grouped_sql_query(view_name: str) -> str:
    """The SQL text of the grouped average over a view."""
    return ("SELECT working, sex, age, round(avg(primaryNeeds), 1) AS primaryNeeds, "
            "round(avg(work), 1) AS work, round(avg(other), 1) AS other "
            f"FROM {quote_identifier(view_name)} GROUP BY working, sex, age ORDER BY working, sex, age")


def time_usage_grouped_sql(summary: DataFrame, view_name: str = "summed") -> DataFrame:
    """Register ``summary`` as a temp view (replacing it) and run the SQL form."""
    summary.createOrReplaceTempView(view_name)
    return summary.sparkSession.sql(grouped_sql_query(view_name))


def time_usage_grouped_typed(typed: DataFrame) -> DataFrame:
    """Averages rounded half toward +infinity (floor(v*10+0.5)/10), schema pinned."""
    grouped = typed.groupBy(*GROUP_KEYS).agg(*[round_half_up(F.avg(m), 1).alias(m) for m in MEASURES])
    return time_usage_typed(sort_bounded(grouped, *GROUP_KEYS))
