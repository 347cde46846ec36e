"""Unbroken runs of periods and numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veritally.functions import calendar as cal


# Periods numbered by one array.
BLOCK = 10_000


def _timestamp(value) -> Column:
    return value if isinstance(value, Column) else F.lit(str(value)).cast("timestamp_ntz")


def explode_periods(
    df: DataFrame, start: str, end: str, part: str, alias: str, week: str = "sunday"
) -> DataFrame:
    """Each row of ``df`` once per period from its ``start``, its ``end`` excluded.

    Rows without any period disappear. Periods are numbered in blocks, so that no row ever holds
    an array as long as the spine.
    """
    count = cal.periods_between(start, end, part, week)
    blocks = df.withColumn("__count", count).filter(F.col("__count") > 0)
    last_block = F.floor((F.col("__count") - 1) / BLOCK)
    blocks = blocks.withColumn("__block", F.explode(F.sequence(F.lit(0).cast("bigint"), last_block)))
    first = F.col("__block") * BLOCK
    numbers = F.sequence(first, F.least(first + BLOCK, F.col("__count")) - 1)
    numbered = blocks.withColumn("__number", F.explode(numbers))
    period = cal.add_periods(start, F.col("__number").cast("int"), part)
    spine = numbered.withColumn(alias, period).filter(F.col(alias) <= F.col(end))
    return spine.drop("__count", "__block", "__number")


def date_spine(spark: SparkSession, part: str, start, end, week: str = "sunday") -> DataFrame:
    """One row per period, in column ``date_<part>``; the end is excluded.

    ``start`` and ``end`` are timestamps as text, or one-row scalar columns.
    """
    bounds = spark.range(1).select(_timestamp(start).alias("__start"), _timestamp(end).alias("__end"))
    name = f"date_{part}"
    return explode_periods(bounds, "__start", "__end", part, name, week).select(name)


def base_dates(
    spark: SparkSession,
    start_date=None,
    end_date=None,
    n_dateparts: int | None = None,
    datepart: str = "day",
    tz: str | None = None,
    as_of=None,
) -> DataFrame:
    """A spine between two dates, or over the ``n_dateparts`` periods up to tomorrow."""
    if start_date is not None and end_date is not None:
        return date_spine(spark, datepart, start_date, end_date)
    if not n_dateparts:
        raise ValueError("give start_date and end_date, or n_dateparts")
    start = cal.add_periods(cal.today(tz, as_of), -n_dateparts, datepart)
    end = cal.tomorrow(None, tz, as_of).cast("timestamp_ntz")
    return date_spine(spark, datepart, start, end)


def generate_series(spark: SparkSession, upper_bound: int) -> DataFrame:
    """The numbers 1 to ``upper_bound``, made in parallel."""
    if upper_bound <= 0:
        raise ValueError(f"a series ends at 1 or later, got {upper_bound}")
    return spark.range(1, upper_bound + 1).withColumnRenamed("id", "generated_number")


def random_series(
    spine: DataFrame, groups: int, rows: int, seed: int | None = None, value: str = "row_value"
) -> DataFrame:
    """``rows`` random values per period and group, with their natural logarithms."""
    numbered = spine.select(
        "*", F.explode(F.sequence(F.lit(1), F.lit(groups))).alias("group_id")
    ).select("*", F.explode(F.sequence(F.lit(1), F.lit(rows))).alias("__row"))
    drawn = numbered.drop("__row").withColumn(value, F.rand(seed))
    return drawn.withColumn(f"{value}_log", F.ln(F.nullif(F.col(value), F.lit(0.0))))
