"""The date dimension, and the retail fiscal calendar derived from it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from veritally.functions import calendar as cal
from veritally.operators.spine import date_spine


def describe_days(days: DataFrame, day: str = "date_day", week: str = "sunday") -> DataFrame:
    """The 37 calendar columns for every date in column ``day``."""
    number = "iso" if week == "iso" else "sunday"
    dates = days.select(F.col(day).cast("date").alias("date_day")).select(
        "date_day",
        F.add_months("date_day", -12).alias("prior_year_date_day"),
        F.date_sub("date_day", 364).alias("prior_year_over_year_date_day"),
    )
    prior, over = F.col("prior_year_date_day"), F.col("prior_year_over_year_date_day")
    date = F.col("date_day")
    quarter_start = F.trunc(date, "quarter")
    year_start = F.trunc(date, "year")
    return dates.select(
        date,
        cal.yesterday(date).alias("prior_date_day"),
        cal.tomorrow(date).alias("next_date_day"),
        prior,
        over,
        cal.day_of_week(date, isoweek=False).alias("day_of_week"),
        cal.day_of_week(date, isoweek=True).alias("day_of_week_iso"),
        cal.day_name(date, short=False).alias("day_of_week_name"),
        cal.day_name(date, short=True).alias("day_of_week_name_short"),
        cal.day_of_month(date).alias("day_of_month"),
        cal.day_of_year(date).alias("day_of_year"),
        cal.week_start(date, week).alias("week_start_date"),
        cal.week_end(date, week).alias("week_end_date"),
        cal.week_start(over, week).alias("prior_year_week_start_date"),
        cal.week_end(over, week).alias("prior_year_week_end_date"),
        cal.week_of_year(date, number).alias("week_of_year"),
        cal.iso_week_start(date).alias("iso_week_start_date"),
        cal.iso_week_end(date).alias("iso_week_end_date"),
        cal.iso_week_start(over).alias("prior_year_iso_week_start_date"),
        cal.iso_week_end(over).alias("prior_year_iso_week_end_date"),
        cal.iso_week_of_year(date).alias("iso_week_of_year"),
        cal.iso_year_week(date).alias("iso_year_week"),
        cal.week_of_year(over, number).alias("prior_year_week_of_year"),
        cal.iso_week_of_year(over).alias("prior_year_iso_week_of_year"),
        F.month(date).alias("month_of_year"),
        cal.month_name(date, short=False).alias("month_name"),
        cal.month_name(date, short=True).alias("month_name_short"),
        F.trunc(date, "month").alias("month_start_date"),
        F.last_day(date).alias("month_end_date"),
        F.trunc(prior, "month").alias("prior_year_month_start_date"),
        F.last_day(prior).alias("prior_year_month_end_date"),
        F.quarter(date).alias("quarter_of_year"),
        quarter_start.alias("quarter_start_date"),
        F.last_day(F.add_months(quarter_start, 2)).alias("quarter_end_date"),
        F.year(date).alias("year_number"),
        year_start.alias("year_start_date"),
        F.last_day(F.add_months(year_start, 11)).alias("year_end_date"),
    )


def date_dimension(spark: SparkSession, start, end, week: str = "sunday") -> DataFrame:
    """One row per day from ``start`` up to, not including, ``end``."""
    return describe_days(date_spine(spark, "day", start, end), week=week)


def _days_of(ranges: DataFrame, start: str, end: str, day: str = "date_day") -> DataFrame:
    """Each range once per day it covers, which turns a range join into a join on the day."""
    return ranges.withColumn(day, F.explode(F.sequence(F.col(start), F.col(end))))


def fiscal_year_ends(
    dates: DataFrame, year_end_month: int = 12, week_start_day: int = 1, shift_year: int = 1
) -> DataFrame:
    """Per fiscal year, the week end closest to the end of ``year_end_month`` and the year's start.

    The first year has no start, because the end of the year before it is unknown.
    """
    closing = dates.filter(F.col("month_of_year") == year_end_month).withColumn(
        "fiscal_year_number", F.col("year_number") - shift_year
    )
    month_ends = closing.select("fiscal_year_number", "month_end_date").distinct()
    week_ends = closing.filter(F.col("day_of_week") == week_start_day).select(
        "fiscal_year_number", F.date_add("date_day", 6).alias("week_end_date")
    )
    distance = F.abs(F.date_diff("month_end_date", "week_end_date"))
    by_distance = W.partitionBy("fiscal_year_number").orderBy(distance)
    closest = (
        week_ends.distinct()
        .join(month_ends, "fiscal_year_number")
        .withColumn("closest_to_month_end", F.rank().over(by_distance))
        .filter(F.col("closest_to_month_end") == 1)
    )
    # One row per year, so one task for this window is enough.
    previous_end = F.lag("week_end_date").over(W.orderBy("week_end_date"))
    return closest.select(
        "fiscal_year_number",
        F.date_add(previous_end, 1).alias("fiscal_year_start_date"),
        F.col("week_end_date").alias("fiscal_year_end_date"),
    )


def fiscal_year_dates(
    dates: DataFrame, year_end_month: int = 12, week_start_day: int = 1, shift_year: int = 1
) -> DataFrame:
    """Every date with its fiscal year, week and week number inside the fiscal year."""
    years = fiscal_year_ends(dates, year_end_month, week_start_day, shift_year)
    weeks = dates.filter(F.col("day_of_week") == week_start_day).select(
        F.col("date_day").alias("week_start_date"), F.date_add("date_day", 6).alias("week_end_date")
    )
    by_week = W.partitionBy("fiscal_year_number").orderBy("week_start_date")
    in_years = _days_of(
        years.filter(F.col("fiscal_year_start_date").isNotNull()),
        "fiscal_year_start_date",
        "fiscal_year_end_date",
    )
    return (
        dates.select("date_day")
        .join(in_years, "date_day")
        .join(_days_of(weeks, "week_start_date", "week_end_date"), "date_day")
        .select(
            "date_day",
            "fiscal_year_number",
            "fiscal_year_start_date",
            "fiscal_year_end_date",
            "week_start_date",
            "week_end_date",
            F.dense_rank().over(by_week).alias("fiscal_week_of_year"),
        )
    )


def fiscal_periods(
    dates: DataFrame, year_end_month: int, week_start_day: int, shift_year: int = 1
) -> DataFrame:
    """The 4-5-4 calendar: quarters of 13 weeks in periods of 4, 5 and 4; week 53 joins the last."""
    week = F.col("fiscal_week_of_year")
    in_quarter = (week - 1) % 13
    quarter = F.least(F.floor((week - 1) / 13), F.lit(3)).cast("int")
    period = F.when(week == 53, 3).when(in_quarter < 4, 1).when(in_quarter < 9, 2).otherwise(3)
    numbered = fiscal_year_dates(dates, year_end_month, week_start_day, shift_year).select(
        "date_day",
        "fiscal_year_number",
        "week_start_date",
        "week_end_date",
        "fiscal_week_of_year",
        (quarter * 3 + period).alias("fiscal_period_number"),
        (quarter + 1).alias("fiscal_quarter_number"),
        period.alias("fiscal_period_of_quarter"),
    )
    by_week = W.partitionBy("fiscal_period_number").orderBy("fiscal_week_of_year")
    return numbered.select(
        "date_day",
        "fiscal_year_number",
        "week_start_date",
        "week_end_date",
        "fiscal_week_of_year",
        F.dense_rank().over(by_week).alias("fiscal_week_of_period"),
        "fiscal_period_number",
        "fiscal_quarter_number",
        "fiscal_period_of_quarter",
    )


def dim_date(
    dates: DataFrame, year_end_month: int = 1, week_start_day: int = 1, shift_year: int = 1
) -> DataFrame:
    """The date dimension with fiscal columns; days outside a whole fiscal year have none."""
    fiscal = fiscal_periods(dates, year_end_month, week_start_day, shift_year).select(
        "date_day",
        "fiscal_week_of_year",
        "fiscal_week_of_period",
        "fiscal_period_number",
        "fiscal_quarter_number",
        "fiscal_period_of_quarter",
    )
    return dates.join(fiscal, "date_day", "left")
