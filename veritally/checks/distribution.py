"""Checks on how values spread over groups and time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from veritally.checks.kernel import _as_list, register, select_rows
from veritally.functions import calendar as cal
from veritally.functions.scalar import metric_value
from veritally.operators.spine import explode_periods


@register
def expect_column_values_to_be_within_n_stdevs(
    df: DataFrame, column_name: str, group_by: Sequence[str] | None = None, sigma_threshold: float = 3
) -> DataFrame:
    """Groups whose sum lies further from the mean of the sums than so many deviations.

    Without groups there is a single sum without deviation, which always passes. The mean and the
    deviation are computed once and read as scalars; no row is moved for them.
    """
    keys = _as_list(group_by)
    sums = df.groupBy(*keys).agg(F.sum(F.expr(column_name)).alias(column_name))
    average, deviation = f"{column_name}_average", f"{column_name}_stddev"
    stats = sums.agg(F.avg(column_name).alias("a"), F.stddev_samp(column_name).alias("s"))
    both = stats.select(F.struct("a", "s").alias("stats"))
    scored = (
        sums.withColumn("__stats", both.scalar())
        .withColumn(average, F.col("__stats.a"))
        .withColumn(deviation, F.col("__stats.s"))
        .drop("__stats")
    )
    distance = F.col(column_name) - F.col(average)
    sigma = distance / F.nullif(F.col(deviation), F.lit(0.0))
    return scored.withColumn(f"{column_name}_sigma", sigma).filter(
        F.abs(F.col(f"{column_name}_sigma")) > sigma_threshold
    )


def _without_groups(df, column_name=None, group_by=None, **_) -> bool:
    return not group_by


# Whether a pass says nothing about the data; shown in the report of a suite.
expect_column_values_to_be_within_n_stdevs.vacuous = _without_groups


@register
def expect_column_values_to_be_within_n_moving_stdevs(
    df: DataFrame,
    column_name: str,
    date_column_name: str,
    group_by: Sequence[str] | None = None,
    period: str = "day",
    lookback_periods: int = 1,
    trend_periods: int = 7,
    test_periods: int = 14,
    sigma_threshold: float = 3,
    sigma_threshold_upper: float | None = None,
    sigma_threshold_lower: float | None = None,
    take_diffs: bool = True,
    take_logs: bool = True,
    tz: str | None = None,
    as_of=None,
) -> DataFrame:
    """Recent periods whose sum, or its change, leaves the band of the periods before them.

    The windows run over one row per period and group, so their size follows the calendar and not
    the table. Periods without a deviation before them pass.
    """
    keys = _as_list(group_by)
    upper = sigma_threshold_upper or sigma_threshold
    lower = sigma_threshold_lower or -sigma_threshold
    in_period = cal.date_trunc(period, F.expr(date_column_name)).alias("metric_period")
    by_period = W.partitionBy(*keys).orderBy("metric_period")
    before = by_period.rowsBetween(-trend_periods, -1)
    metrics = df.groupBy(in_period, *keys).agg(F.sum(F.expr(column_name)).alias("agg_metric_value"))
    value = metric_value("agg_metric_value", take_logs)
    if take_diffs:
        metrics = metrics.withColumn(
            "prior_agg_metric_value", F.lag("agg_metric_value", lookback_periods).over(by_period)
        )
        value = value - metric_value("prior_agg_metric_value", take_logs)
    calcs = metrics.withColumn("metric_test_value", value).withColumns(
        {
            "metric_test_rolling_average": F.avg("metric_test_value").over(before),
            "metric_test_rolling_stddev": F.stddev_samp("metric_test_value").over(before),
        }
    )
    delta = F.col("metric_test_value") - F.col("metric_test_rolling_average")
    sigma = delta / F.nullif(F.col("metric_test_rolling_stddev"), F.lit(0.0))
    current = cal.date_trunc(period, cal.now(tz, as_of))
    tested = (F.col("metric_period") >= cal.add_periods(current, -test_periods, period)) & (
        F.col("metric_period") < current
    )
    return (
        calcs.withColumns({"metric_test_delta": delta, "metric_test_sigma": sigma})
        .filter(tested)
        .filter(~((F.col("metric_test_sigma") >= lower) & (F.col("metric_test_sigma") <= upper)))
    )


@register
def expect_row_values_to_have_data_for_every_n_datepart(
    df: DataFrame,
    date_col: str,
    date_part: str = "day",
    interval: int | None = None,
    row_condition: str | None = None,
    exclusion_condition: str | None = None,
    test_start_date: str | None = None,
    test_end_date: str | None = None,
    align: bool = False,
) -> DataFrame:
    """Periods without any row, from the first date up to, not including, the last one.

    With ``interval`` periods are taken n at a time from the start. The spine starts on
    the first date itself, which need not be the start of a week or month; ``align`` moves it there.
    """
    name = f"date_{date_part}"
    stamp = F.expr(date_col).cast("timestamp_ntz")
    # One row per period is all that is read twice: for the bounds and for the comparison.
    filled = (
        select_rows(df, row_condition)
        .groupBy(cal.date_trunc(date_part, stamp).alias("__period"))
        .agg(
            F.count(F.lit(1)).alias("__rows"),
            F.min(stamp.cast("date")).alias("__first"),
            F.max(stamp.cast("date")).alias("__last"),
        )
    )

    def bound(given, found):
        return F.lit(str(given)).cast("date") if given else found

    bounds = filled.agg(
        bound(test_start_date, F.min("__first")).cast("timestamp_ntz").alias("__start"),
        bound(test_end_date, F.max("__last")).cast("timestamp_ntz").alias("__end"),
    )
    first = cal.date_trunc(date_part, "__start") if align else F.col("__start")
    bounds = bounds.select(first.alias("__start"), "__end")
    spine = explode_periods(bounds, "__start", "__end", date_part, name)
    period = F.col("__period")
    if interval:
        offset = cal.periods_between("__start", name, date_part)
        spine = spine.filter(offset % interval == 0)
        start = bounds.select("__start").scalar()
        behind = (cal.periods_between(start, period, date_part) % interval).cast("int")
        period = cal.add_periods(period, -behind, date_part)
    filled = filled.groupBy(period.alias("__bucket")).agg(F.sum("__rows").alias("__rows"))
    compared = spine.join(filled, F.col(name) == F.col("__bucket"), "left").select(
        name,
        F.col("__bucket").isNull().alias("is_missing"),
        F.coalesce("__rows", F.lit(0)).alias("row_cnt"),
    )
    missing = compared.filter(F.col("row_cnt") == 0)
    return missing.filter(F.expr(exclusion_condition)) if exclusion_condition else missing
