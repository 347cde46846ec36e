"""Checks on aggregates of one column, over the table or per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veritally.checks.keyed import Keyed, distinct_count
from veritally.checks.kernel import (
    _as_list,
    aggregate_check,
    between,
    equal_expression,
    operand,
    register,
    select_rows,
)
from veritally.checks.values import _values, outside_set, set_frame
from veritally.operators.quantile import percentile_by


def _distinct(column_name: str) -> Column:
    return F.count_distinct(F.expr(column_name))


@aggregate_check(fusible=False)
def expect_column_distinct_count_to_equal(column_name: str, value: int) -> Column:
    return _distinct(column_name) == operand(value)


expect_column_distinct_count_to_equal.keyed = lambda column_name, value: Keyed(
    F.expr(column_name), distinct_count(lambda n: n == operand(value))
)


@aggregate_check(fusible=False)
def expect_column_distinct_count_to_be_greater_than(column_name: str, value: int) -> Column:
    return _distinct(column_name) > operand(value)


expect_column_distinct_count_to_be_greater_than.keyed = lambda column_name, value: Keyed(
    F.expr(column_name), distinct_count(lambda n: n > operand(value))
)


@aggregate_check(fusible=False)
def expect_column_distinct_count_to_be_less_than(column_name: str, value: int) -> Column:
    return _distinct(column_name) < operand(value)


expect_column_distinct_count_to_be_less_than.keyed = lambda column_name, value: Keyed(
    F.expr(column_name), distinct_count(lambda n: n < operand(value))
)


@register
def expect_column_distinct_count_to_equal_other_table(
    df: DataFrame,
    column_name: str,
    compare_model: DataFrame | None = None,
    compare_column_name: str | None = None,
    row_condition: str | None = None,
    compare_row_condition: str | None = None,
) -> DataFrame:
    return equal_expression(
        df,
        f"count(distinct {column_name})",
        compare_model,
        f"count(distinct {compare_column_name or column_name})",
        row_condition=row_condition,
        compare_row_condition=compare_row_condition,
    )


@register
def expect_column_distinct_values_to_be_in_set(
    df: DataFrame,
    column_name: str,
    value_set: Sequence,
    quote_values: bool = True,
    row_condition: str | None = None,
) -> DataFrame:
    """Distinct values outside the set, null included."""
    values = _values(df, column_name, row_condition).distinct()
    return outside_set(values, value_set, quote_values)


@register
def expect_column_distinct_values_to_contain_set(
    df: DataFrame,
    column_name: str,
    value_set: Sequence,
    quote_values: bool = True,
    row_condition: str | None = None,
) -> DataFrame:
    """Members of the set that the column never takes."""
    # Only the values that are members matter, so the rows shrink to the set before they move.
    members = set_frame(df.sparkSession, value_set, quote_values).distinct()
    wanted = members.withColumnRenamed("value_field", "member")
    values = _values(df, column_name, row_condition)
    values = values.join(wanted, F.col("value_field") == F.col("member"), "left_semi").distinct()
    values = values.withColumnRenamed("value_field", "found")
    return members.join(values, F.col("value_field") == F.col("found"), "left_anti")


@register
def expect_column_distinct_values_to_equal_set(
    df: DataFrame,
    column_name: str,
    value_set: Sequence,
    quote_values: bool = True,
    row_condition: str | None = None,
) -> DataFrame:
    """Distinct values and members without a partner on the other side."""
    values = _values(df, column_name, row_condition).distinct()
    values = values.withColumnRenamed("value_field", "column_value")
    members = set_frame(df.sparkSession, value_set, quote_values).distinct()
    paired = values.join(members, F.col("column_value") == F.col("value_field"), "full")
    return paired.filter(F.col("column_value").isNull() | F.col("value_field").isNull())


@aggregate_check(skips_nulls=True)
def expect_column_max_to_be_between(
    column_name: str, min_value=None, max_value=None, strictly: bool = False
) -> Column:
    return between(F.max(F.expr(column_name)), min_value, max_value, strictly)


@aggregate_check(skips_nulls=True)
def expect_column_min_to_be_between(
    column_name: str, min_value=None, max_value=None, strictly: bool = False
) -> Column:
    return between(F.min(F.expr(column_name)), min_value, max_value, strictly)


@aggregate_check(skips_nulls=True)
def expect_column_mean_to_be_between(
    column_name: str, min_value=None, max_value=None, strictly: bool = False
) -> Column:
    return between(F.avg(F.expr(column_name)), min_value, max_value, strictly)


@aggregate_check(skips_nulls=True)
def expect_column_sum_to_be_between(
    column_name: str, min_value=None, max_value=None, strictly: bool = False
) -> Column:
    return between(F.sum(F.expr(column_name)), min_value, max_value, strictly)


@aggregate_check(skips_nulls=True)
def expect_column_stdev_to_be_between(
    column_name: str, min_value=None, max_value=None, strictly: bool = False
) -> Column:
    """Sample standard deviation; null, and so passing, for a single row."""
    return between(F.stddev_samp(F.expr(column_name)), min_value, max_value, strictly)


@aggregate_check(fusible=False)
def expect_column_unique_value_count_to_be_between(
    column_name: str, min_value=None, max_value=None, strictly: bool = False
) -> Column:
    return between(_distinct(column_name), min_value, max_value, strictly)


expect_column_unique_value_count_to_be_between.keyed = lambda column_name, **bounds: Keyed(
    F.expr(column_name), distinct_count(lambda n: between(n, **bounds))
)


@aggregate_check(fusible=False)
def expect_column_proportion_of_unique_values_to_be_between(
    column_name: str, min_value=None, max_value=None, strictly: bool = False
) -> Column:
    """Distinct values over values; 1 where there are none."""
    n = F.count(F.expr(column_name))
    share = F.when(n == 0, 1.0).otherwise(_distinct(column_name).cast("double") / F.nullif(n, F.lit(0)))
    return between(share, min_value, max_value, strictly)


@register
def expect_column_quantile_values_to_be_between(
    df: DataFrame,
    column_name: str,
    quantile: float,
    min_value=None,
    max_value=None,
    group_by: Sequence[str] | None = None,
    row_condition: str | None = None,
    strictly: bool = False,
    whole_groups: bool = False,
) -> DataFrame:
    """The interpolated quantile within its bounds, exact at any size."""
    groups = _as_list(group_by)
    names = [f"col_{i}" for i in range(1, len(groups) + 1)]
    rows = select_rows(df, row_condition).select(
        *[F.expr(g).alias(n) for g, n in zip(groups, names, strict=True)],
        F.expr(column_name).alias("__column"),
    )
    found = percentile_by(rows, "__column", quantile, names, "__q", whole_groups)
    outcome = between(F.col("__q"), min_value, max_value, strictly)
    return found.select(*names, outcome.alias("expression")).filter(~F.col("expression"))


@register
def expect_column_median_to_be_between(
    df: DataFrame,
    column_name: str,
    min_value=None,
    max_value=None,
    group_by: Sequence[str] | None = None,
    row_condition: str | None = None,
    strictly: bool = False,
    whole_groups: bool = False,
) -> DataFrame:
    return expect_column_quantile_values_to_be_between(
        df, column_name, 0.5, min_value, max_value, group_by, row_condition, strictly, whole_groups
    )


def ranked_value(df: DataFrame, rank: int, row_condition: str | None = None) -> DataFrame:
    """The ``value_field`` that is the ``rank``-th most frequent; ties go to the smaller value."""
    counts = select_rows(df, row_condition).groupBy("value_field").agg(F.count(F.lit(1)).alias("n"))
    top = counts.orderBy(F.desc("n"), F.asc("value_field")).limit(rank)
    # The last of the top ranks is the wanted one; it is absent if there are fewer values.
    last = F.max_by("value_field", F.struct(-F.col("n"), F.col("value_field")))
    found = top.agg(last.alias("value_field"), F.count(F.lit(1)).alias("ranks"))
    return found.filter(F.col("ranks") == rank).select("value_field")


@register
def expect_column_most_common_value_to_be_in_set(
    df: DataFrame,
    column_name: str,
    value_set: Sequence,
    top_n: int,
    quote_values: bool = True,
    data_type: str = "decimal",
    row_condition: str | None = None,
) -> DataFrame:
    """The ``top_n``-th most frequent value, if it is not in the set.

    Unquoted values are compared as ``data_type``. As with SQL's NOT IN, a null passes.
    """
    value = F.expr(column_name)
    if not quote_values:
        value = value.cast(data_type)
    rows = select_rows(df, row_condition).select(value.alias("value_field"))
    members = [F.lit(str(v)) if quote_values else F.expr(str(v)) for v in value_set]
    if not quote_values:
        members = [m.cast(data_type) for m in members]
    return ranked_value(rows, top_n).filter(~F.col("value_field").isin(*members))
