"""Checks on the shape of a table: its columns, its row counts, how recent it is."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritally.checks.kernel import (
    _as_list,
    aggregate_check,
    between,
    equal_expression,
    register,
    select_rows,
)
from veritally.functions import calendar as cal

EPOCH = "1970-01-01 00:00:00"


def _fold(names: Sequence[str], transform: str) -> list[str]:
    if transform not in ("upper", "lower", "none"):
        raise ValueError(f"transform must be 'upper', 'lower' or 'none', got {transform!r}")
    return [n if transform == "none" else getattr(n, transform)() for n in names]


def _rows(df: DataFrame, rows: list[tuple], schema: str) -> DataFrame:
    """Findings about the columns of ``df``, which are known without reading it."""
    return df.sparkSession.createDataFrame(rows, schema)


@register
def expect_column_to_exist(
    df: DataFrame, column_name: str, column_index: int | None = None, transform: str = "upper"
) -> DataFrame:
    """The column is there, at the 1-based index if one is given (0 counts as none)."""
    names = _fold(df.columns, transform)
    (wanted,) = _fold([column_name], transform)
    found = names.index(wanted) if wanted in names else -1
    in_place = not column_index or found == max(column_index - 1, 0)
    bad = [] if found >= 0 and in_place else [(wanted, found, in_place)]
    schema = "column_name STRING, matching_column_index INT, column_index_matches BOOLEAN"
    return _rows(df, bad, schema)


@register
def expect_table_column_count_to_equal(df: DataFrame, value: int) -> DataFrame:
    n = len(df.columns)
    return _rows(df, [] if n == value else [(n, value)], "number_actual_columns INT, value INT")


@register
def expect_table_column_count_to_be_between(
    df: DataFrame, min_value: int | None = None, max_value: int | None = None
) -> DataFrame:
    """The number of columns lies within the bounds; a bound of 0 counts as none."""
    if min_value is None and max_value is None:
        raise ValueError("give a min_value, a max_value or both")
    n = len(df.columns)
    ok = (not min_value or n >= min_value) and (not max_value or n <= max_value)
    bad = [] if ok else [(n, min_value or 0, max_value or 0)]
    return _rows(df, bad, "number_actual_columns INT, min_value INT, max_value INT")


@register
def expect_table_column_count_to_equal_other_table(df: DataFrame, compare_model: DataFrame) -> DataFrame:
    mine, other = len(df.columns), len(compare_model.columns)
    bad = [] if mine == other else [(mine, other)]
    return _rows(df, bad, "number_columns INT, compare_number_columns INT")


@register
def expect_table_columns_to_contain_set(
    df: DataFrame, column_list: Sequence[str], transform: str = "upper"
) -> DataFrame:
    names = _fold(df.columns, transform)
    bad = [(c, None) for c in _fold(column_list, transform) if c not in names]
    return _rows(df, bad, "input_column STRING, relation_column STRING")


@register
def expect_table_columns_to_not_contain_set(
    df: DataFrame, column_list: Sequence[str], transform: str = "upper"
) -> DataFrame:
    names = _fold(df.columns, transform)
    bad = [(c, c) for c in _fold(column_list, transform) if c in names]
    return _rows(df, bad, "input_column STRING, relation_column STRING")


@register
def expect_table_columns_to_match_set(
    df: DataFrame, column_list: Sequence[str], transform: str = "upper"
) -> DataFrame:
    """Names on one side only."""
    names, wanted = _fold(df.columns, transform), _fold(column_list, transform)
    bad = [(c, None) for c in names if c not in wanted]
    bad += [(None, c) for c in wanted if c not in names]
    return _rows(df, bad, "relation_column STRING, input_column STRING")


@register
def expect_table_columns_to_match_ordered_list(
    df: DataFrame, column_list: Sequence[str], transform: str = "upper"
) -> DataFrame:
    """Names that are not on both sides at the same position."""
    names = list(enumerate(_fold(df.columns, transform), start=1))
    wanted = list(enumerate(_fold(column_list, transform), start=1))
    bad = [(i, c, None, None) for i, c in names if (i, c) not in wanted]
    bad += [(None, None, i, c) for i, c in wanted if (i, c) not in names]
    schema = "relation_column_idx INT, relation_column STRING, input_column_idx INT, input_column STRING"
    return _rows(df, bad, schema)


@aggregate_check
def expect_table_row_count_to_equal(value: int):
    return F.count(F.lit(1)) == value


@aggregate_check
def expect_table_row_count_to_be_between(min_value=None, max_value=None, strictly: bool = False):
    return between(F.count(F.lit(1)), min_value, max_value, strictly)


@register
def expect_table_row_count_to_equal_other_table(
    df: DataFrame,
    compare_model: DataFrame,
    group_by: Sequence[str] | None = None,
    compare_group_by: Sequence[str] | None = None,
    factor: float = 1,
    row_condition: str | None = None,
    compare_row_condition: str | None = None,
) -> DataFrame:
    """Row counts equal to those of the other table times ``factor``, per group if given."""
    return equal_expression(
        df,
        "count(*)",
        compare_model,
        f"count(*) * {factor}",
        group_by,
        compare_group_by,
        row_condition,
        compare_row_condition,
    )


@register
def expect_table_row_count_to_equal_other_table_times_factor(
    df: DataFrame,
    compare_model: DataFrame,
    factor: float,
    group_by: Sequence[str] | None = None,
    compare_group_by: Sequence[str] | None = None,
    row_condition: str | None = None,
    compare_row_condition: str | None = None,
) -> DataFrame:
    return expect_table_row_count_to_equal_other_table(
        df, compare_model, group_by, compare_group_by, factor, row_condition, compare_row_condition
    )


@register
def expect_table_aggregation_to_equal_other_table(
    df: DataFrame,
    expression: str,
    compare_model: DataFrame,
    compare_expression: str | None = None,
    group_by: Sequence[str] | None = None,
    compare_group_by: Sequence[str] | None = None,
    row_condition: str | None = None,
    compare_row_condition: str | None = None,
    tolerance: float = 0.0,
    tolerance_percent: float | None = None,
) -> DataFrame:
    return equal_expression(
        df,
        expression,
        compare_model,
        compare_expression,
        group_by,
        compare_group_by,
        row_condition,
        compare_row_condition,
        tolerance,
        tolerance_percent,
    )


def _past_rows(df, timestamp: str, row_condition, tz, as_of) -> tuple:
    """Rows not later than the present, and the present."""
    present = cal.now(tz, as_of)
    stamp = F.expr(timestamp).cast("timestamp_ntz")
    return select_rows(df, row_condition).filter(stamp <= present), stamp, present


@register
def expect_row_values_to_have_recent_data(
    df: DataFrame,
    column_name: str,
    datepart: str,
    interval: int,
    row_condition: str | None = None,
    tz: str | None = None,
    as_of=None,
) -> DataFrame:
    """The latest timestamp that is not in the future is no older than the interval.

    Without any row the epoch stands for the latest, so an empty table fails.
    """
    rows, stamp, present = _past_rows(df, column_name, row_condition, tz, as_of)
    latest = rows.agg(F.max(stamp).alias("max_timestamp"))
    cutoff = cal.add_periods(present, -int(interval), datepart)
    known = F.coalesce(F.col("max_timestamp"), F.lit(EPOCH).cast("timestamp_ntz"))
    return latest.filter(known < cutoff)


@register
def expect_grouped_row_values_to_have_recent_data(
    df: DataFrame,
    group_by: Sequence[str] | None,
    timestamp_column: str,
    datepart: str,
    interval: int,
    row_condition: str | None = None,
    tz: str | None = None,
    as_of=None,
) -> DataFrame:
    """Groups whose latest timestamp is older than the interval; an input without rows passes."""
    rows, stamp, present = _past_rows(df, timestamp_column, row_condition, tz, as_of)
    keys = _as_list(group_by)
    latest = rows.groupBy(*keys).agg(F.max(stamp).alias("latest_timestamp_column"))
    cutoff = cal.add_periods(present, -int(interval), datepart)
    outdated = latest.filter(F.col("latest_timestamp_column") < cutoff)
    return outdated.select(F.lit(1).cast("bigint").alias("row_count"), *keys, "latest_timestamp_column")


def _no_past_rows(df, group_by=None, timestamp_column=None, datepart=None, interval=None,
                  row_condition=None, tz=None, as_of=None):
    rows, _, _ = _past_rows(df, timestamp_column, row_condition, tz, as_of)
    return rows.agg(F.count(F.lit(1))).scalar() == 0


# Whether a pass says nothing about the data; shown in the report of a suite.
expect_grouped_row_values_to_have_recent_data.vacuous = _no_past_rows
