"""Checks on several columns together."""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veritally.checks.kernel import (
    aggregate_check,
    failing,
    operand,
    register,
    row_check,
    select_rows,
)
from veritally.functions.scalar import any_of, keep_row, md5_text


@row_check
def expect_column_pair_values_A_to_be_greater_than_B(
    column_A: str, column_B: str, or_equal: bool = False
) -> Column:
    a, b = F.expr(column_A), F.expr(column_B)
    return a >= b if or_equal else a > b


@row_check
def expect_column_pair_values_to_be_equal(column_A: str, column_B: str) -> Column:
    return F.expr(column_A) == F.expr(column_B)


def _plain(member):
    """A member as a plain value, or None: a quoted text, a number or a flag; any other text is an expression."""
    if not isinstance(member, str):
        return member if isinstance(member, bool | int | float) else None
    inner = member[1:-1]
    quoted = len(member) > 1 and member[0] == member[-1] == "'" and not {"'", "\\"} & set(inner)
    return inner if quoted else None


def _kind(values: Sequence) -> str | None:
    """The one Spark type of plain values, whole numbers counting as such among fractions, too."""
    kinds = {type(v) for v in values}
    if kinds == {int, float}:
        return "double"
    names = {str: "string", int: "bigint", float: "double", bool: "boolean"}
    return names.get(kinds.pop()) if len(kinds) == 1 else None


def pair_frame(spark: SparkSession, pairs: Sequence[Sequence]) -> DataFrame | None:
    """The pairs as columns x and y, if all members are plain values; they travel as one literal."""
    plain = [[_plain(m) for m in pair] for pair in pairs]
    if not plain or any(m is None for pair in plain for m in pair):
        return None
    x, y = (_kind([pair[i] for pair in plain]) for i in (0, 1))
    if x is None or y is None:
        return None
    kind = f"array<struct<x:{x},y:{y}>>"
    made = F.from_json(F.lit(json.dumps([{"x": a, "y": b} for a, b in plain])), kind)
    return spark.range(1).select(F.inline(made))


@register
def expect_column_pair_values_to_be_in_set(
    df: DataFrame,
    column_A: str,
    column_B: str,
    value_pairs_set: Sequence[Sequence],
    row_condition: str | None = None,
    carry: Sequence[str] = (),
) -> DataFrame:
    """The pair is one of the set; text members are SQL expressions, so quote text values.

    Rows are joined to the pairs. As in SQL a missing value may be any: such a row fails only if
    the value beside it is in no pair. Pairs of expressions, or of several types in one place,
    are compared one by one.
    """
    wrong = [p for p in value_pairs_set if len(p) != 2]
    if wrong:
        raise ValueError(f"every element of value_pairs_set must have 2 items, got {wrong[0]!r}")
    a, b = F.expr(column_A), F.expr(column_B)
    pairs = pair_frame(df.sparkSession, value_pairs_set)
    if pairs is None:
        holds = any_of([(a == operand(x)) & (b == operand(y)) for x, y in value_pairs_set])
        return failing(df, holds, None, row_condition, carry)
    rows = select_rows(df, row_condition).select(*carry, a.alias("__a"), b.alias("__b"))
    x, y = F.col("x"), F.col("y")
    has_a, has_b = F.col("__a").isNotNull(), F.col("__b").isNotNull()
    whole = rows.filter(has_a & has_b).join(pairs, (F.col("__a") == x) & (F.col("__b") == y), "left_anti")
    only_a = rows.filter(has_a & ~has_b).join(pairs.select("x"), F.col("__a") == x, "left_anti")
    only_b = rows.filter(~has_a & has_b).join(pairs.select("y"), F.col("__b") == y, "left_anti")
    outside = whole.unionByName(only_a).unionByName(only_b)
    return outside.select(*carry, F.lit(False).alias("expression"))


def _columns(column_list: Sequence[str], quote_columns: bool) -> list[Column]:
    if not column_list:
        raise ValueError("column_list must name at least one column")
    return [F.col(f"`{c}`") if quote_columns else F.expr(c) for c in column_list]


@register
def expect_compound_columns_to_be_unique(
    df: DataFrame,
    column_list: Sequence[str],
    quote_columns: bool = False,
    ignore_row_if: str = "all_values_are_missing",
    row_condition: str | None = None,
) -> DataFrame:
    """Value combinations that occur more than once, with their number of records."""
    columns = _columns(column_list, quote_columns)
    rows = select_rows(df, row_condition).filter(keep_row(ignore_row_if, columns))
    named = [c.alias(n) for c, n in zip(columns, column_list, strict=True)]
    counted = rows.groupBy(*named).agg(F.count(F.lit(1)).alias("n_records"))
    return counted.filter(F.col("n_records") > 1)


@aggregate_check
def expect_multicolumn_sum_to_equal(column_list: Sequence[str], sum_total) -> Column:
    """The sums of the columns add up to a number, or to the sum of another column."""
    total = reduce(lambda a, b: a + b, [F.sum(F.expr(c)) for c in column_list])
    is_number = isinstance(sum_total, int | float)
    return total == (F.lit(sum_total) if is_number else F.sum(F.expr(str(sum_total))))


@register
def expect_select_column_values_to_be_unique_within_record(
    df: DataFrame,
    column_list: Sequence[str],
    quote_columns: bool = False,
    ignore_row_if: str = "all_values_are_missing",
    row_condition: str | None = None,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Rows in which the columns do not all have values of their own, with how many differ.

    A missing value is not a value, so it fails its row unless such rows are ignored. The test
    needs nothing but the row, so no data moves.
    """
    columns = _columns(column_list, quote_columns)
    rows = select_rows(df, row_condition).filter(keep_row(ignore_row_if, columns))
    distinct = F.size(F.array_distinct(F.array_compact(F.array(*[md5_text(c) for c in columns]))))
    tested = rows.select(*carry, distinct.alias("column_values"))
    return tested.filter(F.col("column_values") < len(columns))
