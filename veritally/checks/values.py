"""Checks on the values of one column: missing, unique, typed, in a set, in a range, in order."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veritally.checks.keyed import Keyed, outside, repeated
from veritally.checks.kernel import _as_list, between, register, row_check, select_rows
from veritally.checks.multicolumn import expect_compound_columns_to_be_unique
from veritally.operators.ordered import (
    SORT,
    VALUE,
    neighbour_violations,
)

# Other names by which the types of Spark are known.
TYPE_NAMES = {
    "STRING": ("VARCHAR", "TEXT"),
    "TINYINT": ("BYTE",),
    "SMALLINT": ("SHORT", "INT2", "INT16"),
    "INT": ("INTEGER", "INT4", "INT32"),
    "BIGINT": ("LONG", "INT64", "INT8"),
    "FLOAT": ("REAL", "FLOAT32"),
    "DOUBLE": ("FLOAT64", "DOUBLE PRECISION"),
    "BOOLEAN": ("BOOL",),
    "TIMESTAMP": ("TIMESTAMP_LTZ", "TIMESTAMP WITH TIME ZONE"),
    "DECIMAL": ("NUMERIC", "DEC"),
    "TIMESTAMP_NTZ": ("DATETIME", "TIMESTAMP WITHOUT TIME ZONE"),
}


@register
def expect_column_values_to_be_unique(
    df: DataFrame, column_name: str, row_condition: str | None = None
) -> DataFrame:
    return expect_compound_columns_to_be_unique(df, [column_name], row_condition=row_condition)


expect_column_values_to_be_unique.keyed = lambda column_name: Keyed(F.expr(column_name), repeated)


@row_check
def expect_column_values_to_not_be_null(column_name: str) -> Column:
    return F.expr(column_name).isNotNull()


@row_check
def expect_column_values_to_be_null(column_name: str) -> Column:
    return F.expr(column_name).isNull()


@register
def expect_column_values_to_be_in_type_list(
    df: DataFrame, column_name: str, column_type_list: Sequence[str]
) -> DataFrame:
    """The column has one of the types, by Spark's name or a common other one. No column passes."""
    wanted = {t.upper() for t in column_type_list}
    bad = []
    for field in df.schema:
        name = field.dataType.simpleString().upper()
        names = {name, name.split("(")[0], *TYPE_NAMES.get(name.split("(")[0], ())}
        if field.name.upper() == column_name.upper() and not names & wanted:
            bad.append((field.name.upper(), name))
    schema = "relation_column STRING, relation_column_type STRING"
    return df.sparkSession.createDataFrame(bad, schema)


def _column_absent(df: DataFrame, column_name: str, **_) -> bool:
    return column_name.upper() not in [c.upper() for c in df.columns]


expect_column_values_to_be_in_type_list.vacuous = _column_absent


@register
def expect_column_values_to_be_of_type(df: DataFrame, column_name: str, column_type: str) -> DataFrame:
    return expect_column_values_to_be_in_type_list(df, column_name, [column_type])


expect_column_values_to_be_of_type.vacuous = _column_absent


@register
def expect_column_values_to_have_consistent_casing(
    df: DataFrame, column_name: str, display_inconsistent_columns: bool = False
) -> DataFrame:
    """No two values differ in case only: the two counts, or the values that clash.

    A null counts as a value in the first count but not in the second.
    """
    values = df.select(F.expr(column_name).alias("v")).distinct()
    if display_inconsistent_columns:
        clashes = values.groupBy(F.lower("v").alias("inconsistent_columns")).agg(
            F.count("v").alias("set_count_case_insensitive")
        )
        return clashes.filter(F.col("set_count_case_insensitive") > 1)
    counts = values.agg(
        F.count(F.lit(1)).alias("set_count"),
        F.count_distinct(F.lower("v")).alias("set_count_case_insensitive"),
    )
    return counts.filter(F.col("set_count") != F.col("set_count_case_insensitive"))


def set_frame(spark: SparkSession, value_set: Sequence, quote_values: bool) -> DataFrame:
    """The members as a column: quoted ones are text, unquoted ones SQL expressions.

    Text travels as one literal, so that a long list costs one call and Spark knows its size.
    """
    if quote_values or not value_set:
        members = F.from_json(F.lit(json.dumps([str(v) for v in value_set])), "array<string>")
        return spark.range(1).select(F.explode(members).alias("value_field"))
    rows = ", ".join(f"({v})" for v in value_set)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS members(value_field)")


def _values(df: DataFrame, column_name: str, row_condition: str | None) -> DataFrame:
    return select_rows(df, row_condition).select(F.expr(column_name).alias("value_field"))


def outside_set(values: DataFrame, value_set: Sequence, quote_values: bool) -> DataFrame:
    """Values that are not in the set, nulls included."""
    members = set_frame(values.sparkSession, value_set, quote_values).withColumnRenamed("value_field", "member")
    return values.join(members, F.col("value_field") == F.col("member"), "left_anti")


@register
def expect_column_values_to_be_in_set(
    df: DataFrame,
    column_name: str,
    value_set: Sequence,
    quote_values: bool = True,
    row_condition: str | None = None,
) -> DataFrame:
    """Values outside the set, one row each time; a null is outside every set."""
    return outside_set(_values(df, column_name, row_condition), value_set, quote_values)


def _set_membership(column_name: str, value_set: Sequence, quote_values: bool = True) -> Keyed:
    return Keyed(F.expr(column_name), outside, set_frame(SparkSession.active(), value_set, quote_values))


expect_column_values_to_be_in_set.keyed = _set_membership


@register
def expect_column_values_to_not_be_in_set(
    df: DataFrame,
    column_name: str,
    value_set: Sequence,
    quote_values: bool = True,
    row_condition: str | None = None,
) -> DataFrame:
    """Values inside the set, once for every time the set names them."""
    values = _values(df, column_name, row_condition)
    members = set_frame(df.sparkSession, value_set, quote_values).withColumnRenamed("value_field", "member")
    return values.join(members, F.col("value_field") == F.col("member")).select("value_field")


@row_check
def expect_column_values_to_be_between(
    column_name: str, min_value=None, max_value=None, strictly: bool = False
) -> Column:
    return between(F.expr(column_name), min_value, max_value, strictly)


def _in_order(
    df, column_name, sort_column, strictly, row_condition, group_by, step, rising, whole_groups
) -> DataFrame:
    groups = _as_list(group_by)
    rows = select_rows(df, row_condition).select(
        F.expr(sort_column or column_name).alias(SORT), *groups, F.expr(column_name).alias(VALUE)
    )

    def violates(value: Column, previous: Column) -> Column:
        above, below = (value, previous) if rising else (previous, value)
        ok = above > below if strictly else above >= below
        if step:
            ok = ok & (above - below == step)
        return previous.isNotNull() & ~ok

    return neighbour_violations(rows, violates, groups, not rising, whole_groups)


@register
def expect_column_values_to_be_increasing(
    df: DataFrame,
    column_name: str,
    sort_column: str | None = None,
    strictly: bool = True,
    row_condition: str | None = None,
    group_by: Sequence[str] | None = None,
    step: float | None = None,
    whole_groups: bool = False,
) -> DataFrame:
    """Values that do not rise (by ``step``, if given) from the row before in sort order."""
    return _in_order(
        df, column_name, sort_column, strictly, row_condition, group_by, step, True, whole_groups
    )


@register
def expect_column_values_to_be_decreasing(
    df: DataFrame,
    column_name: str,
    sort_column: str | None = None,
    strictly: bool = True,
    row_condition: str | None = None,
    group_by: Sequence[str] | None = None,
    step: float | None = None,
    whole_groups: bool = False,
) -> DataFrame:
    """Values that do not fall (by ``step``, if given) from the row before in sort order."""
    found = _in_order(
        df, column_name, sort_column, strictly, row_condition, group_by, step, False, whole_groups
    )
    return found.drop(*_as_list(group_by))
