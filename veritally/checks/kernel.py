"""What every check is built from: predicates over rows or groups, and comparisons of aggregates."""

from __future__ import annotations

import functools
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veritally.checks.keyed import Keyed, orphans, repeated
from veritally.operators.ordered import repeat_rows

REGISTRY: dict[str, Callable] = {}


def register(check: Callable) -> Callable:
    """Make a check available to suites by its name; any ``DataFrame -> DataFrame`` will do."""
    REGISTRY[check.__name__] = check
    return check


def operand(value) -> Column:
    """A bound or a set member: text is an SQL expression, anything else a literal."""
    if isinstance(value, Column):
        return value
    return F.expr(value) if isinstance(value, str) else F.lit(value)


def select_rows(df: DataFrame, row_condition: str | None) -> DataFrame:
    return df.filter(F.expr(row_condition)) if row_condition else df


def group_columns(group_by: Sequence[str] | None) -> list[Column]:
    return [F.expr(g).alias(f"col_{i}") for i, g in enumerate(group_by or (), start=1)]


def _as_list(columns: str | Sequence[str] | None) -> list[str]:
    return [columns] if isinstance(columns, str) else list(columns or ())


def failing(
    df: DataFrame,
    expression: Column,
    group_by: Sequence[str] | None = None,
    row_condition: str | None = None,
    carry: Sequence[str] = (),
    holds: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """Rows, or groups, where ``expression`` does not hold, as ``col_1..n, expression``.

    ``carry`` names columns to return beside a failing row.
    """
    rows = select_rows(df, row_condition)
    if group_by:
        tested = rows.groupBy(*group_columns(group_by)).agg(expression.alias("expression"))
    else:
        tested = rows.select(*carry, expression.alias("expression"))
    outcome = F.col("expression")
    return tested.filter(~(holds(outcome) if holds else outcome))


def row_check(predicate: Callable[..., Column]) -> Callable:
    """Turn a predicate on one row into a check that returns the rows failing it."""

    @functools.wraps(predicate)
    def check(df, *args, row_condition=None, carry=(), **kwargs):
        return failing(df, predicate(*args, **kwargs), None, row_condition, carry)

    check.predicate, check.level = predicate, "row"
    return register(check)


def aggregate_check(
    predicate: Callable[..., Column] | None = None, *, fusible: bool = True, skips_nulls: bool = False
) -> Callable:
    """Turn a predicate on aggregates into a check that returns the groups failing it.

    ``fusible`` says whether the aggregate can share one scan with others without making each
    of them read the rows several times, which distinct counts and quantiles would.
    ``skips_nulls`` says that nulls in ``column_name`` do not count, so that a row condition can
    be met by nulls in place of a filter.
    """

    def wrap(predicate):
        @functools.wraps(predicate)
        def check(df, *args, group_by=None, row_condition=None, **kwargs):
            return failing(df, predicate(*args, **kwargs), _as_list(group_by), row_condition)

        check.predicate, check.level = predicate, "aggregate" if fusible else "single"
        check.skips_nulls = skips_nulls
        return register(check)

    return wrap(predicate) if predicate else wrap


def between(expression: Column, min_value=None, max_value=None, strictly: bool = False) -> Column:
    """The expression within its bounds; at least one bound is needed."""
    if min_value is None and max_value is None:
        raise ValueError("give a min_value, a max_value or both")
    condition = F.lit(True)
    if min_value is not None:
        low = operand(min_value)
        condition = condition & (expression > low if strictly else expression >= low)
    if max_value is not None:
        high = operand(max_value)
        condition = condition & (expression < high if strictly else expression <= high)
    return condition


@register
def expression_is_true(
    df: DataFrame,
    expression: str,
    test_condition: str = "= true",
    group_by_columns: Sequence[str] | None = None,
    row_condition: str | None = None,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Rows or groups whose expression does not meet the test condition."""
    meets = lambda _: F.expr(f"expression {test_condition}")
    return failing(df, F.expr(expression), group_by_columns, row_condition, carry, meets)


def _meets_condition(expression: str, test_condition: str = "= true") -> Column | None:
    # A condition that names the outcome again cannot be put behind the expression.
    return None if "expression" in test_condition.lower() else F.expr(f"({expression}) {test_condition}")


expression_is_true.level, expression_is_true.predicate = "expression", _meets_condition


@register
def expression_between(
    df: DataFrame,
    expression: str,
    min_value=None,
    max_value=None,
    group_by_columns: Sequence[str] | None = None,
    row_condition: str | None = None,
    strictly: bool = False,
    carry: Sequence[str] = (),
) -> DataFrame:
    condition = between(F.expr(expression), min_value, max_value, strictly)
    return failing(df, condition, group_by_columns, row_condition, carry)


def _expression_within(expression: str, **bounds) -> Column:
    return between(F.expr(expression), **bounds)


expression_between.level, expression_between.predicate = "expression", _expression_within


def aggregate_by(
    df: DataFrame, expression: str, group_by: Sequence[str] | None = None, row_condition: str | None = None
) -> DataFrame:
    """``col_1..n, expression``: one aggregate per group, or one row without groups."""
    rows = select_rows(df, row_condition)
    value = F.expr(expression).alias("expression")
    return rows.groupBy(*group_columns(group_by)).agg(value) if group_by else rows.select(value)


@register
def equal_expression(
    df: DataFrame,
    expression: str,
    compare_model: DataFrame | None = None,
    compare_expression: str | None = None,
    group_by: Sequence[str] | None = None,
    compare_group_by: Sequence[str] | None = None,
    row_condition: str | None = None,
    compare_row_condition: str | None = None,
    tolerance: float = 0.0,
    tolerance_percent: float | None = None,
    null_safe: bool = False,
) -> DataFrame:
    """Groups whose aggregate differs between two tables by more than a tolerance.

    What is not given for the second table is taken from the first. A relative tolerance replaces
    the absolute one; it passes where the first value is null or 0. Groups whose key is null do not
    pair up, unless ``null_safe``.
    """
    groups = _as_list(group_by)
    left = aggregate_by(df, expression, groups, row_condition)
    right = aggregate_by(
        df if compare_model is None else compare_model,
        compare_expression or expression,
        _as_list(compare_group_by) or groups,
        compare_row_condition or row_condition,
    )
    if groups:
        both = _outer_pairs(left, right, len(groups), null_safe)
    else:
        # Each side is a single row, so the second one is a scalar to the first.
        both = left.withColumn("compare_expression", right.select("expression").scalar())
    mine, other = F.col("expression"), F.col("compare_expression")
    difference = F.abs(F.coalesce(mine, F.lit(0)) - F.coalesce(other, F.lit(0)))
    percent = difference.cast("double") / F.nullif(mine.cast("double"), F.lit(0.0))
    compared = both.withColumns(
        {"expression_difference": difference, "expression_difference_percent": percent}
    )
    if tolerance_percent:
        return compared.filter(F.col("expression_difference_percent") > tolerance_percent)
    return compared.filter(F.col("expression_difference") > tolerance)


def _outer_pairs(left: DataFrame, right: DataFrame, n: int, null_safe: bool) -> DataFrame:
    names = [f"col_{i}" for i in range(1, n + 1)]
    other = right.select(
        *[F.col(c).alias(f"other_{c}") for c in names], F.col("expression").alias("compare_expression")
    )
    condition = None
    for c in names:
        mine, theirs = F.col(c), F.col(f"other_{c}")
        same = mine.eqNullSafe(theirs) if null_safe else mine == theirs
        condition = same if condition is None else condition & same
    return left.join(other, condition, "full").select(
        *[F.coalesce(F.col(c), F.col(f"other_{c}")).alias(c) for c in names],
        "expression",
        "compare_expression",
    )


@register
def unique(df: DataFrame, column_name: str, row_condition: str | None = None) -> DataFrame:
    """Values that occur more than once; nulls are left out."""
    value = F.expr(column_name).alias("unique_field")
    counted = select_rows(df, row_condition).select(value).filter(F.col("unique_field").isNotNull())
    counted = counted.groupBy("unique_field").agg(F.count(F.lit(1)).alias("n_records"))
    return counted.filter(F.col("n_records") > 1)


unique.keyed = lambda column_name: Keyed(F.expr(column_name), repeated)


@row_check
def not_null(column_name: str) -> Column:
    """Rows whose value is missing; an empty text is a value."""
    return F.expr(column_name).isNotNull()


@register
def relationships(
    df: DataFrame, column_name: str, to: DataFrame, field: str, row_condition: str | None = None
) -> DataFrame:
    """Values without a partner in the other table, one row each time they occur; nulls pass.

    The values are counted before they are joined, so one that fills a third of the table is one
    row by then.
    """
    child = select_rows(df, row_condition).select(F.expr(column_name).alias("from_field"))
    child = child.filter(F.col("from_field").isNotNull())
    counted = child.groupBy("from_field").agg(F.count(F.lit(1)).alias("__times"))
    parent = to.select(F.expr(field).alias("to_field")).filter(F.col("to_field").isNotNull())
    orphans = counted.join(parent, F.col("from_field") == F.col("to_field"), "left_anti")
    return repeat_rows(orphans, "__times")


relationships.keyed = lambda column_name, to, field: Keyed(F.expr(column_name), orphans, to.select(F.expr(field)))
