"""Checks on text: lengths, patterns anywhere in the text, LIKE patterns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from veritally.checks.kernel import between, operand, row_check
from veritally.functions.scalar import all_of, any_of, matches


def _combine(conditions: list[Column], match_on: str) -> Column:
    return all_of(conditions) if match_on == "all" else any_of(conditions)


@row_check
def expect_column_value_lengths_to_be_between(
    column_name: str, min_value=None, max_value=None, strictly: bool = False
) -> Column:
    return between(F.length(F.expr(column_name)), min_value, max_value, strictly)


@row_check
def expect_column_value_lengths_to_equal(column_name: str, value: int) -> Column:
    return F.length(F.expr(column_name)) == operand(value)


# ``is_raw`` is accepted by all pattern checks: patterns given from Python are raw already.


@row_check
def expect_column_values_to_match_regex(
    column_name: str, regex: str, is_raw: bool = False, flags: str = ""
) -> Column:
    return matches(F.expr(column_name), regex, flags)


@row_check
def expect_column_values_to_not_match_regex(
    column_name: str, regex: str, is_raw: bool = False, flags: str = ""
) -> Column:
    return ~matches(F.expr(column_name), regex, flags)


@row_check
def expect_column_values_to_match_regex_list(
    column_name: str,
    regex_list: Sequence[str],
    match_on: str = "any",
    is_raw: bool = False,
    flags: str = "",
) -> Column:
    return _combine([matches(F.expr(column_name), r, flags) for r in regex_list], match_on)


@row_check
def expect_column_values_to_not_match_regex_list(
    column_name: str,
    regex_list: Sequence[str],
    match_on: str = "any",
    is_raw: bool = False,
    flags: str = "",
) -> Column:
    """With ``any`` it is enough to miss one pattern; with ``all`` every one must be missed."""
    return _combine([~matches(F.expr(column_name), r, flags) for r in regex_list], match_on)


@row_check
def expect_column_values_to_match_like_pattern(column_name: str, like_pattern: str) -> Column:
    return F.expr(column_name).like(like_pattern)


@row_check
def expect_column_values_to_not_match_like_pattern(column_name: str, like_pattern: str) -> Column:
    return ~F.expr(column_name).like(like_pattern)


@row_check
def expect_column_values_to_match_like_pattern_list(
    column_name: str, like_pattern_list: Sequence[str], match_on: str = "any"
) -> Column:
    return _combine([F.expr(column_name).like(p) for p in like_pattern_list], match_on)


@row_check
def expect_column_values_to_not_match_like_pattern_list(
    column_name: str, like_pattern_list: Sequence[str], match_on: str = "any"
) -> Column:
    return _combine([~F.expr(column_name).like(p) for p in like_pattern_list], match_on)
