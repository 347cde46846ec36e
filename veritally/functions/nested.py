"""Column helpers for nested records whose paths may be missing at any level."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def first_item(array: Column | str) -> Column:
    """The first element, or null where the array is null or empty."""
    return F.get(as_column(array), F.lit(0))


def first_match(array: Column | str, predicate: Callable[[Column], Column]) -> Column:
    """The first element that satisfies ``predicate``, or null."""
    return first_item(F.filter(as_column(array), predicate))


def first_coding(concept: Column) -> Column:
    """The first coding of a codeable concept."""
    return first_item(concept["coding"])


def strip_prefix(reference: Column | str, prefix: str = "Patient/") -> Column:
    """``reference`` without any occurrence of ``prefix``; an absent reference becomes ``""``."""
    return F.replace(F.coalesce(as_column(reference), F.lit("")), F.lit(prefix), F.lit(""))


def json_text(array: Column | str, is_text: bool) -> Column:
    """The array as JSON text, ``[]`` where it is missing."""
    column = as_column(array)
    text = column if is_text else F.to_json(column)
    return F.coalesce(text, F.lit("[]"))


def json_scalar(document: Column | str, path: str) -> Column:
    """The scalar at a JSON path as text, null where the path is missing."""
    return F.get_json_object(as_column(document), path)
