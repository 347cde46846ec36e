"""Number, hash, pattern and logic helpers shared by models and checks."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from veritally.functions.nested import as_column

# Inline flags the Java regex engine shares with the source dialects; "c" asks
# for case-sensitive matching, which is the default.
INLINE_FLAGS = "ims"
NEUTRAL_FLAGS = "c"
# Stands before every match while matches are counted; Unicode keeps it out of text.
MARK = "\uffff"


def log_natural(x: Column | str) -> Column:
    return F.ln(as_column(x))


def rand(seed: int | None = None) -> Column:
    """Uniform numbers in [0, 1)."""
    return F.rand(seed)


def md5_text(x: Column | str) -> Column:
    """md5 of the value written as text."""
    return F.md5(as_column(x).cast("string"))


def metric_value(x: Column | str, take_logs: bool) -> Column:
    """A metric with nulls as 0, on a log scale if asked (where 0 stays 0)."""
    column = as_column(x).cast("double")
    if take_logs:
        column = log_natural(F.nullif(column, F.lit(0.0)))
    return F.coalesce(column, F.lit(0.0))


def with_flags(pattern: str, flags: str = "") -> str:
    """``pattern`` with its flags written inline."""
    unknown = [f for f in flags if f not in INLINE_FLAGS + NEUTRAL_FLAGS]
    if unknown:
        raise ValueError(f"regex flags {unknown} are not supported; use any of {INLINE_FLAGS!r} or 'c'")
    inline = "".join(f for f in flags if f in INLINE_FLAGS)
    return f"(?{inline}){pattern}" if inline else pattern


def matches(source: Column | str, pattern: str, flags: str = "") -> Column:
    """Whether ``pattern`` occurs anywhere in ``source``."""
    return as_column(source).rlike(with_flags(pattern, flags))


def regexp_instr(
    source: Column | str, pattern: str, position: int = 1, occurrence: int = 1, flags: str = ""
) -> Column:
    """1-based position of the n-th match at or after ``position``; 0 if there is none."""
    column, wanted = as_column(source), with_flags(pattern, flags)
    if position > 1:
        # No match starts behind fewer characters. The whole text is searched, so that what a
        # pattern looks for behind itself is there, and no group is added, so that references keep
        # their numbers.
        wanted = rf"(?<!\A(?s:.{{0,{position - 2}}}))(?:{wanted})"
    if occurrence == 1:
        return F.regexp_instr(column, F.lit(wanted))
    matches = F.regexp_extract_all(column, F.lit(wanted), F.lit(0))
    pieces = F.split(column, wanted, -1)
    # An empty match at the very start leaves no empty piece before it.
    pieces = F.when(F.size(pieces) == F.size(matches), F.concat(F.array(F.lit("")), pieces)).otherwise(pieces)
    before = F.concat(F.slice(pieces, 1, occurrence), F.slice(matches, 1, occurrence - 1))
    start = F.length(F.array_join(before, "")) + 1
    return F.when(F.size(matches) >= occurrence, start).when(column.isNotNull(), 0)


def _tree(conditions: Sequence[Column], join: Callable[[Column, Column], Column]) -> Column:
    """All conditions joined in a balanced tree: a chain as deep as a long list overflows the stack."""
    level = list(conditions)
    if not level:
        raise ValueError("at least one condition is needed")
    while len(level) > 1:
        paired = [join(a, b) for a, b in zip(level[::2], level[1::2], strict=False)]
        level = paired + level[2 * len(paired) :]
    return level[0]


def any_of(conditions: Sequence[Column]) -> Column:
    return _tree(conditions, lambda a, b: a | b)


def all_of(conditions: Sequence[Column]) -> Column:
    return _tree(conditions, lambda a, b: a & b)


def keep_row(ignore_row_if: str, columns: Sequence[Column]) -> Column:
    """True for rows that must be looked at under a missing-value policy."""
    missing = [c.isNull() for c in columns]
    if ignore_row_if == "all_values_are_missing":
        return ~all_of(missing)
    if ignore_row_if == "any_value_is_missing":
        return ~any_of(missing)
    raise ValueError(
        "ignore_row_if must be 'all_values_are_missing' or 'any_value_is_missing', "
        f"got {ignore_row_if!r}"
    )
