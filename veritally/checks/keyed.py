"""Checks that look at the distinct values of a column, many of them in one scan.

Every row is expanded to one entry for each check, (check, value). The entries are counted in two
phases, so that a value that fills a third of the table is a row per task by then, and what is
left, one row per check and value, is joined once to the partners of all checks that have some.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ValueGroup:
    """One distinct value: whether it is of this check and not null, how often it occurs, whether it has a partner."""

    here: Column
    known: Column
    times: Column
    met: Column


@dataclass(frozen=True)
class Keyed:
    """The value a check looks at, the one-column frame of its partners, and its failures over the groups."""

    value: Column
    failures: Callable[[ValueGroup], Column]
    partners: DataFrame | None = None


def repeated(g: ValueGroup) -> Column:
    return F.count_if(g.known & (g.times > 1))


def orphans(g: ValueGroup) -> Column:
    return F.sum(F.when(g.known & ~g.met, g.times))


def outside(g: ValueGroup) -> Column:
    return F.sum(F.when(g.here & ~g.met, g.times))


def distinct_count(holds: Callable[[Column], Column]) -> Callable[[ValueGroup], Column]:
    """One failure unless the number of distinct values, nulls aside, ``holds``."""
    return lambda g: F.when(~holds(F.count_if(g.known)), 1).otherwise(0)


def failures(df: DataFrame, checks: Sequence[tuple[Keyed, str | None]]) -> DataFrame:
    """One row with the failures c0, c1, ... of all checks, each with its row condition."""
    kinds = [df.select(k.value.alias("v")).schema["v"].dataType for k, _ in checks]
    names = {kind.simpleString(): f"v{i}" for i, kind in enumerate({k.simpleString(): k for k in kinds}.values())}
    typed = {names[k.simpleString()]: k for k in kinds}
    column = [names[k.simpleString()] for k in kinds]

    def entry(number: int, value: Column) -> list[Column]:
        # A null of its own type is a column that no other check uses.
        values = [(value if n == column[number] else F.lit(None)).cast(k).alias(n) for n, k in typed.items()]
        return [F.lit(number).alias("check"), *values]

    entries = []
    for number, (keyed, condition) in enumerate(checks):
        wanted = F.coalesce(F.expr(condition), F.lit(False)) if condition else F.lit(True)
        entries.append(F.struct(*entry(number, keyed.value), wanted.alias("wanted")))
    expanded = df.select(F.inline(F.array(*entries))).filter("wanted")
    counted = expanded.groupBy("check", *typed).agg(F.count(F.lit(1)).alias("times"))
    partners = [
        keyed.partners.select(*entry(number, F.col(keyed.partners.columns[0]))).filter(F.col(column[number]).isNotNull())
        for number, (keyed, _) in enumerate(checks)
        if keyed.partners is not None
    ]
    met = F.lit(False)
    if partners:
        known = reduce(DataFrame.unionByName, partners).distinct()
        known = known.select(*[F.col(c).alias(f"__{c}") for c in known.columns])
        same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in ("check", *typed)])
        counted = counted.join(known, same, "left")
        met = F.col("__check").isNotNull()
    totals = []
    for number, (keyed, _) in enumerate(checks):
        here = F.col("check") == number
        group = ValueGroup(here, here & F.col(column[number]).isNotNull(), F.col("times"), met)
        totals.append(keyed.failures(group).cast("bigint").alias(f"c{number}"))
    return counted.agg(*totals)


def fits(df: DataFrame, keyed: Keyed) -> bool:
    """Whether values and partners are of one type that can be grouped, so that equality is that of the check alone."""
    kind = df.select(keyed.value.alias("v")).schema["v"].dataType.simpleString()
    if kind.startswith(("map", "variant", "array", "struct")):
        return False
    return keyed.partners is None or keyed.partners.schema[0].dataType.simpleString() == kind
