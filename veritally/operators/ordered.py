"""Each row beside its predecessor in a sort order, at any group size."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import WindowSpec
from pyspark.sql import functions as F

from veritally.operators.ranges import RANGE, with_range

# Copies of one row that a single task writes out.
COPIES_PER_TASK = 100_000

SORT, VALUE, PREVIOUS = "sort_column", "value_field", "value_field_lag"


def neighbour_violations(
    df: DataFrame,
    violates: Callable[[Column, Column], Column],
    group_by: Sequence[str] = (),
    ties_descending: bool = False,
    whole_groups: bool = False,
) -> DataFrame:
    """Rows of (group, sort_column, value_field) whose value ``violates`` the one before it.

    ``violates(value, previous)`` must not hold for a missing previous value. Rows with equal sort
    values are ordered by value. Rows are counted per distinct value, cut into ranges over (group,
    sort, value) -- so neither a large group nor a frequent sort value stays in one task -- and
    compared inside each range and then across the range edges, of which there are two per range
    and group. ``whole_groups`` sorts each group in one task instead: for groups known to be small.
    """
    keys = list(group_by)
    columns = [SORT, *keys, VALUE, PREVIOUS]
    value_order = F.col(VALUE).desc() if ties_descending else F.col(VALUE).asc()
    order = [F.col(SORT).asc(), value_order]
    broken = violates(F.col(VALUE), F.col(PREVIOUS))

    if whole_groups:
        window = W.partitionBy(*keys).orderBy(*order)
        return df.withColumn(PREVIOUS, F.lag(VALUE).over(window)).filter(broken).select(*columns)

    runs = df.groupBy(*keys, SORT, VALUE).agg(F.count(F.lit(1)).alias("__copies"))
    ranged = with_range(runs, [*[(k, False) for k in keys], (SORT, False), (VALUE, ties_descending)])
    in_range = W.partitionBy(RANGE, *keys).orderBy(*order)
    placed = ranged.select(
        "*",
        F.lag(VALUE).over(in_range).alias(PREVIOUS),
        F.row_number().over(in_range).alias("__place"),
        F.lead(F.lit(True)).over(in_range).isNull().alias("__is_last"),
    )
    inside = placed.filter(F.col("__place") > 1).filter(broken).select(*columns)

    edges = placed.filter((F.col("__place") == 1) | F.col("__is_last"))
    across = W.partitionBy(*keys).orderBy(RANGE, "__place")
    at_edges = (
        edges.withColumn(PREVIOUS, F.lag(VALUE).over(across))
        .filter(F.col("__place") == 1)
        .filter(broken)
        .select(*columns)
    )

    # Copies of a row follow one another: the second and later ones have their own value before them.
    spare = (
        ranged.filter(F.col("__copies") > 1)
        .withColumn(PREVIOUS, F.col(VALUE))
        .filter(broken)
        .select(*columns, (F.col("__copies") - 1).alias("__spare"))
    )
    return inside.unionByName(at_edges).unionByName(repeat_rows(spare, "__spare"))


def over_previous(
    df: DataFrame,
    made: Mapping[str, Callable[[WindowSpec], Column]],
    order: Sequence[str],
    rows_back: int,
    group_by: Sequence[str] = (),
    whole_groups: bool = False,
) -> DataFrame:
    """``df`` with columns made from each row and at most ``rows_back`` rows before it, at any group size.

    Every function gets the ordered window, to which it may add a frame that looks no further back
    than ``rows_back`` rows and not ahead. ``order`` must tell the rows of a group apart: which of
    equal ones comes first is not defined, and all of them are in one range. Rows are cut into
    ranges over (group, order). Inside a range all but the first rows have what they need; these
    see the last ``rows_back`` rows of the ranges before, which are put together with them: at
    most ``2 * rows_back`` rows for each range and group. ``whole_groups`` sorts each group in one
    task instead: for groups known to be small.
    """
    keys, columns = list(group_by), list(df.columns)
    if whole_groups:
        window = W.partitionBy(*keys).orderBy(*order)
        return df.withColumns({alias: make(window) for alias, make in made.items()})
    ranged = with_range(df, [*[(k, False) for k in keys], *[(c, False) for c in order]])
    in_range = W.partitionBy(RANGE, *keys).orderBy(*order)
    placed = ranged.select(
        "*",
        F.row_number().over(in_range).alias("__place"),
        F.lead(F.lit(True), rows_back).over(in_range).isNull().alias("__is_tail"),
        *[make(in_range).alias(alias) for alias, make in made.items()],
    )
    inside = placed.filter(F.col("__place") > rows_back).select(*columns, *made)
    edges = placed.drop(*made).filter((F.col("__place") <= rows_back) | F.col("__is_tail"))
    across = W.partitionBy(*keys).orderBy(RANGE, "__place")
    heads = edges.select("*", *[make(across).alias(alias) for alias, make in made.items()])
    return inside.unionByName(heads.filter(F.col("__place") <= rows_back).select(*columns, *made))


def lag_rows(
    df: DataFrame,
    value: str,
    order: Sequence[str],
    rows_back: int = 1,
    group_by: Sequence[str] = (),
    alias: str = "lag",
    whole_groups: bool = False,
) -> DataFrame:
    """Every row with ``value`` of the row ``rows_back`` before it in its group, null where there is none."""
    return over_previous(df, {alias: lambda w: F.lag(value, rows_back).over(w)}, order, rows_back, group_by, whole_groups)


def trailing(
    df: DataFrame,
    aggregates: Mapping[str, Column],
    order: Sequence[str],
    rows_back: int,
    group_by: Sequence[str] = (),
    and_current: bool = False,
    whole_groups: bool = False,
) -> DataFrame:
    """Every row with aggregates of the ``rows_back`` rows before it, and of itself with ``and_current``."""
    last = 0 if and_current else -1

    def over(aggregate: Column) -> Callable[[WindowSpec], Column]:
        return lambda window: aggregate.over(window.rowsBetween(-rows_back, last))

    return over_previous(df, {n: over(a) for n, a in aggregates.items()}, order, rows_back, group_by, whole_groups)


def running_sum(
    df: DataFrame,
    value: str,
    order: str,
    group_by: Sequence[str] = (),
    alias: str = "running_sum",
    descending: bool = False,
    whole_groups: bool = False,
) -> DataFrame:
    """Every row with the sum of ``value`` up to it; rows equal in ``order`` share one sum.

    Rows are summed per order value, cut into ranges over (group, order), summed up inside each
    range on top of the ranges before it, and joined back. ``whole_groups`` sorts each group in one
    task instead: for groups known to be small.
    """
    keys = list(group_by)
    kind = df.agg(F.sum(value)).schema[0].dataType  # of a single sum, also where sums are added up
    direction = F.col(order).desc() if descending else F.col(order).asc()
    if whole_groups:
        return df.withColumn(alias, F.sum(value).over(W.partitionBy(*keys).orderBy(direction)))

    names = {c: f"__key_{i}" for i, c in enumerate([*keys, order])}
    sums = df.groupBy(*[F.col(c).alias(n) for c, n in names.items()]).agg(F.sum(value).alias("__sum"))
    groups, place = [names[k] for k in keys], names[order]
    placed = F.col(place).desc() if descending else F.col(place).asc()
    ranged = with_range(sums, [*[(g, False) for g in groups], (place, descending)])
    before = W.partitionBy(*groups).orderBy(RANGE).rowsBetween(W.unboundedPreceding, -1)
    starts = ranged.groupBy(*groups, RANGE).agg(F.sum("__sum").alias("__block"))
    starts = starts.select(
        *[F.col(g).alias(f"{g}_start") for g in groups],
        F.col(RANGE).alias("__at"),
        F.sum("__block").over(before).alias("__before"),
    )
    inside = F.sum("__sum").over(W.partitionBy(RANGE, *groups).orderBy(placed))
    same_range = F.col(RANGE) == F.col("__at")
    for g in groups:
        same_range = same_range & F.col(g).eqNullSafe(F.col(f"{g}_start"))
    total = F.when(F.col("__before").isNull(), F.col("__inside")).otherwise(
        F.col("__before") + F.coalesce("__inside", F.lit(0))
    )
    totals = ranged.withColumn("__inside", inside).join(starts, same_range)
    totals = totals.select(*groups, place, total.cast(kind).alias(alias))
    same_row = F.lit(True)
    for c, n in names.items():
        same_row = same_row & df[c].eqNullSafe(totals[n])
    return df.join(totals, same_row).select(*[df[c] for c in df.columns], totals[alias])


def repeat_rows(df: DataFrame, times: str) -> DataFrame:
    """Each row ``times`` times, spread over tasks so that no single one writes a huge run."""
    columns = [c for c in df.columns if c != times]
    last_block = F.floor((F.col(times) - 1) / COPIES_PER_TASK)
    blocks = df.select(
        *columns, times, F.explode(F.sequence(F.lit(0).cast("bigint"), last_block)).alias("__block")
    )
    # A stated number of partitions is kept as it is; blocks are few bytes each and would
    # otherwise be put back together before they grow.
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = blocks.repartition(tasks, "__block", *columns)
    size = F.least(F.lit(COPIES_PER_TASK), F.col(times) - F.col("__block") * COPIES_PER_TASK)
    return blocks.select(*columns, F.explode(F.sequence(F.lit(1), size)).alias("__copy")).drop("__copy")
