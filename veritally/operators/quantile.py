"""Exact interpolated quantiles, whole-table or per group, at any group size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from veritally.operators.ranges import RANGE, with_range


def percentile_by(
    df: DataFrame,
    value: str,
    quantile: float,
    group_by: Sequence[str] = (),
    alias: str = "percentile",
    whole_groups: bool = False,
) -> DataFrame:
    """(group columns, quantile) of ``value``, nulls left out; null for groups without values.

    ``value`` is an SQL expression. Values are counted, cut into ranges over (group, value), and
    only the ranges that hold the two neighbouring ranks are summed up row by row. ``whole_groups``
    counts each group's distinct values in one buffer instead: for groups known to be small.
    """
    keys = list(group_by)
    rows = df.select(*keys, F.expr(value).cast("double").alias("__value"))
    if whole_groups:
        return rows.groupBy(*keys).agg(F.percentile("__value", quantile).alias(alias))

    # A null value counts 0 times, which keeps its group.
    counted = rows.groupBy(*keys, "__value").agg(F.count("__value").alias("__n"))
    ranged = with_range(counted, [*[(k, False) for k in keys], ("__value", False)])
    by_range = W.partitionBy(*keys).orderBy(RANGE)
    blocks = (
        ranged.groupBy(*keys, RANGE)
        .agg(F.sum("__n").alias("__block"))
        .withColumn("__end", F.sum("__block").over(by_range))
        .withColumn("__total", F.sum("__block").over(W.partitionBy(*keys)))
        .withColumn("__start", F.col("__end") - F.col("__block"))
        .withColumn("__rank", quantile * (F.col("__total") - 1))
        .withColumn("__lower", F.floor("__rank"))
        .withColumn("__upper", F.ceil("__rank"))
    )
    wanted = blocks.filter(
        ((F.col("__start") <= F.col("__upper")) & (F.col("__end") > F.col("__lower")))
        | (F.col("__total") == 0)
    ).select(
        *[F.col(k).alias(f"__key_{i}") for i, k in enumerate(keys)],
        F.col(RANGE).alias("__wanted"),
        *["__start", "__rank", "__lower", "__upper"],
    )
    same = F.col(RANGE) == F.col("__wanted")
    for i, key in enumerate(keys):
        same = same & F.col(key).eqNullSafe(F.col(f"__key_{i}"))
    in_range = W.partitionBy(RANGE, *keys).orderBy("__value")
    upto = F.sum("__n").over(in_range) + F.col("__start")
    ranked = ranged.join(wanted, same).withColumn("__upto", upto)

    def value_at(rank: str):
        holds = (F.col("__upto") - F.col("__n") <= F.col(rank)) & (F.col("__upto") > F.col(rank))
        return F.min(F.when(holds, F.col("__value")))

    found = ranked.groupBy(*keys).agg(
        value_at("__lower").alias("__low"),
        value_at("__upper").alias("__high"),
        F.first(F.col("__rank") - F.col("__lower")).alias("__weight"),
    )
    # The interpolation is written as the built-in aggregate writes it, to the last bit.
    between = (1 - F.col("__weight")) * F.col("__low") + F.col("__weight") * F.col("__high")
    exact = F.when(F.col("__weight") == 0, F.col("__low")).otherwise(between)
    return found.select(*keys, exact.alias(alias))


def percentile_over(
    df: DataFrame, value: str, quantile: float, partition: Sequence[str] = (), alias: str = "percentile",
    whole_groups: bool = False,
) -> DataFrame:
    """Every row with the quantile of its partition (or of the whole table) attached."""
    keys = list(partition)
    stats = percentile_by(df, value, quantile, keys, "__q", whole_groups)
    if not keys:
        return df.withColumn(alias, stats.scalar())
    renamed = stats.select(*[F.col(k).alias(f"__key_{i}") for i, k in enumerate(keys)], "__q")
    same = F.lit(True)
    for i, key in enumerate(keys):
        same = same & df[key].eqNullSafe(F.col(f"__key_{i}"))
    joined = df.join(renamed, same, "left")
    return joined.select(*[df[c] for c in df.columns], F.col("__q").alias(alias))
