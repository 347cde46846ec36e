"""Ranges of near-equal size over a sort order, cut by bounds that Spark computes when the query runs."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sampled rows between two bounds; the more, the more even the ranges.
SAMPLES = 16
RANGE = "__range"


def _before(a: Column, b: Column, directions: Sequence[bool]) -> Column:
    """Whether ``a`` sorts before ``b``: structs of one struct for each run of columns of one direction.

    Structs compare their fields in turn, with nulls as least values.
    """
    verdict = None
    for i, descending in reversed(list(enumerate(directions))):
        one, other = a.getField(f"p{i}"), b.getField(f"p{i}")
        first = one > other if descending else one < other
        verdict = first if verdict is None else first | ((one == other) & verdict)
    return verdict


def with_range(df: DataFrame, order: Sequence[tuple[str, bool]]) -> DataFrame:
    """``df`` with the number of each row's range; ranges follow ``order``, (column, descending) pairs.

    ``df`` holds each tuple of these columns once. The bounds are taken from the tuples with the
    smallest hashes, a sample of fixed size for the session's shuffle partitions. It is the same
    whenever it is read, so several readings, and tasks run again after a lost executor, agree on
    the ranges. Nothing runs while the plan is built; bounds are a scalar of the query itself.
    """
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    steps = [1 << i for i in reversed(range(max(tasks, 1).bit_length() + 1))]
    parts = [(down, [name for name, _ in part]) for down, part in groupby(order, lambda o: o[1])]
    directions = [down for down, _ in parts]
    at = F.struct(*[F.struct(*names).alias(f"p{i}") for i, (_, names) in enumerate(parts)])
    sample = (
        df.select(at.alias("at"))
        .orderBy(F.xxhash64("at"), "at")
        .limit(2 * steps[0] * SAMPLES)
        .agg(F.collect_list("at").alias("ats"))
    )
    in_order = F.array_sort(
        "ats",
        lambda a, b: F.when(_before(a, b, directions), -1).when(_before(b, a, directions), 1).otherwise(0),
    )
    bounds = sample.select(F.filter(in_order, lambda _, i: i % SAMPLES == SAMPLES - 1))
    placed = df.select("*", bounds.scalar().alias("__bounds"), at.alias("__at"), F.lit(0).alias(RANGE))
    # A binary search in steps of their own, which stay compiled and never copy the bounds.
    for step in steps:
        place = F.col(RANGE) + step
        passed = (place <= F.size("__bounds")) & _before(
            F.get("__bounds", place - 1), F.col("__at"), directions
        )
        placed = placed.withColumn(RANGE, F.when(passed, place).otherwise(F.col(RANGE)))
    # Every step names the one before four times. What joins or filters by the range would put the
    # steps into one another, an expression that grows with the square of the partitions and takes
    # minutes to plan; no rule looks for a column below the generator that made it.
    return placed.select(*df.columns, F.explode(F.array(RANGE)).alias(RANGE))
