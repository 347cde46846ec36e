"""The latest row per key, and keyed upserts built on it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_by_key(
    df: DataFrame, keys: Sequence[str], order: str, tie: Sequence[str] = ()
) -> DataFrame:
    """One row per key: the one with the greatest ``order`` (nulls last), then greatest ``tie``.

    Rows equal in all of these are told apart by their remaining columns, so the choice never
    depends on the run. A maximum over a struct combines before the shuffle: a key that holds a
    third of all rows still sends one row per task, where a window would sort them all in one.
    """
    first = [order, *tie]
    rest = [c for c in df.columns if c not in keys and c not in first]
    kinds = dict(df.dtypes)
    unordered = [c for c in [*first, *rest] if kinds[c].startswith(("map", "variant"))]
    if unordered:
        raise ValueError(f"columns {unordered} have no order")
    best = df.groupBy(*keys).agg(F.max(F.struct(*first, *rest)).alias("__best"))
    return best.select(*[c if c in keys else F.col(f"__best.{c}").alias(c) for c in df.columns])


def upsert(
    current: DataFrame | None, increment: DataFrame, keys: Sequence[str], order: str, tie: Sequence[str] = ()
) -> DataFrame:
    """``current``, which holds one row per key, with the latest row of every key in ``increment``.

    Only rows whose key is in the increment are compared. The others pass through an anti join,
    which does not shuffle them where the increment's keys are few enough to broadcast.
    """
    if current is None:
        return latest_by_key(increment, keys, order, tie)
    names = {k: f"__key_{i}" for i, k in enumerate(keys)}
    touched_keys = increment.select(*[F.col(k).alias(n) for k, n in names.items()]).distinct()
    same = F.lit(True)
    for k, n in names.items():
        same = same & current[k].eqNullSafe(touched_keys[n])
    untouched = current.join(touched_keys, same, "left_anti")
    touched = current.join(touched_keys, same, "left_semi")
    return untouched.unionByName(latest_by_key(touched.unionByName(increment), keys, order, tie))
