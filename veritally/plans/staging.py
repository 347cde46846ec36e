"""Staging models: a typed window on the silver tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Amounts are exact decimals from here on.
AMOUNT = "decimal(38,9)"


def _cast(name: str, kind: str, lenient: bool) -> Column:
    column = F.col(name)
    return (column.try_cast(kind) if lenient else column.cast(kind)).alias(name)


def _loaded_at(loaded_at) -> Column:
    if loaded_at is None:
        return F.current_timestamp().alias("loaded_at")
    value = loaded_at if isinstance(loaded_at, Column) else F.lit(str(loaded_at))
    return value.cast("timestamp").alias("loaded_at")


def stage(df: DataFrame, casts: dict[str, str], drop=(), loaded_at=None, lenient: bool = False) -> DataFrame:
    """Cast the named columns in place, drop others, and stamp the load.

    A malformed value fails the job; with ``lenient`` it becomes null.
    """
    kept = [c for c in df.columns if c not in drop]
    return df.select(
        *[_cast(c, casts[c], lenient) if c in casts else F.col(c) for c in kept],
        _loaded_at(loaded_at),
    )


def stg_patient(silver: DataFrame, loaded_at=None, lenient: bool = False) -> DataFrame:
    casts = {"birth_date": "date", "last_updated": "timestamp"}
    return stage(silver, casts, loaded_at=loaded_at, lenient=lenient)


def stg_coverage(silver: DataFrame, loaded_at=None, lenient: bool = False) -> DataFrame:
    casts = {"period_start": "date", "period_end": "date", "last_updated": "timestamp"}
    return stage(silver, casts, loaded_at=loaded_at, lenient=lenient)


def stg_eob(silver: DataFrame, loaded_at=None, lenient: bool = False) -> DataFrame:
    casts = {
        "service_start_date": "date",
        "service_end_date": "date",
        "total_payment": AMOUNT,
        "total_amount": AMOUNT,
        "last_updated": "timestamp",
    }
    return stage(silver, casts, drop=("item_json",), loaded_at=loaded_at, lenient=lenient)
