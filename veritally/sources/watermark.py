"""The transaction time up to which everything has been loaded: the last entry of a commit log."""

from __future__ import annotations

import logging
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veritally.sources.commits import CommitLog

logger = logging.getLogger(__name__)

TIME = "transaction_time"


class LoadInThePast(ValueError):
    """A load of a time before the watermark, which would take old records for the newest."""


def moment(transaction_time: str) -> tuple:
    """Times of ISO 8601 in order, those without a zone in UTC; any other text by its characters."""
    try:
        parsed = datetime.fromisoformat(transaction_time.strip())
    except ValueError:
        return (0, transaction_time)
    return (1, parsed if parsed.tzinfo else parsed.replace(tzinfo=timezone.utc))


def last_load(spark: SparkSession, path: str) -> tuple[int, dict] | None:
    """(number, entry) of the last load, whose time is None while the first one is under way."""
    return CommitLog(spark, path).latest()


def read_watermark(spark: SparkSession, path: str) -> str | None:
    """The time of the last load; None (load everything) where nothing has been loaded."""
    found = last_load(spark, path)
    return found[1][TIME] if found else None


def check_order(transaction_time: str, watermark: str | None) -> None:
    if watermark is not None and moment(transaction_time) < moment(watermark):
        raise LoadInThePast(f"{transaction_time} is before the watermark {watermark}")


def write_watermark(spark: SparkSession, path: str, transaction_time: str | None, **notes) -> None:
    """Add a load to the log, with ``notes`` on what it stored.

    An empty time is not written, so the earlier one stays; the same time again without notes
    changes nothing; an earlier time is refused.
    """
    if not (transaction_time or "").strip():
        logger.warning("watermark not written: no transaction time")
        return
    found = last_load(spark, path)
    if found:
        check_order(transaction_time, found[1][TIME])
        if found[1][TIME] == transaction_time and not notes:
            return
    CommitLog(spark, path).append(found[0] + 1 if found else 0, {TIME: transaction_time, **notes})


def since_watermark(df: DataFrame, updated: Column | str, watermark: str | None) -> DataFrame:
    """Rows changed after the watermark; all rows without one."""
    if watermark is None:
        return df
    column = F.col(updated) if isinstance(updated, str) else updated
    kind = dict(df.dtypes).get(updated, "timestamp_ntz") if isinstance(updated, str) else "timestamp_ntz"
    return df.filter(column > F.lit(watermark).cast(kind))
