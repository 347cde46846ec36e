"""Tables that are replaced as a whole: a folder for each version, and a commit that names the present one."""

from __future__ import annotations

import logging
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veritally.sources import files
from veritally.sources.commits import CommitLog

logger = logging.getLogger(__name__)

LOG = "_commits"


def log_of(spark: SparkSession, location: str) -> CommitLog:
    return CommitLog(spark, f"{location}/{LOG}")


def fresh_folder(prefix: str = "v") -> str:
    return f"{prefix}-{uuid.uuid4().hex}"


def counted_write(df: DataFrame, path: str, *partition_by: str) -> int:
    """Write Parquet and return the number of rows, counted while they are written."""
    seen = Observation()
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return seen.get["rows"]


def publish(df: DataFrame, location: str) -> int:
    """Make ``df`` the table at ``location``; return its number of rows.

    Until the commit, and if the job fails before it, readers have the version before. ``df`` may
    be computed from that version.
    """
    spark, folder = df.sparkSession, fresh_folder()
    log = log_of(spark, location)
    before = log.latest()
    rows = counted_write(df, f"{location}/{folder}")
    log.append(before[0] + 1 if before else 0, {"folder": folder, "rows": rows, "schema": df.schema.json()})
    logger.info("%s: %d rows", location, rows)
    return rows


def current_folder(spark: SparkSession, location: str) -> str | None:
    found = log_of(spark, location).latest()
    return f"{location}/{found[1]['folder']}" if found else None


def read_current(spark: SparkSession, location: str) -> DataFrame | None:
    """The present version, or None where nothing was published."""
    found = log_of(spark, location).latest()
    if found is None:
        return None
    return spark.read.schema(schema_of(found[1])).parquet(f"{location}/{found[1]['folder']}")


def schema_of(entry: dict) -> T.StructType:
    import json

    return T.StructType.fromJson(json.loads(entry["schema"]))


def remove_unnamed(spark: SparkSession, location: str, named: set[str]) -> list[str]:
    """Remove the folders of a location that ``named`` does not hold; return their names."""
    gone = [name for name, _, _ in files.listed(spark, location) if name != LOG and name not in named]
    for name in gone:
        files.remove(spark, f"{location}/{name}")
    return gone


def vacuum(spark: SparkSession, location: str, keep: int = 2) -> list[str]:
    """Remove all but the last ``keep`` versions and what failed jobs left behind.

    Not to be run beside a writer, whose folder no commit names yet.
    """
    return remove_unnamed(spark, location, {e["folder"] for e in log_of(spark, location).expire(keep)})
