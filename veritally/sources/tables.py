"""Snapshot folders of column files, and tables and views by name."""

from __future__ import annotations

import logging
from collections.abc import Mapping
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from veritally.sources import versions

logger = logging.getLogger(__name__)

SNAPSHOT = "transaction_time"


def snapshot_path(root: str, resource: str, transaction_time: str) -> str:
    return f"{root}/{resource}/{SNAPSHOT}={quote(transaction_time, safe='')}"


def write_snapshot(
    df: DataFrame, root: str, resource: str, transaction_time: str, rows_per_file: int = 0
) -> str:
    """Write one snapshot as Parquet, replacing the whole earlier snapshot of that time.

    Part files are as many as the tasks that wrote them; ``rows_per_file`` bounds each one.
    """
    path = snapshot_path(root, resource, transaction_time)
    writer = df.write.mode("overwrite")
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.parquet(path)
    return path


def read_snapshots(
    spark: SparkSession,
    root: str,
    resource: str,
    schema: T.StructType,
    transaction_time: str | None = None,
) -> DataFrame:
    """All snapshots of a resource, or one; of a named snapshot only its own folder is listed."""
    if transaction_time is not None:
        return spark.read.schema(schema).parquet(snapshot_path(root, resource, transaction_time))
    full = T.StructType([*schema.fields, T.StructField(SNAPSHOT, T.StringType())])
    return spark.read.schema(full).parquet(f"{root}/{resource}")


def load_table(
    spark: SparkSession,
    paths: str | list[str],
    table: str,
    schema: T.StructType | None = None,
    location: str | None = None,
) -> DataFrame:
    """Replace a table by the Parquet files at ``paths`` (globs allowed) and return it.

    Without ``schema`` the types are those stored in the files. The number of rows is logged.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    rows = reader.parquet(*([paths] if isinstance(paths, str) else paths))
    return save_table(rows, table, location)


def save_table(df: DataFrame, table: str, location: str | None = None) -> DataFrame:
    """Materialise ``df`` as a table (at ``location`` if given), replacing it, and return it.

    The rows go to a new version, and the table points to it once all are stored. Who has the
    table open keeps the old version; a job that fails leaves it in place.
    """
    spark = df.sparkSession
    location = location or table_location(spark, table)
    rows = versions.publish(df, location)
    logger.info("table %s: %d rows", table, rows)
    return open_table(spark, table, location)


def table_location(spark: SparkSession, table: str) -> str:
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{table}.versions"


def open_table(spark: SparkSession, table: str, location: str | None = None) -> DataFrame:
    """Point the name to the present version at its location, which the commit log there knows, and return it."""
    location = location or table_location(spark, table)
    found = versions.read_current(spark, location)
    if found is None:
        raise FileNotFoundError(f"no version of {table} was stored at {location}")
    path, kinds = versions.current_folder(spark, location), found.schema.simpleString()
    if spark.catalog.tableExists(table) and spark.table(table).schema.simpleString() == kinds:
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{path.replace(chr(39), chr(92) + chr(39))}'")
    else:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        spark.catalog.createTable(table, path, "parquet", found.schema)
    spark.catalog.refreshTable(table)
    return spark.table(table)


def save_view(df: DataFrame, name: str) -> DataFrame:
    """Bind ``df`` to a view: always fresh, computed when read."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def materialise(df: DataFrame, name: str, kind: str = "view", location: str | None = None) -> DataFrame:
    """Staging and intermediate models are views, marts are tables."""
    if kind == "view":
        return save_view(df, name)
    if kind == "table":
        return save_table(df, name, location)
    raise ValueError(f"kind must be 'view' or 'table', got {kind!r}")


def bind_sources(tables: Mapping[str, DataFrame], prefix: str = "silver") -> None:
    """Bind frames as the source tables ``<prefix>_<name>``."""
    for name, df in tables.items():
        df.createOrReplaceTempView(f"{prefix}_{name}")


def source(spark: SparkSession, name: str, prefix: str = "silver") -> DataFrame:
    return spark.table(f"{prefix}_{name}")
