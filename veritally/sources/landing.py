"""Landed line-delimited JSON, one folder per resource and transaction time."""

from __future__ import annotations

import hashlib
import logging
from urllib.parse import quote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veritally.sources import files
from veritally.sources.schemas import RESOURCES

logger = logging.getLogger(__name__)

# Downloads end in .ndjson; lines landed by a Spark text write end in .txt. Both may be compressed.
FILE_PATTERN = "*.{ndjson,txt,ndjson.gz,txt.gz}"
ENDINGS = (".ndjson", ".txt", ".ndjson.gz", ".txt.gz")
# Records repeat their field names and codes: landed lines shrink to about a twentieth.
COMPRESSION = "gzip"
# A compressed file is read by one task, so that what one task lands goes to several files.
LINES_PER_FILE = 250_000
CORRUPT = "_corrupt_record"


def landing_path(root: str, resource: str, transaction_time: str) -> str:
    """Where a snapshot is landed. Colons are escaped, because not every file system has them."""
    return f"{root}/{resource}/{quote(transaction_time, safe='')}/"


def read_ndjson(
    spark: SparkSession,
    root: str,
    resource: str,
    transaction_time: str,
    schema: T.StructType | None = None,
    strict: bool = True,
) -> DataFrame | None:
    """The records of one snapshot, or None (with a warning) where no file has landed.

    The folder may be named by the transaction time as it is, or escaped. Blank lines are skipped.
    A malformed line fails the job; with ``strict`` off it is a row of nulls whose column
    ``CORRUPT`` holds the line, which is null in all other rows.
    """
    kinds = schema or RESOURCES[resource]
    if not strict:
        kinds = T.StructType([*kinds.fields, T.StructField(CORRUPT, T.StringType())])
    reader = (
        spark.read.schema(kinds)
        .option("mode", "FAILFAST" if strict else "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("pathGlobFilter", FILE_PATTERN)
    )
    escaped = landing_path(root, resource, transaction_time)
    for path in dict.fromkeys((escaped, f"{root}/{resource}/{transaction_time}/")):
        try:
            records = reader.json(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            continue
        if has_files(spark, path):
            return records
    logger.warning("no %s records landed for %s", resource, transaction_time)
    return None


def has_files(spark: SparkSession, path: str) -> bool:
    """Whether the folder holds a landed file; the listing stops at the first one."""
    java = spark._jvm.org.apache.hadoop.fs
    at = java.Path(path)
    system = at.getFileSystem(spark._jsc.hadoopConfiguration())
    found, wanted = system.listStatusIterator(at), java.GlobFilter(FILE_PATTERN)
    while found.hasNext():
        entry = found.next()
        if entry.isFile() and wanted.accept(entry.getPath()):
            return True
    return False


def landed_state(spark: SparkSession, root: str, resource: str, transaction_time: str) -> str | None:
    """A digest of the names, sizes and times of what has landed; None where nothing has."""
    for path in (landing_path(root, resource, transaction_time), f"{root}/{resource}/{transaction_time}/"):
        found = files.listed(spark, path)
        if any(name.endswith(ENDINGS) for name, _, _ in found):
            return hashlib.sha256(repr([f for f in found if f[0].endswith(ENDINGS)]).encode()).hexdigest()
    return None


def land_ndjson(
    lines: DataFrame, root: str, resource: str, transaction_time: str, lines_per_file: int = 0
) -> str:
    """Land a one-column frame of JSON lines, replacing whatever this snapshot held before.

    Landing the same transaction time twice leaves one copy, however the files are named. Files are
    compressed and hold ``lines_per_file`` lines at most, ``LINES_PER_FILE`` where none is given; below
    zero every task lands one file.
    """
    path = landing_path(root, resource, transaction_time)
    writer = lines.select(F.col(lines.columns[0]).alias("value")).write.mode("overwrite")
    writer = writer.option("maxRecordsPerFile", lines_per_file or LINES_PER_FILE)
    writer.option("compression", COMPRESSION).text(path)
    return path
