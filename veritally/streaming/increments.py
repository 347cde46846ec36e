"""Landed records to silver, as they arrive.

Each micro-batch is written to a fresh folder and committed under its number, so a restart neither
loses nor repeats records: a batch whose number is committed is not written again, and what a
failed attempt left is named by no commit. The batch that completes ``FAN_IN`` parts of one level is
written together with them, within its own commit, as a part of the next level, or of the level
after where it completes that one too: reads touch at most ``FAN_IN - 1`` parts of each level, and a
record is rewritten once a level at most. A snapshot that lands again arrives as new files; by key,
the latest row of each record stays.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from veritally.operators.flatten import FLATTEN
from veritally.operators.latest import latest_by_key, upsert
from veritally.sources import files
from veritally.sources.landing import FILE_PATTERN
from veritally.sources.schemas import RESOURCES
from veritally.sources.versions import counted_write, fresh_folder, log_of, remove_unnamed, schema_of

BATCH = "batch_id"
FAN_IN = 8
VERSION = "version"
SEED = 7


def stream_ndjson(
    spark: SparkSession,
    landing: str,
    schema: T.StructType,
    files_per_batch: int | None = None,
    spread: bool = False,
) -> DataFrame:
    """A stream of the files landing below a folder.

    A compressed file has a single reader. With ``spread`` readers only split lines and deal them out,
    and all cores parse them, which pays where a batch has fewer files than there are cores. The rows
    are the same, but what a text column finds instead of text, such as an array, is written anew.
    """
    reader = spark.readStream.option("pathGlobFilter", FILE_PATTERN).option("recursiveFileLookup", True)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if not spread:
        return reader.schema(schema).option("mode", "FAILFAST").json(landing)
    return parse_lines(reader.text(landing).repartition(spark.sparkContext.defaultParallelism, F.rand(SEED)), schema)


def parse_lines(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """The records of JSON lines, as the strict JSON reader finds them.

    A blank line has none, an array one for each element; a malformed line fails the job.
    """
    strict, text = {"mode": "FAILFAST"}, F.validate_utf8(lines.columns[0])
    start = F.substring(F.ltrim(text, F.lit(" \t\r\n")), 1, 1)
    found = F.when(start == "[", F.from_json(text, "array<string>", strict)).when(start != "", F.array(text))
    one = F.coalesce(F.col("text"), F.lit("null"))  # an element that is null is malformed
    parsed = lines.select(F.explode(found).alias("text")).select(F.from_json(one, schema, strict).alias("record"))
    return parsed.select("record.*")


def write_batches(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    transform=None,
    keys: Sequence[str] = (),
    order: str = "last_updated",
    fan_in: int = FAN_IN,
) -> StreamingQuery:
    """Process all that has landed, then stop; call it again for what lands later.

    With ``keys`` merged parts hold the latest row of each key, without them all rows.
    """
    log = log_of(stream.sparkSession, path)

    def write(batch: DataFrame, number: int) -> None:
        spark, source = batch.sparkSession, json.loads(files.read_text(batch.sparkSession, f"{checkpoint}/metadata"))["id"]
        found = log.latest()
        parts = found[1]["parts"] if found else []
        if found and found[1]["stream"] != source:
            raise ValueError(f"{path} holds the batches of another stream than {checkpoint}")
        if found and found[0] >= number:
            return
        rows = (transform(batch) if transform else batch).withColumn(BATCH, F.lit(number).cast("long"))
        schema, level, others = rows.schema, 0, []
        while [p["level"] for p in parts[1 - fan_in :]] == [level] * (fan_in - 1):
            parts, others, level = parts[: 1 - fan_in], [*parts[1 - fan_in :], *others], level + 1
        if others:
            rows = _read_parts(spark, path, others, schema).unionByName(rows)
            if keys:
                rows = latest_by_key(rows, keys, order, (BATCH,))
        folder = fresh_folder(f"level-{level}")
        part = {"level": level, "folder": folder, "rows": counted_write(rows, f"{path}/{folder}")}
        log.append(number, {"parts": [*parts, part], "stream": source, "schema": schema.json()})

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _read_parts(spark: SparkSession, path: str, parts: Sequence[dict], schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(*[f"{path}/{p['folder']}" for p in parts])


def stream_resource(
    spark: SparkSession,
    landing_root: str,
    resource: str,
    silver_root: str,
    checkpoint: str,
    files_per_batch: int | None = None,
    keys: Sequence[str] = (),
) -> StreamingQuery:
    """Flatten the records of a resource into silver as they land."""
    stream = stream_ndjson(spark, f"{landing_root}/{resource}", RESOURCES[resource], files_per_batch)
    return write_batches(stream, f"{silver_root}/{resource}", checkpoint, FLATTEN[resource], keys)


def read_batches(
    spark: SparkSession, path: str, schema: T.StructType | None = None, keys: Sequence[str] = (), order: str = "last_updated"
) -> DataFrame:
    """Everything the batches wrote; with ``keys`` the latest row of each, of equal ones the last to arrive.

    Without ``schema`` the columns are those of the last batch.
    """
    found = log_of(spark, path).latest()
    if found is None:
        if schema is None:
            raise FileNotFoundError(f"no batch was written to {path}")
        return spark.createDataFrame([], schema)
    full = schema_of(found[1]) if schema is None else T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())])
    rows = _read_parts(spark, path, found[1]["parts"], full)
    return (latest_by_key(rows, keys, order, (BATCH,)) if keys else rows).drop(BATCH)


def parts_of(spark: SparkSession, path: str) -> list[dict]:
    """Level, folder and rows of the parts that a read touches, oldest first."""
    found = log_of(spark, path).latest()
    return found[1]["parts"] if found else []


def vacuum_batches(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Remove the folders that none of the last ``keep`` commits names; not to be run beside a stream."""
    named = {p["folder"] for e in log_of(spark, path).expire(keep) for p in e["parts"]}
    return remove_unnamed(spark, path, named)


def merge_increment(
    current: DataFrame | None,
    increment: DataFrame,
    keys: list[str],
    order: str = "last_updated",
    tie: tuple[str, ...] = (),
    mode: str = "snapshot",
) -> DataFrame:
    """The table after an increment.

    ``snapshot`` replaces the table, which is right only if the increment holds every record.
    ``upsert`` keeps the records the increment does not mention, and the latest row per key.
    """
    if mode == "snapshot":
        return increment
    if mode == "upsert":
        return upsert(current, increment, keys, order, tie)
    raise ValueError(f"mode must be 'snapshot' or 'upsert', got {mode!r}")


def write_version(df: DataFrame, path: str, version: int) -> DataFrame:
    """Store a table as a numbered version, so that it may be computed from the one before."""
    target = f"{path}/{VERSION}={version}"
    df.write.mode("overwrite").parquet(target)
    return df.sparkSession.read.schema(df.schema).parquet(target)


def with_landing_time(df: DataFrame) -> DataFrame:
    """The transaction time of each record, taken from the folder it landed in.

    Folder names escape characters such as the colon, and file paths escape folder names again.
    """
    folder = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)/[^/]+$", 1)
    for _ in range(2):
        folder = F.url_decode(F.replace(folder, F.lit("+"), F.lit("%2B")))
    return df.withColumn("transaction_time", folder)
