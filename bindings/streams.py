"""Files that arrive as a stream, and increments merged into what was there."""

from __future__ import annotations

from pyspark.sql import Observation
from pyspark.sql import functions as F

from bindings.base import query
from bindings.claims import COVERAGE_FIELDS, coverages, lines, patients, records
from veritally.operators.flatten import flatten_coverage
from veritally.session import scratch_path
from veritally.sources.landing import land_ndjson
from veritally.sources.schemas import RESOURCES, SILVER_COVERAGE, SILVER_PATIENT
from veritally.streaming import increments

SPLIT = "2024-01-15 00:00:00"


def _run(stream_query):
    stream_query.awaitTermination()


@query("SELECT CAST(c_custkey AS VARCHAR) AS patient_id, c_name AS mbi FROM customer")
def stream_to_silver(t):
    """Two increments land and are processed one after the other, exactly once."""
    root = scratch_path(t.spark, "stream")
    json = lines(patients(t))
    deceased = F.get_json_object("value", "$.deceasedBoolean") == "true"
    for time, part in (("2024-01-01", json.filter(deceased)), ("2024-01-02", json.filter(~deceased))):
        land_ndjson(part, f"{root}/bronze", "Patient", time)
        _run(
            increments.stream_resource(
                t.spark, f"{root}/bronze", "Patient", f"{root}/silver", f"{root}/checkpoint", 2
            )
        )
    stored = increments.read_batches(t.spark, f"{root}/silver/Patient", SILVER_PATIENT)
    return stored.select("patient_id", "mbi")


@query("SELECT CAST(c_custkey AS VARCHAR) AS patient_id, c_name AS mbi FROM customer")
def stream_relanded(t):
    """A snapshot that lands twice, and is streamed after each landing, counts once."""
    root = scratch_path(t.spark, "stream")
    for _ in range(2):
        land_ndjson(lines(patients(t)), f"{root}/bronze", "Patient", "2024-01-01")
        _run(
            increments.stream_resource(
                t.spark, f"{root}/bronze", "Patient", f"{root}/silver", f"{root}/checkpoint", 2
            )
        )
    stored = increments.read_batches(t.spark, f"{root}/silver/Patient", SILVER_PATIENT, ["patient_id"])
    return stored.select("patient_id", "mbi")


@query("SELECT strftime(o_orderdate, '%Y') || '-11-12T12:10:07.068Z' AS transaction_time, count(*) AS records FROM orders GROUP BY 1")
def stream_landing_times(t):
    """The folder of a record tells when it landed."""
    root = scratch_path(t.spark, "stream")
    json = lines(coverages(t)).withColumn(
        "transaction_time",
        F.concat(F.substring(F.get_json_object("value", "$.meta.lastUpdated"), 1, 4), F.lit("-11-12T12:10:07.068Z")),
    )
    # One write lands all snapshots, each in its own folder.
    json.write.partitionBy("transaction_time").text(f"{root}/bronze/Coverage")
    stream = increments.stream_ndjson(t.spark, f"{root}/bronze/Coverage", SILVER_COVERAGE)
    timed = increments.with_landing_time(stream)
    _run(increments.write_batches(timed, f"{root}/times", f"{root}/checkpoint"))
    stored = increments.read_batches(t.spark, f"{root}/times")
    year = F.regexp_replace("transaction_time", "^.*=", "")
    return stored.groupBy(year.alias("transaction_time")).agg(F.count(F.lit(1)).alias("records"))


@query(
    """SELECT user_id, event_id, ts, event_type FROM events
       QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"""
)
def keyed_upsert(t):
    """A later increment merged into the latest event per user of what came before."""
    events = t("events").select("user_id", "event_id", "ts", "event_type")
    before, after = events.filter(F.col("ts") < SPLIT), events.filter(F.col("ts") >= SPLIT)
    path = scratch_path(t.spark, "upsert")
    first = increments.merge_increment(None, before, ["user_id"], "ts", ("event_id",), "upsert")
    current = increments.write_version(first, path, 1)
    return increments.merge_increment(current, after, ["user_id"], "ts", ("event_id",), "upsert")


@query(
    """SELECT CAST(o_orderkey AS VARCHAR) AS coverage_id, CASE WHEN o_orderstatus = 'F' THEN 'ended' ELSE 'active' END AS status,
       true AS few_parts, true AS merged_by_key FROM orders"""
)
def stream_compacted(t):
    """Many small batches, some of which change earlier records, merged level by level: the latest row of each record."""
    root = scratch_path(t.spark, "stream")
    # The flat rows are dealt out, as the records made of them are ten times as wide.
    first = records(t.split("orders").repartition(9), "Coverage", COVERAGE_FIELDS)
    ended = F.struct(F.lit("2025-01-01T00:00:00Z").alias("lastUpdated"))
    changed = first.filter(F.col("extension")[0]["valueCoding"]["code"] == "F").withColumns({"status": F.lit("ended"), "meta": ended})
    landed = 0
    for time, part in (("2024-01-01", first), ("2025-01-01", changed)):
        seen = Observation()
        counted = lines(part).observe(seen, F.count(F.lit(1)).alias("lines"))
        land_ndjson(counted, f"{root}/bronze", "Coverage", time, lines_per_file=-1)
        landed += seen.get["lines"]
        run = increments.stream_ndjson(t.spark, f"{root}/bronze/Coverage", RESOURCES["Coverage"], 1, spread=True)
        _run(
            increments.write_batches(
                run, f"{root}/silver", f"{root}/checkpoint", flatten_coverage, ["coverage_id"], fan_in=4
            )
        )
    parts = increments.parts_of(t.spark, f"{root}/silver")
    few = len(parts) <= 3 * (1 + max(p["level"] for p in parts))
    stored = increments.read_batches(t.spark, f"{root}/silver", SILVER_COVERAGE, ["coverage_id"])
    merged = sum(p["rows"] for p in parts) < landed
    return stored.select("coverage_id", "status", F.lit(few).alias("few_parts"), F.lit(merged).alias("merged_by_key"))


@query(f"SELECT user_id, event_id, ts FROM events WHERE ts >= TIMESTAMP '{SPLIT}'")
def snapshot_replacement(t):
    """In snapshot mode the increment replaces what came before."""
    events = t("events").select("user_id", "event_id", "ts")
    before, after = events.filter(F.col("ts") < SPLIT), events.filter(F.col("ts") >= SPLIT)
    return increments.merge_increment(before, after, ["event_id"], mode="snapshot")
