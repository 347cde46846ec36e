"""Landing, snapshots, tables, views and the watermark, written and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings.base import query
from bindings.claims import (
    CLAIMS_BY_TYPE_SQL,
    coverages,
    eobs,
    fct_claims,
    lines,
    patients,
    stg_eob,
    wall_clock,
)
from veritally.operators.flatten import flatten_coverage, flatten_eob, flatten_patient
from veritally.plans.build import build, build_increment, dashboard_queries
from veritally.plans.dashboards import duplicate_multiplicity
from veritally.session import scratch_path
from veritally.sources import landing, tables, watermark
from veritally.sources.commits import CommitLog
from veritally.sources.keyed import KeyedTable, bucket_of
from veritally.sources.schemas import SILVER_PATIENT

TIME = "2024-01-20T10:00:00.000Z"


def landed(t, json, resource: str, times: int = 1, lines_per_file: int = 0):
    """The records of a snapshot after landing it ``times`` times over."""
    root = scratch_path(t.spark, "bronze")
    for _ in range(times):
        landing.land_ndjson(json, root, resource, TIME, lines_per_file)
    return landing.read_ndjson(t.spark, root, resource, TIME)


@query(
    """SELECT CAST(o_orderkey AS VARCHAR) AS eob_id, o_totalprice AS total_amount,
       CASE WHEN o_orderstatus <> 'P' THEN o_totalprice ELSE 0.0 END AS total_payment FROM orders"""
)
def ndjson_read(t):
    records = landed(t, lines(eobs(t)), "ExplanationOfBenefit")
    return flatten_eob(records).select("eob_id", "total_amount", "total_payment")


@query(
    """SELECT CAST(c_custkey AS VARCHAR) AS patient_id, c_name AS mbi, c_acctbal < 0 AS deceased FROM customer"""
)
def snapshot_overwrite(t):
    root = scratch_path(t.spark, "silver")
    stored = flatten_patient(landed(t, lines(patients(t)), "Patient"))
    for _ in range(2):
        tables.write_snapshot(stored, root, "Patient", TIME)
    stored = tables.read_snapshots(t.spark, root, "Patient", SILVER_PATIENT, TIME)
    return stored.select("patient_id", "mbi", "deceased")


@query(
    """SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_extendedprice), 2) AS total
       FROM lineitem GROUP BY 1, 2"""
)
def snapshot_parts(t):
    """Many part files, written twice, leave one copy of every row."""
    root = scratch_path(t.spark, "silver")
    table = t("lineitem")
    for _ in range(2):
        tables.write_snapshot(table, root, "lines", TIME, rows_per_file=10_000)
    stored = tables.read_snapshots(t.spark, root, "lines", table.schema, TIME)
    return stored.groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("l_extendedprice"), 2).alias("total")
    )


@query("SELECT CAST(1 AS BIGINT) AS copies, count(*) AS key_count FROM orders")
def landing_is_idempotent(t):
    records = landed(t, lines(eobs(t)), "ExplanationOfBenefit", times=3, lines_per_file=5_000)
    return duplicate_multiplicity(records, ["id"])


@query("SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def table_load(t):
    orders = t("orders")
    location = scratch_path(t.spark, "table")
    loaded = tables.load_table(t.spark, t.path("orders"), "loaded_orders", orders.schema, location)
    return loaded.select("o_orderkey", "o_orderstatus", "o_totalprice")


@query("SELECT event_id, ts, event_type FROM events WHERE ts > TIMESTAMP '2024-01-20 10:00:00'")
def watermark_filter(t):
    path = scratch_path(t.spark, "watermark")
    assert watermark.read_watermark(t.spark, path) is None
    watermark.write_watermark(t.spark, path, TIME)
    watermark.write_watermark(t.spark, path, None)
    since = watermark.read_watermark(t.spark, path)
    return watermark.since_watermark(t("events"), "ts", since).select("event_id", "ts", "event_type")


@query(
    """SELECT c_mktsegment, count(*) AS orders, round(sum(o_totalprice), 2) AS total
       FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1"""
)
def named_sources(t):
    tables.bind_sources({"orders": t("orders"), "customer": t("customer")})
    orders, customers = (tables.source(t.spark, name) for name in ("orders", "customer"))
    joined = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    return joined.groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )


@query(
    """SELECT CAST(o_orderkey AS VARCHAR) AS eob_id, o_totalprice AS total_amount,
       CAST(o_orderdate AS DATE) AS service_start_date FROM orders"""
)
def materialised_models(t):
    """Staging as a view, the mart as a table computed from it."""
    tables.materialise(stg_eob(t), "stg_eob_view", "view")
    claims = fct_claims(t).select("eob_id", "total_amount", "service_start_date")
    stored = tables.materialise(claims, "fct_claims_table", "table", scratch_path(t.spark, "mart"))
    staged = tables.save_view(t.spark.table("stg_eob_view").select("eob_id"), "stg_ids")
    return wall_clock(stored.join(staged, "eob_id", "left_semi"))


@query(CLAIMS_BY_TYPE_SQL)
def build_from_landing(t):
    """Landed JSON to silver files, models, stored marts and a dashboard query over them."""
    root = scratch_path(t.spark, "build")
    landed_records = {"Patient": patients(t), "Coverage": coverages(t), "ExplanationOfBenefit": eobs(t)}
    for resource, nested in landed_records.items():
        landing.land_ndjson(lines(nested), f"{root}/bronze", resource, TIME)
    models = build(t.spark, f"{root}/bronze", f"{root}/silver", f"{root}/marts", TIME)
    return wall_clock(dashboard_queries(models)["claims_by_type"])


@query(CLAIMS_BY_TYPE_SQL)
def build_in_increments(t):
    """A first snapshot, then the claims that came later, merged by the watermark: the marts of all of them."""
    root = scratch_path(t.spark, "increments")
    early = F.crc32(F.col("id").cast("string")) % 2 == 0
    parts = {"Patient": patients(t), "Coverage": coverages(t), "ExplanationOfBenefit": eobs(t).filter(early)}
    for resource, nested in parts.items():
        landing.land_ndjson(lines(nested), f"{root}/bronze", resource, TIME)
    folders = (f"{root}/bronze", f"{root}/silver", f"{root}/marts")
    build_increment(t.spark, *folders, TIME)
    later = "2025-11-13T12:10:07.068Z"
    landing.land_ndjson(lines(eobs(t).filter(~early)), f"{root}/bronze", "ExplanationOfBenefit", later)
    return wall_clock(dashboard_queries(build_increment(t.spark, *folders, later))["claims_by_type"])


LATEST = "(SELECT max(o_orderdate) FROM orders)"


@query(
    f"""SELECT o_orderkey, o_custkey, o_orderdate, CASE WHEN o_orderdate = {LATEST} THEN 'X' ELSE o_orderstatus END AS status,
        true AS others_untouched FROM orders
        UNION ALL SELECT -o_orderkey, o_custkey, o_orderdate, 'N', true FROM orders WHERE o_orderdate = {LATEST}"""
)
def upsert_by_bucket(t):
    """Orders of the last day changed and some new ones: only the buckets of these keys are written again."""
    orders = t("orders").select("o_orderkey", "o_custkey", "o_orderdate", F.col("o_orderstatus").alias("status"))
    table = KeyedTable(t.spark, scratch_path(t.spark, "keyed"), ["o_orderkey"], "o_orderdate", ("status",), buckets=256)
    table.replace(orders)
    last = orders.join(orders.agg(F.max("o_orderdate").alias("o_orderdate")), "o_orderdate").select(*orders.columns)
    changed = last.withColumn("status", F.lit("X"))
    new = last.withColumns({"o_orderkey": -F.col("o_orderkey"), "status": F.lit("N")})
    before, increment = table.entry()["folders"], changed.unionByName(new)
    table.upsert(increment)
    after, touched = table.entry()["folders"], increment.select(bucket_of(["o_orderkey"], 256)).distinct().collect()
    rewritten = {b for b, (old, now) in enumerate(zip(before, after, strict=True)) if old != now}
    return table.read().withColumn("others_untouched", F.lit(rewritten == {r[0] for r in touched}))


@query("SELECT o_orderstatus, count(*) AS orders, false AS replaced FROM orders GROUP BY 1")
def table_survives_failure(t):
    """A job that fails while it replaces a table leaves the table as it was."""
    location = scratch_path(t.spark, "table")
    kept = tables.save_table(t("orders").select("o_orderkey", "o_orderstatus"), "kept_orders", location)
    broken = kept.withColumn("o_orderstatus", F.raise_error(F.lit("no more rows")).cast("string"))
    try:
        tables.save_table(broken, "kept_orders", location)
        replaced = True
    except Exception:
        replaced = False
    found = tables.open_table(t.spark, "kept_orders", location).groupBy("o_orderstatus")
    return found.agg(F.count(F.lit(1)).alias("orders"), F.lit(replaced).alias("replaced"))


@query("SELECT '2024-01-20T10:00:00.000Z' AS watermark, true AS refused, CAST(1 AS BIGINT) AS loads, count(*) AS later FROM events WHERE ts > TIMESTAMP '2024-01-20 10:00:00'")
def watermark_never_goes_back(t):
    """An earlier time is refused, and the same time again adds nothing to the log."""
    path = scratch_path(t.spark, "watermark")
    watermark.write_watermark(t.spark, path, TIME)
    watermark.write_watermark(t.spark, path, TIME)
    try:
        watermark.write_watermark(t.spark, path, "2023-01-20T10:00:00.000Z")
        refused = False
    except watermark.LoadInThePast:
        refused = True
    since, loads = watermark.read_watermark(t.spark, path), len(CommitLog(t.spark, path).numbers())
    later = watermark.since_watermark(t("events"), "ts", since).agg(F.count(F.lit(1)).alias("later"))
    known = {"watermark": F.lit(since), "refused": F.lit(refused), "loads": F.lit(loads).cast("long")}
    return later.withColumns(known)


@query(
    """SELECT 'string' AS period_start_type, 'string' AS dual_eligible_type, count(*) AS records,
       CAST(0 AS BIGINT) AS period_starts, count(*) FILTER (WHERE o_totalprice > 200000) AS dual_eligibles
       FROM orders"""
)
def typed_sparse_columns(t):
    """A column that is null in every record is read as text all the same."""
    coverage = flatten_coverage(landed(t, lines(coverages(t)), "Coverage"))
    kinds = dict(coverage.dtypes)
    return coverage.agg(
        F.lit(kinds["period_start"]).alias("period_start_type"),
        F.lit(kinds["dual_eligible"]).alias("dual_eligible_type"),
        F.count(F.lit(1)).alias("records"),
        F.count("period_start").alias("period_starts"),
        F.count("dual_eligible").alias("dual_eligibles"),
    )
