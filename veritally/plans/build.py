"""From landed records to stored marts, in one call each for silver, models and dashboards."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from veritally.operators.flatten import FLATTEN
from veritally.plans import dashboards, intermediate, marts, staging
from veritally.sources import landing, tables, watermark
from veritally.sources.commits import CommitLog
from veritally.sources.keyed import KeyedTable

VIEWS = ("stg_patient", "stg_coverage", "stg_eob", "int_eob_diagnoses")
MARTS = ("dim_patient", "fct_claims", "fct_coverage")
KEYS = {"Patient": "patient_id", "Coverage": "coverage_id", "ExplanationOfBenefit": "eob_id"}


LOADS = "_loads"  # the log of all loads, below the silver root


def silver_table(spark: SparkSession, silver_root: str, resource: str) -> KeyedTable:
    return KeyedTable(spark, f"{silver_root}/{resource}", [KEYS[resource]], "last_updated")


def read_silver(spark: SparkSession, silver_root: str, versions: Mapping[str, int] | None = None) -> dict[str, DataFrame]:
    """Silver as the last load left it, or at the given versions: all resources of one load, never of two."""
    if versions is None:
        found = watermark.last_load(spark, f"{silver_root}/{LOADS}")
        versions = found[1]["silver"] if found else {}
    return {r: silver_table(spark, silver_root, r).read(v) for r, v in versions.items()}


def store_snapshot(spark: SparkSession, landing_root: str, silver_root: str, transaction_time: str) -> dict[str, int]:
    """Flatten every landed resource of a snapshot into a new version of its silver; return the versions.

    A resource that has not landed is left out.
    """
    stored = {}
    for resource, flatten in FLATTEN.items():
        records = landing.read_ndjson(spark, landing_root, resource, transaction_time)
        if records is not None:
            stored[resource] = silver_table(spark, silver_root, resource).replace(flatten(records))
    return stored


def store_increment(
    spark: SparkSession, landing_root: str, silver_root: str, base: Mapping[str, int], transaction_time: str
) -> dict[str, int]:
    """Merge what landed as changes into the versions of ``base``: the latest row of each record.

    Only the buckets of changed records are rewritten; a resource that has not landed stays at its
    version, and nothing of it is read.
    """
    stored = dict(base)
    for resource, flatten in FLATTEN.items():
        records = landing.read_ndjson(spark, landing_root, resource, transaction_time)
        if records is not None:
            table = silver_table(spark, silver_root, resource)
            stored[resource] = table.upsert(flatten(records), base[resource])
    return stored


def load_silver(
    spark: SparkSession, landing_root: str, silver_root: str, transaction_time: str
) -> dict[str, DataFrame]:
    """``store_snapshot``, and what it stored."""
    return read_silver(spark, silver_root, store_snapshot(spark, landing_root, silver_root, transaction_time))


def staged(silver: Mapping[str, DataFrame], loaded_at=None) -> dict[str, DataFrame]:
    eob = staging.stg_eob(silver["ExplanationOfBenefit"], loaded_at)
    return {
        "stg_patient": staging.stg_patient(silver["Patient"], loaded_at),
        "stg_coverage": staging.stg_coverage(silver["Coverage"], loaded_at),
        "stg_eob": eob,
        "int_eob_diagnoses": intermediate.int_eob_diagnoses(eob),
    }


def save_models(silver: Mapping[str, DataFrame], location: str, loaded_at=None) -> dict[str, DataFrame]:
    """Staging and intermediate models as views, marts as tables below ``location``.

    Each mart is computed from the stored ones before it, so nothing is computed twice.
    """
    models = {n: tables.materialise(df, n, "view") for n, df in staged(silver, loaded_at).items()}

    def store(name: str, df: DataFrame) -> DataFrame:
        models[name] = tables.materialise(df, name, "table", f"{location}/{name}")
        return models[name]

    people = store("dim_patient", marts.dim_patient(models["stg_patient"], models["stg_coverage"]))
    store("fct_claims", marts.fct_claims(models["stg_eob"], people))
    store("fct_coverage", marts.fct_coverage(models["stg_coverage"], models["stg_eob"]))
    return models


def dashboard_queries(models: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Every dashboard query over the models, not yet run."""
    people, claims, coverage = (models[name] for name in MARTS)
    diagnoses = intermediate.int_eob_diagnoses(models["stg_eob"], dashboards.DIAGNOSIS_COUNT_COLUMNS)
    return {
        "population_overview": dashboards.population_overview(people),
        "gender_distribution": dashboards.gender_distribution(people),
        "race_distribution": dashboards.race_distribution(people),
        "claims_summary": dashboards.claims_summary(claims),
        "claims_by_type": dashboards.claims_by_type(claims),
        "top_diagnoses": dashboards.top_diagnoses(diagnoses),
        "monthly_claim_volume": dashboards.monthly_claim_volume(claims),
        "medicare_part_distribution": dashboards.medicare_part_distribution(coverage),
        "enrollment_activity": dashboards.enrollment_activity(coverage),
        "dual_eligibility": dashboards.dual_eligibility(coverage),
    }


def stored_models(spark: SparkSession, silver_root: str, location: str) -> dict[str, DataFrame]:
    """The models of the last load: the views over its silver, the marts as they are stored."""
    models = {n: tables.materialise(df, n, "view") for n, df in staged(read_silver(spark, silver_root)).items()}
    return models | {name: tables.open_table(spark, name, f"{location}/{name}") for name in MARTS}


def build(
    spark: SparkSession, landing_root: str, silver_root: str, mart_root: str, transaction_time: str
) -> dict[str, DataFrame]:
    """Silver, models and marts of one snapshot; the load is logged last, once all is stored.

    The same time again replaces what the first run stored; a time before the last load is refused.
    """
    log = f"{silver_root}/{LOADS}"
    last = watermark.last_load(spark, log)
    if last is None:
        # Tells a first load that failed from a log that was lost.
        CommitLog(spark, log).append(0, {watermark.TIME: None, "silver": {}})
    else:
        watermark.check_order(transaction_time, last[1][watermark.TIME])
    landed = {r: landing.landed_state(spark, landing_root, r, transaction_time) for r in FLATTEN}
    missing = sorted(r for r, state in landed.items() if state is None)
    if missing:
        raise FileNotFoundError(f"no records landed for {missing} at {transaction_time}")
    versions = store_snapshot(spark, landing_root, silver_root, transaction_time)
    models = save_models(read_silver(spark, silver_root, versions), mart_root)
    watermark.write_watermark(spark, log, transaction_time, silver=versions, landed=landed, base=None)
    return models


def build_increment(
    spark: SparkSession, landing_root: str, silver_root: str, mart_root: str, transaction_time: str
) -> dict[str, DataFrame]:
    """Like ``build``, where only what changed since the last load has landed; all, for the first load.

    The same time again changes nothing, unless other files have landed since: then the load is
    done again from what it started with. A time before the last load is refused, and so is a
    silver whose log of loads is lost, as the changes would be taken for all there is.
    """
    log = f"{silver_root}/{LOADS}"
    last = watermark.last_load(spark, log)
    since = last[1][watermark.TIME] if last else None
    if since is None:
        if last is None and any(silver_table(spark, silver_root, r).version() is not None for r in FLATTEN):
            raise FileNotFoundError(f"{silver_root} holds silver, but no log of its loads")
        return build(spark, landing_root, silver_root, mart_root, transaction_time)
    watermark.check_order(transaction_time, since)
    entry, landed = last[1], {r: landing.landed_state(spark, landing_root, r, transaction_time) for r in FLATTEN}
    base = entry["silver"]
    if watermark.moment(transaction_time) == watermark.moment(since):
        if landed == entry["landed"]:
            return stored_models(spark, silver_root, mart_root)
        if entry["base"] is None:
            return build(spark, landing_root, silver_root, mart_root, transaction_time)
        base = entry["base"]
    versions = store_increment(spark, landing_root, silver_root, base, transaction_time)
    models = save_models(read_silver(spark, silver_root, versions), mart_root)
    watermark.write_watermark(spark, log, transaction_time, silver=versions, landed=landed, base=base)
    return models
