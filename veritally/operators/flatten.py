"""Nested records to one flat row each: projections only, no shuffle and no Python code per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veritally.functions.nested import (
    first_coding,
    first_item,
    first_match,
    json_text,
    strip_prefix,
)
from veritally.sources.schemas import DIAGNOSES, ITEMS


def _extension(part: str) -> Column:
    """First extension whose url contains ``part``."""
    return first_match("extension", lambda e: e["url"].contains(part))


def _is_text(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.StringType)


def _typed(df: DataFrame, column: str, kind: T.DataType) -> Column:
    return F.from_json(F.col(column), kind) if _is_text(df, column) else F.col(column)


def flatten_patient(df: DataFrame) -> DataFrame:
    address = first_item("address")
    mbi = first_match("identifier", lambda i: i["system"].contains("us-mbi"))
    # Searches that feed two columns are columns of their own, so that they run once per row.
    searched = df.withColumn("__race", _extension("race")["valueCoding"])
    race = F.col("__race")
    return searched.select(
        F.col("id").alias("patient_id"),
        F.col("birthDate").alias("birth_date"),
        F.col("gender"),
        F.col("deceasedBoolean").alias("deceased"),
        address["state"].alias("state"),
        address["postalCode"].alias("postal_code"),
        race["code"].alias("race_code"),
        race["display"].alias("race_display"),
        mbi["value"].alias("mbi"),
        F.col("meta.lastUpdated").alias("last_updated"),
    )


def flatten_coverage(df: DataFrame) -> DataFrame:
    plan = first_match("class", lambda c: first_coding(c["type"])["code"] == "plan")
    searched = df.withColumn("__status", _extension("ms_cd")["valueCoding"])
    status_code = F.col("__status")
    return searched.select(
        F.col("id").alias("coverage_id"),
        F.col("status"),
        F.col("subscriberId").alias("subscriber_id"),
        strip_prefix("beneficiary.reference").alias("patient_id"),
        plan["value"].alias("medicare_part"),
        F.col("period.start").alias("period_start"),
        F.col("period.end").alias("period_end"),
        _extension("dual_eligible")["valueCoding"]["code"].alias("dual_eligible"),
        status_code["code"].alias("ms_cd_code"),
        status_code["display"].alias("ms_cd_display"),
        _extension("a_trm_cd")["valueCoding"]["code"].alias("termination_code"),
        _extension("rfrnc_yr")["valueDate"].alias("reference_year"),
        F.col("meta.lastUpdated").alias("last_updated"),
    )


def primary_diagnosis(diagnosis: Column) -> Column:
    """First coding of the first diagnosis whose first type is coded ``principal``."""
    principal = first_match(
        diagnosis, lambda d: first_coding(first_item(d["type"]))["code"] == "principal"
    )
    return first_coding(principal["diagnosisCodeableConcept"])


def supporting_info(info: Column | str, category: str) -> Column:
    """First coding of the first supporting entry of a category."""
    entry = first_match(info, lambda s: first_coding(s["category"])["code"] == category)
    return first_coding(entry["code"])


def attending_npi(care_team: Column | str) -> Column:
    """NPI of the first attending provider that has one."""

    def attends(member: Column) -> Column:
        identifier = member["provider"]["identifier"]
        return (first_coding(member["role"])["code"] == "attending") & (
            first_coding(identifier["type"])["code"] == "npi"
        )

    return first_match(care_team, attends)["provider"]["identifier"]["value"]


def flatten_eob(df: DataFrame) -> DataFrame:
    """Claims stay at claim grain; the diagnosis and item arrays are carried as JSON text."""
    claim_type = first_match("type.coding", lambda c: c["system"].contains("eob-type"))
    searched = df.withColumn("__principal", primary_diagnosis(_typed(df, "diagnosis", DIAGNOSES)))
    diagnosis = F.col("__principal")
    item = first_item(_typed(df, "item", ITEMS))
    zero = F.lit(0.0)
    return searched.select(
        F.col("id").alias("eob_id"),
        strip_prefix("patient.reference").alias("patient_id"),
        F.col("billablePeriod.start").alias("service_start_date"),
        F.col("billablePeriod.end").alias("service_end_date"),
        attending_npi("careTeam").alias("provider_npi"),
        item["locationAddress"]["state"].alias("facility_state"),
        F.coalesce(F.col("payment.amount.value"), zero).alias("total_payment"),
        F.coalesce(first_item("total")["amount"]["value"], zero).alias("total_amount"),
        diagnosis["code"].alias("primary_diagnosis_code"),
        diagnosis["display"].alias("primary_diagnosis_display"),
        json_text("diagnosis", _is_text(df, "diagnosis")).alias("diagnosis_json"),
        json_text("item", _is_text(df, "item")).alias("item_json"),
        F.col("meta.lastUpdated").alias("last_updated"),
        claim_type["code"].alias("claim_type"),
        first_coding(F.col("subType"))["code"].alias("claim_subtype"),
        supporting_info("supportingInfo", "admtype")["display"].alias("admission_type"),
        supporting_info("supportingInfo", "discharge-status")["code"].alias("discharge_status"),
    )


FLATTEN = {
    "Patient": flatten_patient,
    "Coverage": flatten_coverage,
    "ExplanationOfBenefit": flatten_eob,
}
