"""Mart models."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritally.operators.latest import latest_by_key

# Fixed value: the part whose latest coverage describes a patient.
PRIMARY_PART = "Part A"


def dim_patient(stg_patient: DataFrame, stg_coverage: DataFrame) -> DataFrame:
    """Patients with their latest Part A coverage; ties go to the greatest coverage id."""
    detail = ["medicare_part", "ms_cd_code", "ms_cd_display", "termination_code", "reference_year"]
    part_a = stg_coverage.filter(F.col("medicare_part") == PRIMARY_PART).select(
        "patient_id", "last_updated", "coverage_id", *detail
    )
    latest = latest_by_key(part_a, ["patient_id"], "last_updated", ["coverage_id"])
    patients = stg_patient.select(
        "patient_id",
        "birth_date",
        "gender",
        "deceased",
        "state",
        "postal_code",
        "race_code",
        "race_display",
        "mbi",
    )
    return patients.join(latest.select("patient_id", *detail), "patient_id", "left")


def fct_claims(stg_eob: DataFrame, patients: DataFrame) -> DataFrame:
    """Claims with the patient's attributes; claim grain, because patient ids are unique.

    No side is broadcast by hand: the patient side grows with the data. Claims without a patient
    share one key, whose partition adaptive execution splits.
    """
    claims = stg_eob.select(
        "eob_id",
        "patient_id",
        "claim_type",
        "claim_subtype",
        "service_start_date",
        "service_end_date",
        "primary_diagnosis_code",
        "primary_diagnosis_display",
        "provider_npi",
        "facility_state",
        "total_payment",
        "total_amount",
        "admission_type",
        "discharge_status",
    )
    attributes = patients.select("patient_id", "gender", "state", "race_code", "reference_year")
    return claims.join(attributes, "patient_id", "left").select(
        "eob_id", "patient_id", *[c for c in claims.columns[2:]], *attributes.columns[1:]
    )


def fct_coverage(stg_coverage: DataFrame, stg_eob: DataFrame) -> DataFrame:
    """Coverages with the patient's first and last service and claim count (null without claims)."""
    services = stg_eob.groupBy("patient_id").agg(
        F.min("service_start_date").alias("first_service_date"),
        F.max("service_start_date").alias("last_service_date"),
        F.count("eob_id").alias("claim_count"),
    )
    coverage = stg_coverage.select(
        "patient_id",
        "medicare_part",
        "status",
        "ms_cd_code",
        "ms_cd_display",
        "termination_code",
        "reference_year",
        "dual_eligible",
    )
    return coverage.join(services, "patient_id", "left")
