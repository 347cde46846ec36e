"""Dashboard queries: one aggregate each over the marts.

Orders that the source leaves open on ties are completed by the group column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veritally.plans.staging import AMOUNT

TOP_DIAGNOSES = 20
FIRST_MONTH = "2015-01-01"


def _average(column: str) -> Column:
    """Mean amount at the scale of the amounts themselves."""
    return F.avg(column).cast(AMOUNT)


def _counts(df: DataFrame, column: str, alias: str) -> DataFrame:
    counted = df.filter(F.col(column).isNotNull()).groupBy(column)
    return counted.agg(F.count(F.lit(1)).alias(alias)).orderBy(F.desc(alias), column)


def population_overview(dim_patient: DataFrame) -> DataFrame:
    return dim_patient.agg(
        F.count(F.lit(1)).alias("total_beneficiaries"),
        F.count_if(F.col("gender") == "female").alias("female_count"),
        F.count_if(F.col("gender") == "male").alias("male_count"),
    )


def gender_distribution(dim_patient: DataFrame) -> DataFrame:
    return dim_patient.groupBy("gender").agg(F.count(F.lit(1)).alias("patient_count"))


def race_distribution(dim_patient: DataFrame) -> DataFrame:
    return _counts(dim_patient, "race_display", "patient_count")


def claims_summary(fct_claims: DataFrame) -> DataFrame:
    return fct_claims.agg(
        F.count(F.lit(1)).alias("total_claims"),
        F.sum("total_payment").cast(AMOUNT).alias("total_payments"),
        _average("total_payment").alias("avg_payment_per_claim"),
    )


def claims_by_type(fct_claims: DataFrame) -> DataFrame:
    return (
        fct_claims.filter(F.col("claim_type").isNotNull())
        .groupBy("claim_type")
        .agg(
            F.count(F.lit(1)).alias("claim_count"),
            F.sum("total_payment").cast(AMOUNT).alias("total_payment"),
            _average("total_payment").alias("avg_payment"),
        )
        .orderBy(F.desc("claim_count"), "claim_type")
    )


DIAGNOSIS_COUNT_COLUMNS = ("diagnosis_code", "diagnosis_display")  # what ``top_diagnoses`` needs


def top_diagnoses(int_eob_diagnoses: DataFrame, top: int = TOP_DIAGNOSES) -> DataFrame:
    return (
        int_eob_diagnoses.filter(F.col("diagnosis_code").isNotNull())
        .groupBy("diagnosis_code", "diagnosis_display")
        .agg(F.count(F.lit(1)).alias("diagnosis_count"))
        .orderBy(F.desc("diagnosis_count"), "diagnosis_code", "diagnosis_display")
        .limit(top)
    )


def monthly_claim_volume(fct_claims: DataFrame, since: str = FIRST_MONTH) -> DataFrame:
    return (
        fct_claims.filter(F.col("service_start_date") >= F.lit(since).cast("date"))
        .groupBy(F.trunc("service_start_date", "month").alias("claim_month"))
        .agg(F.count(F.lit(1)).alias("claim_count"))
        .orderBy("claim_month")
    )


def medicare_part_distribution(fct_coverage: DataFrame) -> DataFrame:
    return _counts(fct_coverage, "medicare_part", "enrollment_count")


def enrollment_activity(fct_coverage: DataFrame) -> DataFrame:
    return (
        fct_coverage.filter(F.col("first_service_date").isNotNull())
        .groupBy(F.trunc("first_service_date", "year").alias("enrollment_year"))
        .agg(F.count_distinct("patient_id").alias("patient_count"))
        .orderBy("enrollment_year")
    )


def dual_eligibility(fct_coverage: DataFrame) -> DataFrame:
    status = F.coalesce(F.col("dual_eligible"), F.lit("Unknown"))
    return fct_coverage.groupBy(status.alias("dual_eligible_status")).agg(
        F.count_distinct("patient_id").alias("patient_count")
    )


def claim_volume_by_type(fct_claims: DataFrame) -> DataFrame:
    """Claims per type and month, to locate a spike."""
    month = F.trunc("service_start_date", "month").alias("claim_month")
    return (
        fct_claims.groupBy("claim_type", month)
        .agg(F.count(F.lit(1)).alias("claim_count"))
        .orderBy("claim_type", "claim_month")
    )


def unpaid_claim_types(fct_claims: DataFrame) -> DataFrame:
    """Claim types whose payment is always 0 although an amount was charged."""
    return (
        fct_claims.groupBy("claim_type")
        .agg(
            F.count(F.lit(1)).alias("claim_count"),
            F.max(F.abs("total_payment")).alias("max_payment"),
            F.max(F.abs("total_amount")).alias("max_amount"),
        )
        .filter((F.col("max_payment") == 0) & (F.col("max_amount") > 0))
    )


def service_year_distribution(fct_coverage: DataFrame) -> DataFrame:
    """Patients per year of their first service."""
    return (
        fct_coverage.filter(F.col("first_service_date").isNotNull())
        .groupBy(F.year("first_service_date").alias("service_year"))
        .agg(F.count_distinct("patient_id").alias("patient_count"))
        .orderBy("service_year")
    )


def duplicate_multiplicity(df: DataFrame, keys: list[str]) -> DataFrame:
    """How many keys occur once, twice, and so on."""
    copies = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
    return copies.groupBy("copies").agg(F.count(F.lit(1)).alias("key_count")).orderBy("copies")
