"""Intermediate models: the arrays carried as JSON text, one row per element."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veritally.functions.nested import first_coding, first_item
from veritally.sources.schemas import ITEMS, record, texts

# Fixed value: the text a source without procedure codes writes in their place.
MISSING_CODE = "NULL"


def explode_json(df: DataFrame, column: str, alias: str, kind: T.ArrayType) -> DataFrame:
    """One row per element of a JSON array, parsed once; empty arrays leave no row."""
    return df.withColumn(alias, F.explode(F.from_json(F.col(column), kind))).drop(column)


# Each column by the concept of a diagnosis, and the field of its first coding, that it comes from.
DIAGNOSIS_COLUMNS = {
    "diagnosis_code": ("diagnosisCodeableConcept", "code"),
    "diagnosis_display": ("diagnosisCodeableConcept", "display"),
    "diagnosis_type": ("type", "code"),
}


def diagnosis_schema(columns: Sequence[str]) -> T.ArrayType:
    """The part of a diagnosis that these columns need; the parser skips all else."""
    fields: dict[str, list[str]] = {}
    for column in columns:
        concept, field = DIAGNOSIS_COLUMNS[column]
        fields.setdefault(concept, []).append(field)
    concepts = {name: record(coding=T.ArrayType(texts(*found))) for name, found in fields.items()}
    kinds = {name: T.ArrayType(kind) if name == "type" else kind for name, kind in concepts.items()}
    return T.ArrayType(record(**kinds))


def _diagnosis_column(diagnosis: Column, column: str) -> Column:
    concept, field = DIAGNOSIS_COLUMNS[column]
    found = first_item(diagnosis[concept]) if concept == "type" else diagnosis[concept]
    return first_coding(found)[field].alias(column)


def int_eob_diagnoses(eob: DataFrame, columns: Sequence[str] = tuple(DIAGNOSIS_COLUMNS)) -> DataFrame:
    """One row per claim and diagnosis, with the columns asked for; claims without diagnoses have none."""
    claims = eob.select("eob_id", "patient_id", "diagnosis_json")
    diagnoses = explode_json(claims, "diagnosis_json", "diag", diagnosis_schema(columns))
    return diagnoses.select("eob_id", "patient_id", *[_diagnosis_column(F.col("diag"), c) for c in columns])


def int_eob_procedures(eob: DataFrame, enabled: bool = False) -> DataFrame:
    """(eob_id, procedure_code): no rows unless enabled, for sources that fill in the codes.

    The enabled form reads ``item_json``, so it takes the silver claims rather than the staged ones.
    """
    if not enabled:
        procedures = eob.select("eob_id", F.lit(None).cast("string").alias("procedure_code"))
        return procedures.filter(F.lit(False))
    items = explode_json(eob.select("eob_id", "item_json"), "item_json", "item", ITEMS)
    code = first_coding(F.col("item.productOrService"))["code"]
    return items.select("eob_id", F.nullif(code, F.lit(MISSING_CODE)).alias("procedure_code"))
