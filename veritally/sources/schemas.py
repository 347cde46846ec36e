"""Explicit schemas. Nothing is inferred: a column that is null in every record keeps its type."""

from __future__ import annotations

from pyspark.sql import types as T

TEXT, FLAG, NUMBER = T.StringType(), T.BooleanType(), T.DoubleType()


def record(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


def texts(*names: str) -> T.StructType:
    return record(**{name: TEXT for name in names})


_coded = T.ArrayType(texts("system", "code", "display"))
CONCEPT = record(coding=_coded)
_value_coding = texts("code", "display")
_meta = texts("lastUpdated")
_reference = texts("reference")
_period = texts("start", "end")
_amount = record(value=NUMBER)

PATIENT = record(
    id=TEXT,
    birthDate=TEXT,
    gender=TEXT,
    deceasedBoolean=FLAG,
    address=T.ArrayType(texts("state", "postalCode")),
    extension=T.ArrayType(record(url=TEXT, valueCoding=_value_coding)),
    identifier=T.ArrayType(texts("system", "value")),
    meta=_meta,
)

COVERAGE = record(
    **{
        "id": TEXT,
        "status": TEXT,
        "subscriberId": TEXT,
        "beneficiary": _reference,
        "class": T.ArrayType(record(type=CONCEPT, value=TEXT)),
        "period": _period,
        "extension": T.ArrayType(record(url=TEXT, valueCoding=_value_coding, valueDate=TEXT)),
        "meta": _meta,
    }
)

# The parts of the arrays kept as text that the flattening reads.
DIAGNOSES = T.ArrayType(record(type=T.ArrayType(CONCEPT), diagnosisCodeableConcept=CONCEPT))
ITEMS = T.ArrayType(record(locationAddress=texts("state"), productOrService=CONCEPT))

# ``diagnosis`` and ``item`` are read as JSON text: the text is carried on whole, and only the
# parts that are needed are parsed from it.
EOB = record(
    id=TEXT,
    patient=_reference,
    type=CONCEPT,
    subType=CONCEPT,
    billablePeriod=_period,
    careTeam=T.ArrayType(
        record(role=CONCEPT, provider=record(identifier=record(type=CONCEPT, value=TEXT)))
    ),
    item=TEXT,
    payment=record(amount=_amount),
    total=T.ArrayType(record(category=CONCEPT, amount=_amount)),
    diagnosis=TEXT,
    supportingInfo=T.ArrayType(record(category=CONCEPT, code=CONCEPT)),
    meta=_meta,
)

RESOURCES = {"Patient": PATIENT, "Coverage": COVERAGE, "ExplanationOfBenefit": EOB}

SILVER_PATIENT = record(
    patient_id=TEXT,
    birth_date=TEXT,
    gender=TEXT,
    deceased=FLAG,
    state=TEXT,
    postal_code=TEXT,
    race_code=TEXT,
    race_display=TEXT,
    mbi=TEXT,
    last_updated=TEXT,
)

SILVER_COVERAGE = texts(
    "coverage_id",
    "status",
    "subscriber_id",
    "patient_id",
    "medicare_part",
    "period_start",
    "period_end",
    "dual_eligible",
    "ms_cd_code",
    "ms_cd_display",
    "termination_code",
    "reference_year",
    "last_updated",
)

SILVER_EOB = record(
    eob_id=TEXT,
    patient_id=TEXT,
    service_start_date=TEXT,
    service_end_date=TEXT,
    provider_npi=TEXT,
    facility_state=TEXT,
    total_payment=NUMBER,
    total_amount=NUMBER,
    primary_diagnosis_code=TEXT,
    primary_diagnosis_display=TEXT,
    diagnosis_json=TEXT,
    item_json=TEXT,
    last_updated=TEXT,
    claim_type=TEXT,
    claim_subtype=TEXT,
    admission_type=TEXT,
    discharge_status=TEXT,
)

SILVER = {
    "Patient": SILVER_PATIENT,
    "Coverage": SILVER_COVERAGE,
    "ExplanationOfBenefit": SILVER_EOB,
}
