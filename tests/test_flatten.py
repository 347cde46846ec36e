"""Records with paths missing at every level."""

import json

import pytest
from pyspark.sql import functions as F

from veritally.operators.flatten import flatten_coverage, flatten_eob, flatten_patient
from veritally.plans.intermediate import int_eob_diagnoses, int_eob_procedures
from veritally.plans.marts import dim_patient, fct_claims, fct_coverage
from veritally.plans.staging import stg_coverage, stg_eob, stg_patient
from veritally.sources.schemas import RESOURCES

FLATTEN = {
    "Patient": flatten_patient,
    "Coverage": flatten_coverage,
    "ExplanationOfBenefit": flatten_eob,
}


@pytest.fixture
def flat(spark):
    def run(resource, *records):
        lines = spark.createDataFrame([(json.dumps(r),) for r in records], "value string")
        parsed = lines.select(F.from_json("value", RESOURCES[resource]).alias("r")).select("r.*")
        return FLATTEN[resource](parsed)

    return run


def one(df):
    return df.first().asDict()


def coding(code, display=None, system=None):
    return {"coding": [{"code": code, "display": display, "system": system}]}


def test_empty_records(flat):
    assert set(one(flat("Patient", {"x": 1})).values()) == {None}
    coverage = one(flat("Coverage", {"x": 1}))
    assert coverage.pop("patient_id") == ""
    assert set(coverage.values()) == {None}
    eob = one(flat("ExplanationOfBenefit", {"x": 1}))
    assert eob.pop("patient_id") == ""
    assert (eob.pop("total_payment"), eob.pop("total_amount")) == (0.0, 0.0)
    assert (eob.pop("diagnosis_json"), eob.pop("item_json")) == ("[]", "[]")
    assert set(eob.values()) == {None}


def test_empty_arrays(flat):
    patient = one(flat("Patient", {"id": "p", "address": [], "extension": [], "identifier": []}))
    assert patient["patient_id"] == "p"
    assert patient["state"] is None and patient["race_code"] is None and patient["mbi"] is None
    eob = one(
        flat(
            "ExplanationOfBenefit",
            {"id": "e", "type": {"coding": []}, "subType": {"coding": []}, "item": [], "total": [],
             "careTeam": [], "diagnosis": [], "supportingInfo": []},
        )
    )
    assert eob["claim_type"] is None and eob["total_amount"] == 0.0 and eob["diagnosis_json"] == "[]"


def test_first_match_wins(flat):
    race = lambda code: {"url": "x/race", "valueCoding": {"code": code, "display": code.upper()}}
    patient = one(flat("Patient", {"extension": [{"url": "other"}, race("a"), race("b")]}))
    assert (patient["race_code"], patient["race_display"]) == ("a", "A")
    # A match without a code is still the match.
    patient = one(flat("Patient", {"extension": [{"url": "x/race"}, race("b")]}))
    assert patient["race_code"] is None


def test_coverage_paths(flat):
    coverage = one(
        flat(
            "Coverage",
            {
                "id": "c", "beneficiary": {"reference": "Patient/Patient/7"},
                "class": [{"type": coding("group"), "value": "g"}, {"type": coding("plan"), "value": "Part A"}],
                "extension": [{"url": "u/rfrnc_yr", "valueDate": "2021"},
                              {"url": "u/ms_cd", "valueCoding": {"code": "10", "display": "Aged"}}],
            },
        )
    )
    assert coverage["patient_id"] == "7" and coverage["medicare_part"] == "Part A"
    assert coverage["reference_year"] == "2021" and coverage["ms_cd_display"] == "Aged"
    assert coverage["termination_code"] is None and coverage["period_start"] is None


CLAIM = {
    "id": "e1",
    "patient": {"reference": "Patient/p1"},
    "type": {"coding": [{"system": "a/other", "code": "no"}, {"system": "a/eob-type", "code": "PDE"}]},
    "payment": {"date": "2020-01-01"},
    "total": [{"amount": {"value": 12.5}}, {"amount": {"value": 99}}],
    "billablePeriod": {"start": "2020-03-01", "end": "2020-03-02"},
    "careTeam": [
        {"role": coding("attending"), "provider": {"identifier": {"type": coding("tax"), "value": "t"}}},
        {"role": coding("attending"), "provider": {"identifier": {"type": coding("npi"), "value": "n"}}},
    ],
    "diagnosis": [
        {"type": [coding("secondary"), coding("principal")], "diagnosisCodeableConcept": coding("S1", "second")},
        {"type": [coding("principal")], "diagnosisCodeableConcept": coding("P1", "first"), "sequence": 2},
        {"type": [coding("principal")], "diagnosisCodeableConcept": coding("P2", "third")},
    ],
    "item": [{"productOrService": coding("NULL")}, {"productOrService": coding("99213"), "kept": {"deep": 1}}],
    "supportingInfo": [
        {"category": coding("admtype"), "code": coding("1", "Emergency")},
        {"category": coding("discharge-status"), "code": coding("01", "Home")},
        {"category": coding("admtype"), "code": coding("2", "Urgent")},
    ],
}


def test_claim_paths(flat):
    eob = one(flat("ExplanationOfBenefit", CLAIM))
    assert eob["claim_type"] == "PDE" and eob["provider_npi"] == "n"
    assert (eob["total_payment"], eob["total_amount"]) == (0.0, 12.5)
    assert (eob["primary_diagnosis_code"], eob["primary_diagnosis_display"]) == ("P1", "first")
    assert (eob["admission_type"], eob["discharge_status"]) == ("Emergency", "01")
    # The carried text holds every field, also those no schema names.
    assert json.loads(eob["diagnosis_json"])[1]["sequence"] == 2
    assert json.loads(eob["item_json"])[1]["kept"] == {"deep": 1}


def test_no_principal_diagnosis(flat):
    claim = {**CLAIM, "diagnosis": CLAIM["diagnosis"][:1]}
    assert one(flat("ExplanationOfBenefit", claim))["primary_diagnosis_code"] is None


def test_intermediate_models(flat, rows):
    silver = flat("ExplanationOfBenefit", CLAIM, {"id": "e2"})
    staged = stg_eob(silver, loaded_at="2024-01-01")
    assert "item_json" not in staged.columns
    assert dict(staged.dtypes)["total_payment"] == "decimal(38,9)"
    assert rows(int_eob_diagnoses(staged).select("eob_id", "diagnosis_code", "diagnosis_type")) == [
        ("e1", "P1", "principal"), ("e1", "P2", "principal"), ("e1", "S1", "secondary"),
    ]
    assert rows(int_eob_procedures(staged)) == []
    assert rows(int_eob_procedures(silver, enabled=True)) == [("e1", "99213"), ("e1", None)]


def test_casts(spark, flat):
    bad = flat("Patient", {"id": "p", "birthDate": "not a date"})
    assert stg_patient(bad, lenient=True).first()["birth_date"] is None
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        stg_patient(bad).collect()


def test_marts(flat, rows):
    def coverage(key, patient, part, updated, code):
        return {
            "id": key, "beneficiary": {"reference": f"Patient/{patient}"} if patient else {},
            "class": [{"type": coding("plan"), "value": part}], "meta": {"lastUpdated": updated},
            "extension": [{"url": "u/ms_cd", "valueCoding": {"code": code, "display": "d"}}],
        }

    patients = stg_patient(flat("Patient", {"id": "p1", "gender": "male"}, {"id": "p2"}))
    coverages = stg_coverage(
        flat(
            "Coverage",
            coverage("c1", "p1", "Part A", "2020-01-01T00:00:00Z", "old"),
            coverage("c2", "p1", "Part A", "2021-01-01T00:00:00Z", "new"),
            coverage("c3", "p1", "Part B", "2022-01-01T00:00:00Z", "other"),
            coverage("c4", "p1", "Part A", None, "undated"),
            coverage("c5", None, "Part A", "2021-01-01T00:00:00Z", "nobody"),
        )
    )
    claims = stg_eob(
        flat("ExplanationOfBenefit", CLAIM, {"id": "e2", "billablePeriod": {"start": "2019-05-05"}}, {"id": "e3"})
    )
    people = dim_patient(patients, coverages)
    assert rows(people.select("patient_id", "medicare_part", "ms_cd_code")) == [
        ("p1", "Part A", "new"), ("p2", None, None),
    ]
    assert rows(fct_claims(claims, people).select("eob_id", "patient_id", "gender")) == [
        ("e1", "p1", "male"), ("e2", "", None), ("e3", "", None),
    ]
    # Claims and coverages without a patient meet under the empty id.
    found = fct_coverage(coverages, claims).filter("patient_id = ''")
    assert [(str(r["first_service_date"]), r["claim_count"]) for r in found.collect()] == [("2019-05-05", 2)]
