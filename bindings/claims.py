"""Nested claims records made from the star-schema tables, and the models over them.

Customers are patients; every order is one coverage and one claim; every line item is one claim
with two diagnoses. Queries of the sources and streams write these records as JSON and read them back.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bindings.base import Tables, query, shared
from veritally.functions.calendar import in_utc
from veritally.functions.nested import json_scalar, strip_prefix
from veritally.operators import flatten as fl
from veritally.plans import dashboards, intermediate, marts, staging
from veritally.sources.schemas import DIAGNOSES, ITEMS, RESOURCES

LOADED = "2024-02-01 00:00:00"
LOADED_AT = f"{LOADED}Z"


# --- records ---------------------------------------------------------------------------------

# The fields of the records as SQL over the flat tables; a field that is not listed is absent.


def coding(code: str, display: str = "null", system: str = "null") -> str:
    fields = {"system": system, "code": code, "display": display}
    return "named_struct(" + ", ".join(f"'{k}', cast({v} as string)" for k, v in fields.items()) + ")"


def concept(code: str, display: str = "null", system: str = "null") -> str:
    return f"named_struct('coding', array({coding(code, display, system)}))"


def extension(url: str, code: str = "null", display: str = "null") -> str:
    value = f"named_struct('code', cast({code} as string), 'display', cast({display} as string))"
    return f"named_struct('url', '{url}', 'valueCoding', {value})"


def dated_extension(url: str, code: str = "null", display: str = "null", date: str = "null") -> str:
    return extension(url, code, display)[:-1] + f", 'valueDate', cast({date} as string))"


def diagnosis(kind: str, code: str, display: str) -> str:
    return (
        f"named_struct('type', array({concept(kind)}), 'diagnosisCodeableConcept', {concept(code, display)})"
    )


def member(role: str, kind: str, value: str) -> str:
    identifier = f"named_struct('type', {concept(kind)}, 'value', {value})"
    provider = f"named_struct('identifier', {identifier})"
    return f"named_struct('role', {concept(role)}, 'provider', {provider})"


def info(category: str, code: str, display: str) -> str:
    return f"named_struct('category', {concept(category)}, 'code', {concept(code, display)})"


def money(amount: str) -> str:
    return f"named_struct('category', {concept('null')}, 'amount', named_struct('value', {amount}))"


def item(state: str, service: str) -> str:
    return (
        f"named_struct('locationAddress', named_struct('state', {state}), "
        f"'productOrService', {concept(service)})"
    )


PATIENT_REF = "named_struct('reference', if(o_totalprice >= 10000, concat('Patient/', o_custkey), null))"
ORDER_META = "named_struct('lastUpdated', date_format(o_orderdate, \"yyyy-MM-dd'T'HH:mm:ss'Z'\"))"

PATIENT_FIELDS = {
    "id": "cast(c_custkey as string)",
    "birthDate": "cast(date_add(date'1930-01-01', cast(c_custkey % 20000 as int)) as string)",
    "gender": "case when c_mktsegment in ('MACHINERY', 'BUILDING') then 'female' "
    "when c_mktsegment = 'AUTOMOBILE' then 'male' end",
    "deceasedBoolean": "c_acctbal < 0",
    "address": "if(c_nationkey <> 0, array_repeat(named_struct('state', concat('S', c_nationkey), "
    "'postalCode', lpad(cast(c_nationkey as string), 5, '0')), 2), null)",
    "extension": f"if(c_nationkey < 20, array({extension('urn:x/ethnicity', '0')}, "
    f"{extension('urn:x/us-core-race', 'c_nationkey', 'n_name')}, {extension('urn:x/us-core-race-2', '9')}), "
    f"array({extension('urn:x/ethnicity', '0')}))",
    "identifier": "array(named_struct('system', 'urn:x/local', 'value', 'no'), "
    "named_struct('system', 'urn:x/us-mbi', 'value', c_name))",
    "meta": "named_struct('lastUpdated', '2024-01-15T08:30:00Z')",
}

PART = (
    "case when o_orderpriority in ('1-URGENT', '5-LOW') then 'Part A' "
    "when o_orderpriority = '2-HIGH' then 'Part B' when o_orderpriority = '3-MEDIUM' then 'Part D' end"
)
DUAL = "case when o_totalprice > 300000 then 'Y' when o_totalprice > 200000 then 'N' end"
COVERAGE_FIELDS = {
    "id": "cast(o_orderkey as string)",
    "status": "'active'",
    "subscriberId": "concat('S', o_custkey)",
    "beneficiary": PATIENT_REF,
    "class": f"filter(array(named_struct('type', {concept(repr('group'))}, 'value', 'g'), "
    f"named_struct('type', {concept(repr('plan'))}, 'value', {PART})), c -> c.value is not null)",
    "extension": "filter(array("
    + ", ".join(
        (
            dated_extension("urn:x/ms_cd", "o_orderstatus", "concat('Status ', o_orderstatus)"),
            dated_extension("urn:x/a_trm_cd", "o_orderkey % 10", "'t'"),
            dated_extension("urn:x/rfrnc_yr", "'y'", date="year(o_orderdate)"),
            dated_extension("urn:x/dual_eligible", DUAL, "'d'"),
        )
    )
    + "), e -> e.valueCoding.code is not null)",
    "meta": ORDER_META,
}

EOB_FIELDS = {
    "id": "cast(o_orderkey as string)",
    "patient": PATIENT_REF,
    "type": f"named_struct('coding', array({coding(repr('zzz'), system=repr('urn:x/other'))}, "
    + coding(
        "case o_orderstatus when 'O' then 'OUTPATIENT' when 'F' then 'CARRIER' when 'P' then 'PDE' end",
        system="'urn:x/eob-type'",
    )
    + "))",
    "subType": concept("o_orderpriority"),
    "billablePeriod": "named_struct('start', cast(cast(o_orderdate as date) as string), "
    "'end', cast(date_add(cast(o_orderdate as date), 3) as string))",
    "careTeam": f"array({member(repr('primary'), repr('npi'), repr('N0'))}, "
    f"{member(repr('attending'), repr('tax'), repr('T0'))}, "
    + member("'attending'", "'npi'", "concat('N', o_custkey % 97)")
    + ")",
    "item": "if(o_totalprice >= 15000, array("
    + item("concat('S', o_custkey % 25)", "if(o_orderkey % 2 = 0, 'NULL', concat('9', o_orderkey % 7))")
    + "), null)",
    "payment": "if(o_orderstatus <> 'P', named_struct('amount', named_struct('value', o_totalprice)), null)",
    "total": f"array({money('o_totalprice')}, {money('1.0d')})",
    "diagnosis": "if(o_totalprice >= 20000, array("
    + diagnosis("'secondary'", "concat('D-', o_custkey % 40)", "'second'")
    + ", "
    + diagnosis("'principal'", "concat('E-', o_orderkey % 30)", "concat('Main ', o_orderkey % 30)")
    + "), null)",
    "supportingInfo": f"array({info(repr('other'), repr('o'), repr('other'))}, "
    f"{info(repr('admtype'), repr('a'), 'o_orderpriority')}, "
    f"{info(repr('discharge-status'), 'o_orderstatus', repr('left'))})",
    "meta": ORDER_META,
}

# Line items as claims: supplier and part as diagnoses, the part as principal on line 1.
LINE_FIELDS = {
    "id": "concat(l_orderkey, '-', l_linenumber)",
    "diagnosis": "array("
    + diagnosis("'secondary'", "concat('S', l_suppkey)", "'supplier'")
    + ", "
    + diagnosis("if(l_linenumber = 1, 'principal', 'secondary')", "concat('P', l_partkey)", "'part'")
    + ")",
    "item": "array(" + item("null", "if(l_returnflag = 'N', 'NULL', concat('C', l_partkey))") + ")",
    "supportingInfo": f"array({info(repr('admtype'), repr('x'), 'l_returnflag')}, "
    f"{info(repr('discharge-status'), 'l_linestatus', repr('y'))}, "
    f"{info(repr('admtype'), repr('x'), repr('later'))})",
}

# In these records the carried arrays are arrays; read from files they are JSON text.
TYPED = {"diagnosis": DIAGNOSES, "item": ITEMS}


def records(df: DataFrame, resource: str, fields: dict[str, str]) -> DataFrame:
    """The rows as nested records of a resource, with every field of its schema."""
    kinds = {f.name: TYPED.get(f.name, f.dataType).simpleString() for f in RESOURCES[resource]}
    return df.selectExpr(*[f"cast({fields.get(n, 'null')} as {k}) as `{n}`" for n, k in kinds.items()])


def lines(df: DataFrame) -> DataFrame:
    """Records as JSON, one per line; absent fields are left out."""
    return df.select(F.to_json(F.struct("*")).alias("value"))


@shared
def patients(t: Tables) -> DataFrame:
    rows = t("customer").join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return records(rows, "Patient", PATIENT_FIELDS)


@shared
def coverages(t: Tables) -> DataFrame:
    return records(t.split("orders"), "Coverage", COVERAGE_FIELDS)


@shared
def eobs(t: Tables) -> DataFrame:
    return records(t.split("orders"), "ExplanationOfBenefit", EOB_FIELDS)


@shared
def line_eobs(t: Tables) -> DataFrame:
    return records(t.split("lineitem"), "ExplanationOfBenefit", LINE_FIELDS)


# --- models ----------------------------------------------------------------------------------


@shared
def silver_patient(t: Tables) -> DataFrame:
    return fl.flatten_patient(patients(t))


@shared
def silver_coverage(t: Tables) -> DataFrame:
    return fl.flatten_coverage(coverages(t))


@shared
def silver_eob(t: Tables) -> DataFrame:
    return fl.flatten_eob(eobs(t))


@shared
def line_claims(t: Tables) -> DataFrame:
    return fl.flatten_eob(line_eobs(t))


@shared
def stg_patient(t: Tables) -> DataFrame:
    return staging.stg_patient(silver_patient(t), LOADED_AT)


@shared
def stg_coverage(t: Tables) -> DataFrame:
    return staging.stg_coverage(silver_coverage(t), LOADED_AT)


@shared
def stg_eob(t: Tables) -> DataFrame:
    return staging.stg_eob(silver_eob(t), LOADED_AT)


@shared
def dim_patient(t: Tables) -> DataFrame:
    return marts.dim_patient(stg_patient(t), stg_coverage(t))


@shared
def fct_claims(t: Tables) -> DataFrame:
    return marts.fct_claims(stg_eob(t), dim_patient(t))


@shared
def fct_coverage(t: Tables) -> DataFrame:
    return marts.fct_coverage(stg_coverage(t), stg_eob(t))


# --- the same in SQL, straight from the flat tables --------------------------------------------

PATIENT_SQL = """
SELECT CAST(c_custkey AS VARCHAR) AS patient_id,
       CAST(DATE '1930-01-01' + CAST(c_custkey % 20000 AS INTEGER) AS VARCHAR) AS birth_date,
       CASE WHEN c_mktsegment IN ('MACHINERY', 'BUILDING') THEN 'female'
            WHEN c_mktsegment = 'AUTOMOBILE' THEN 'male' END AS gender,
       c_acctbal < 0 AS deceased,
       CASE WHEN c_nationkey <> 0 THEN 'S' || c_nationkey END AS state,
       CASE WHEN c_nationkey <> 0 THEN lpad(CAST(c_nationkey AS VARCHAR), 5, '0') END AS postal_code,
       CASE WHEN c_nationkey < 20 THEN CAST(c_nationkey AS VARCHAR) END AS race_code,
       CASE WHEN c_nationkey < 20 THEN n_name END AS race_display,
       c_name AS mbi, '2024-01-15T08:30:00Z' AS last_updated
FROM customer JOIN nation ON c_nationkey = n_nationkey
"""

PATIENT_KEY = "CASE WHEN o_totalprice >= 10000 THEN CAST(o_custkey AS VARCHAR) ELSE '' END"

COVERAGE_SQL = f"""
SELECT CAST(o_orderkey AS VARCHAR) AS coverage_id, 'active' AS status,
       'S' || o_custkey AS subscriber_id, {PATIENT_KEY} AS patient_id,
       CASE WHEN o_orderpriority IN ('1-URGENT', '5-LOW') THEN 'Part A'
            WHEN o_orderpriority = '2-HIGH' THEN 'Part B'
            WHEN o_orderpriority = '3-MEDIUM' THEN 'Part D' END AS medicare_part,
       CAST(NULL AS VARCHAR) AS period_start, CAST(NULL AS VARCHAR) AS period_end,
       CASE WHEN o_totalprice > 300000 THEN 'Y' WHEN o_totalprice > 200000 THEN 'N' END AS dual_eligible,
       o_orderstatus AS ms_cd_code, 'Status ' || o_orderstatus AS ms_cd_display,
       CAST(o_orderkey % 10 AS VARCHAR) AS termination_code,
       CAST(year(o_orderdate) AS VARCHAR) AS reference_year,
       strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS last_updated
FROM orders
"""

EOB_SQL = f"""
SELECT CAST(o_orderkey AS VARCHAR) AS eob_id, {PATIENT_KEY} AS patient_id,
       strftime(o_orderdate, '%Y-%m-%d') AS service_start_date,
       strftime(o_orderdate + INTERVAL 3 DAY, '%Y-%m-%d') AS service_end_date,
       'N' || (o_custkey % 97) AS provider_npi,
       CASE WHEN o_totalprice >= 15000 THEN 'S' || (o_custkey % 25) END AS facility_state,
       CASE WHEN o_orderstatus <> 'P' THEN o_totalprice ELSE 0.0 END AS total_payment,
       o_totalprice AS total_amount,
       CASE WHEN o_totalprice >= 20000 THEN 'E-' || (o_orderkey % 30) END AS primary_diagnosis_code,
       CASE WHEN o_totalprice >= 20000 THEN 'Main ' || (o_orderkey % 30) END AS primary_diagnosis_display,
       strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS last_updated,
       CASE o_orderstatus WHEN 'O' THEN 'OUTPATIENT' WHEN 'F' THEN 'CARRIER' WHEN 'P' THEN 'PDE' END
           AS claim_type,
       o_orderpriority AS claim_subtype, o_orderpriority AS admission_type,
       o_orderstatus AS discharge_status
FROM orders
"""

STG_PATIENT_SQL = f"""
SELECT * REPLACE (CAST(birth_date AS DATE) AS birth_date,
                  TIMESTAMP '2024-01-15 08:30:00' AS last_updated),
       TIMESTAMP '{LOADED}' AS loaded_at FROM ({PATIENT_SQL})
"""

STG_COVERAGE_SQL = f"""
SELECT * REPLACE (CAST(period_start AS DATE) AS period_start, CAST(period_end AS DATE) AS period_end,
                  strptime(last_updated, '%Y-%m-%dT%H:%M:%SZ') AS last_updated),
       TIMESTAMP '{LOADED}' AS loaded_at FROM ({COVERAGE_SQL})
"""

STG_EOB_SQL = f"""
SELECT * REPLACE (CAST(service_start_date AS DATE) AS service_start_date,
                  CAST(service_end_date AS DATE) AS service_end_date,
                  strptime(last_updated, '%Y-%m-%dT%H:%M:%SZ') AS last_updated),
       TIMESTAMP '{LOADED}' AS loaded_at FROM ({EOB_SQL})
"""

DIM_PATIENT_SQL = f"""
SELECT p.* EXCLUDE (last_updated), c.medicare_part, c.ms_cd_code, c.ms_cd_display,
       c.termination_code, c.reference_year
FROM (SELECT * REPLACE (CAST(birth_date AS DATE) AS birth_date) FROM ({PATIENT_SQL})) p
LEFT JOIN (SELECT * FROM ({COVERAGE_SQL}) WHERE medicare_part = 'Part A'
           QUALIFY row_number() OVER (PARTITION BY patient_id
                                      ORDER BY last_updated DESC, coverage_id DESC) = 1) c
USING (patient_id)
"""

FCT_CLAIMS_SQL = f"""
SELECT e.eob_id, e.patient_id, claim_type, claim_subtype, service_start_date, service_end_date,
       primary_diagnosis_code, primary_diagnosis_display, provider_npi, facility_state,
       total_payment, total_amount, admission_type, discharge_status,
       p.gender, p.state, p.race_code, p.reference_year
FROM ({STG_EOB_SQL}) e LEFT JOIN ({DIM_PATIENT_SQL}) p ON e.patient_id = p.patient_id
"""

FCT_COVERAGE_SQL = f"""
SELECT c.patient_id, medicare_part, status, ms_cd_code, ms_cd_display, termination_code,
       reference_year, dual_eligible, first_service_date, last_service_date, claim_count
FROM ({COVERAGE_SQL}) c LEFT JOIN (
    SELECT patient_id, min(service_start_date) AS first_service_date,
           max(service_start_date) AS last_service_date, count(eob_id) AS claim_count
    FROM ({STG_EOB_SQL}) GROUP BY patient_id) e ON c.patient_id = e.patient_id
"""

DIAGNOSES_SQL = """
SELECT l_orderkey || '-' || l_linenumber AS eob_id, '' AS patient_id,
       'S' || l_suppkey AS diagnosis_code, 'supplier' AS diagnosis_display, 'secondary' AS diagnosis_type
FROM lineitem UNION ALL
SELECT l_orderkey || '-' || l_linenumber, '', 'P' || l_partkey, 'part',
       CASE WHEN l_linenumber = 1 THEN 'principal' ELSE 'secondary' END FROM lineitem
"""


def wall_clock(df: DataFrame, *columns: str) -> DataFrame:
    """Timestamps in UTC without a zone, and amounts as doubles, as the SQL side has them."""
    out = df
    for c in columns:
        out = out.withColumn(c, in_utc(c))
    for c, kind in df.dtypes:
        if kind.startswith("decimal"):
            out = out.withColumn(c, F.round(F.col(c).cast("double"), 4))
    return out


# --- flattening ------------------------------------------------------------------------------


@query(PATIENT_SQL)
def flatten_patient(t):
    return silver_patient(t)


@query(COVERAGE_SQL)
def flatten_coverage(t):
    return silver_coverage(t)


@query(EOB_SQL)
def flatten_eob(t):
    # The two carried JSON arrays are compared by content in raw_json_carry.
    return silver_eob(t).drop("diagnosis_json", "item_json")


@query(
    """SELECT l_orderkey || '-' || l_linenumber AS eob_id,
       CASE WHEN l_linenumber = 1 THEN 'P' || l_partkey END AS primary_diagnosis_code,
       CASE WHEN l_linenumber = 1 THEN 'part' END AS primary_diagnosis_display FROM lineitem"""
)
def primary_diagnosis(t):
    return line_claims(t).select("eob_id", "primary_diagnosis_code", "primary_diagnosis_display")


@query(
    """SELECT l_orderkey || '-' || l_linenumber AS eob_id, l_returnflag AS admission_type,
       l_linestatus AS discharge_status FROM lineitem"""
)
def supporting_info(t):
    return line_claims(t).select("eob_id", "admission_type", "discharge_status")


@query(
    """SELECT CAST(o_orderkey AS VARCHAR) AS eob_id,
       CAST(CASE WHEN o_totalprice >= 20000 THEN 2 ELSE 0 END AS INTEGER) AS diagnoses,
       CASE WHEN o_totalprice >= 20000 THEN 'D-' || (o_custkey % 40) END AS first_code,
       CASE WHEN o_totalprice >= 15000 THEN 'S' || (o_custkey % 25) END AS item_state,
       o_totalprice < 15000 AS no_items FROM orders"""
)
def raw_json_carry(t):
    return silver_eob(t).select(
        "eob_id",
        F.json_array_length("diagnosis_json").alias("diagnoses"),
        json_scalar("diagnosis_json", "$[0].diagnosisCodeableConcept.coding[0].code").alias("first_code"),
        json_scalar("item_json", "$[0].locationAddress.state").alias("item_state"),
        (F.col("item_json") == "[]").alias("no_items"),
    )


@query(
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN '' ELSE CAST(o_custkey AS VARCHAR) || '/' END
       AS patient_id FROM orders"""
)
def strip_reference_prefix(t):
    reference = F.concat(F.lit("Patient/"), "o_custkey", F.lit("/Patient/"))
    absent = F.when(F.col("o_orderstatus") != "P", reference)
    return t("orders").select("o_orderkey", strip_prefix(absent).alias("patient_id"))


# --- staging and intermediate ------------------------------------------------------------------


@query(STG_PATIENT_SQL, name="stg_patient")
def _stg_patient(t):
    return wall_clock(stg_patient(t), "last_updated", "loaded_at")


@query(STG_COVERAGE_SQL, name="stg_coverage")
def _stg_coverage(t):
    return wall_clock(stg_coverage(t), "last_updated", "loaded_at")


@query(STG_EOB_SQL, name="stg_eob")
def _stg_eob(t):
    return wall_clock(stg_eob(t).drop("diagnosis_json"), "last_updated", "loaded_at")


@query(
    f"""SELECT o_orderstatus, count(*) AS orders, max(TIMESTAMP '{LOADED}') AS loaded_at,
        0 AS stamped_later FROM orders GROUP BY o_orderstatus"""
)
def load_stamp(t):
    fixed = staging.stage(t("orders"), {}, loaded_at=LOADED_AT)
    started = F.lit(datetime.now(timezone.utc))
    live = staging.stage(fixed.withColumnRenamed("loaded_at", "fixed"), {})
    stray = F.count_if(~F.col("loaded_at").between(started, F.current_timestamp())).cast("int")
    grouped = live.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("orders"), F.max("fixed").alias("loaded_at"), stray.alias("stamped_later")
    )
    return wall_clock(grouped, "loaded_at")


@query(DIAGNOSES_SQL)
def int_eob_diagnoses(t):
    return intermediate.int_eob_diagnoses(line_claims(t))


@query("SELECT event_id, json_extract_string(props, '$.k') AS k, CAST(NULL AS VARCHAR) AS missing FROM events")
def json_scalar_paths(t):
    return t("events").select(
        "event_id", json_scalar("props", "$.k").alias("k"), json_scalar("props", "$.none[0]").alias("missing")
    )


@query("SELECT CAST(NULL AS VARCHAR) AS eob_id, CAST(NULL AS VARCHAR) AS procedure_code FROM lineitem WHERE false")
def int_eob_procedures(t):
    return intermediate.int_eob_procedures(line_claims(t))


@query(
    """SELECT l_orderkey || '-' || l_linenumber AS eob_id,
       CASE WHEN l_returnflag <> 'N' THEN 'C' || l_partkey END AS procedure_code FROM lineitem"""
)
def int_eob_procedures_enabled(t):
    return intermediate.int_eob_procedures(line_claims(t), enabled=True)


# --- marts -------------------------------------------------------------------------------------


@query(DIM_PATIENT_SQL, name="dim_patient")
def _dim_patient(t):
    return dim_patient(t)


@query(FCT_CLAIMS_SQL, name="fct_claims")
def _fct_claims(t):
    return wall_clock(fct_claims(t))


@query(FCT_COVERAGE_SQL, name="fct_coverage")
def _fct_coverage(t):
    return fct_coverage(t)


# --- dashboards --------------------------------------------------------------------------------


@query(
    f"""SELECT count(*) AS total_beneficiaries,
        count(*) FILTER (WHERE gender = 'female') AS female_count,
        count(*) FILTER (WHERE gender = 'male') AS male_count FROM ({PATIENT_SQL})"""
)
def population_overview(t):
    return dashboards.population_overview(dim_patient(t))


@query(f"SELECT gender, count(*) AS patient_count FROM ({PATIENT_SQL}) GROUP BY gender")
def gender_distribution(t):
    return dashboards.gender_distribution(dim_patient(t))


@query(
    f"""SELECT race_display, count(*) AS patient_count FROM ({PATIENT_SQL})
        WHERE race_display IS NOT NULL GROUP BY race_display"""
)
def race_distribution(t):
    return dashboards.race_distribution(dim_patient(t))


@query(
    f"""SELECT count(*) AS total_claims, round(sum(total_payment), 4) AS total_payments,
        round(avg(total_payment), 4) AS avg_payment_per_claim FROM ({EOB_SQL})"""
)
def claims_summary(t):
    return wall_clock(dashboards.claims_summary(fct_claims(t)))


CLAIMS_BY_TYPE_SQL = f"""
SELECT claim_type, count(*) AS claim_count, round(sum(total_payment), 4) AS total_payment,
       round(avg(total_payment), 4) AS avg_payment
FROM ({EOB_SQL}) WHERE claim_type IS NOT NULL GROUP BY claim_type
"""


@query(CLAIMS_BY_TYPE_SQL)
def claims_by_type(t):
    return wall_clock(dashboards.claims_by_type(fct_claims(t)))


@query(
    f"""SELECT diagnosis_code, diagnosis_display, count(*) AS diagnosis_count FROM ({DIAGNOSES_SQL})
        GROUP BY ALL ORDER BY diagnosis_count DESC, diagnosis_code LIMIT 20"""
)
def top_diagnoses(t):
    return dashboards.top_diagnoses(intermediate.int_eob_diagnoses(line_claims(t), dashboards.DIAGNOSIS_COUNT_COLUMNS))


@query(
    """SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS claim_month, count(*) AS claim_count
       FROM orders WHERE o_orderdate >= DATE '1997-01-01' GROUP BY 1"""
)
def monthly_claim_volume(t):
    return dashboards.monthly_claim_volume(fct_claims(t), since="1997-01-01")


@query(
    f"""SELECT medicare_part, count(*) AS enrollment_count FROM ({COVERAGE_SQL})
        WHERE medicare_part IS NOT NULL GROUP BY 1"""
)
def medicare_part_distribution(t):
    return dashboards.medicare_part_distribution(fct_coverage(t))


@query(
    f"""SELECT CAST(date_trunc('year', first_service_date) AS DATE) AS enrollment_year,
        count(DISTINCT patient_id) AS patient_count FROM ({FCT_COVERAGE_SQL})
        WHERE first_service_date IS NOT NULL GROUP BY 1"""
)
def enrollment_activity(t):
    return dashboards.enrollment_activity(fct_coverage(t))


@query(
    f"""SELECT coalesce(dual_eligible, 'Unknown') AS dual_eligible_status,
        count(DISTINCT patient_id) AS patient_count FROM ({COVERAGE_SQL}) GROUP BY 1"""
)
def dual_eligibility(t):
    return dashboards.dual_eligibility(fct_coverage(t))


@query(
    f"""SELECT claim_type, CAST(date_trunc('month', CAST(service_start_date AS DATE)) AS DATE) AS claim_month,
        count(*) AS claim_count FROM ({EOB_SQL}) GROUP BY 1, 2"""
)
def claim_volume_by_type(t):
    return dashboards.claim_volume_by_type(fct_claims(t))


@query(
    f"""SELECT claim_type, count(*) AS claim_count, round(max(abs(total_payment)), 4) AS max_payment,
        round(max(abs(total_amount)), 4) AS max_amount FROM ({EOB_SQL}) GROUP BY claim_type
        HAVING max(abs(total_payment)) = 0 AND max(abs(total_amount)) > 0"""
)
def unpaid_claim_types(t):
    return wall_clock(dashboards.unpaid_claim_types(fct_claims(t)))


@query(
    f"""SELECT CAST(year(first_service_date) AS INTEGER) AS service_year,
        count(DISTINCT patient_id) AS patient_count FROM ({FCT_COVERAGE_SQL})
        WHERE first_service_date IS NOT NULL GROUP BY 1"""
)
def service_year_distribution(t):
    return dashboards.service_year_distribution(fct_coverage(t))


@query(
    """SELECT copies, count(*) AS key_count FROM (SELECT count(*) AS copies FROM lineitem
       GROUP BY l_orderkey, l_linenumber) GROUP BY copies"""
)
def duplicate_multiplicity(t):
    return dashboards.duplicate_multiplicity(t("lineitem"), ["l_orderkey", "l_linenumber"])
