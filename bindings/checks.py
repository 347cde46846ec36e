"""Every check bound to a test table, with arguments that some rows break where that is possible."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings.base import add, query
from bindings.claims import (
    COVERAGE_SQL,
    EOB_SQL,
    dim_patient,
    fct_claims,
    stg_coverage,
)
from veritally import checks as ck
from veritally.checks import CheckSpec, run_suite
from veritally.checks.kernel import REGISTRY, register
from veritally.checks.suite import mart_suites
from veritally.session import scratch_path

LINE = ("l_orderkey", "l_linenumber")


def rows_of(t, table: str):
    """A table, or one of the joins that bring in missing values."""
    if table == "scored_documents":
        return t("documents").join(t("labels"), "doc_id", "left")
    return t(table)


def check(query_name: str, check_name: str, table: str, sql: str, **arguments) -> None:
    """Register a check with literal arguments; ``other`` tables are named by ``@table``."""

    def build(t):
        given = {
            k: t(v[1:]) if isinstance(v, str) and v.startswith("@") else v for k, v in arguments.items()
        }
        return REGISTRY[check_name](rows_of(t, table), **given)

    add(query_name, build, sql)


SCORED = "documents LEFT JOIN labels USING (doc_id)"

# --- kernel ----------------------------------------------------------------------------------

check(
    "expression_is_true", "expression_is_true", "lineitem",
    "SELECT l_orderkey, l_linenumber, false AS expression FROM lineitem WHERE l_quantity * 2000 < l_extendedprice",
    expression="l_quantity * 2000 >= l_extendedprice", carry=LINE,
)
check(
    "expression_is_true_by_group", "expression_is_true", "lineitem",
    """SELECT l_suppkey AS col_1, count(*) AS expression FROM lineitem WHERE l_tax > 0 GROUP BY 1
       HAVING NOT count(*) > 530""",
    expression="count(*)", test_condition="> 530", group_by_columns=["l_suppkey"], row_condition="l_tax > 0",
)
check(
    "expression_between", "expression_between", "lineitem",
    """SELECT l_orderkey, l_linenumber, false AS expression FROM lineitem
       WHERE NOT (l_quantity > 1 AND l_quantity < 50)""",
    expression="l_quantity", min_value=1, max_value=50, strictly=True, carry=LINE,
)
check(
    "row_condition", "expression_is_true", "lineitem",
    """SELECT l_orderkey, l_linenumber, false AS expression FROM lineitem
       WHERE l_returnflag = 'N' AND l_discount > 0.08""",
    expression="l_discount <= 0.08", row_condition="l_returnflag = 'N'", carry=LINE,
)
check(
    "equal_expression", "equal_expression", "lineitem",
    """SELECT coalesce(a.k, b.k) AS col_1, a.v AS expression, b.v AS compare_expression,
       abs(coalesce(a.v, 0) - coalesce(b.v, 0)) AS expression_difference,
       round(abs(coalesce(a.v, 0) - coalesce(b.v, 0)) / nullif(a.v, 0), 6) AS expression_difference_percent
       FROM (SELECT l_orderkey AS k, count(*) AS v FROM lineitem GROUP BY 1) a
       FULL JOIN (SELECT o_orderkey AS k, 4 * count(*) AS v FROM orders GROUP BY 1) b ON a.k = b.k
       WHERE abs(coalesce(a.v, 0) - coalesce(b.v, 0)) > 2""".replace("4 * count(*)", "CAST(4 * count(*) AS BIGINT)"),
    expression="count(*)", compare_model="@orders", compare_expression="4 * count(*)", group_by=["l_orderkey"],
    compare_group_by=["o_orderkey"], tolerance=2,
)
check(
    "equal_expression_percent", "equal_expression", "lineitem",
    """SELECT a.k AS col_1, a.v AS expression, b.v AS compare_expression, abs(a.v - b.v) AS expression_difference,
       abs(a.v - b.v) / a.v AS expression_difference_percent
       FROM (SELECT l_orderkey AS k, count(*) AS v FROM lineitem GROUP BY 1) a
       JOIN (SELECT l_orderkey AS k, count(*) AS v FROM lineitem WHERE l_tax > 0.02 GROUP BY 1) b ON a.k = b.k
       WHERE abs(a.v - b.v) / a.v > 0.5
       UNION ALL SELECT l_orderkey, count(*), NULL, count(*), 1.0 FROM lineitem GROUP BY 1
       HAVING count(*) FILTER (WHERE l_tax > 0.02) = 0""",
    expression="count(*)", group_by=["l_orderkey"], compare_row_condition="l_tax > 0.02", tolerance_percent=0.5,
)


def ordered_round(df):
    return df.withColumn("expression_difference_percent", F.round("expression_difference_percent", 6))


def _rounded(name: str) -> None:
    from bindings.base import QUERIES

    build = QUERIES[name]
    QUERIES[name] = lambda spark, folder: ordered_round(build(spark, folder))


_rounded("equal_expression")


@query(
    f"""SELECT 'all' AS policy, count(*) AS kept FROM {SCORED} WHERE NOT (quality IS NULL AND nullif(lang, 'en') IS NULL)
        UNION ALL SELECT 'any', count(*) FROM {SCORED} WHERE NOT (quality IS NULL OR nullif(lang, 'en') IS NULL)"""
)
def ignore_missing_rows(t):
    from veritally.functions.scalar import keep_row

    columns = [F.col("quality"), F.nullif("lang", F.lit("en"))]
    rows = rows_of(t, "scored_documents")
    kept = rows.agg(
        F.count_if(keep_row("all_values_are_missing", columns)).alias("all"),
        F.count_if(keep_row("any_value_is_missing", columns)).alias("any"),
    )
    return kept.unpivot([], ["all", "any"], "policy", "kept")


@query(
    """SELECT 'wide' AS "check", count(*) AS failures, 'error' AS status, false AS vacuous FROM lineitem WHERE l_quantity > 40
       UNION ALL SELECT 'warned', count(*), 'warn', false FROM lineitem WHERE l_quantity > 40
       UNION ALL SELECT 'tolerated', count(*), 'pass', false FROM lineitem WHERE l_quantity > 40
       UNION ALL SELECT 'between', count(*), 'warn', false FROM lineitem WHERE l_quantity > 40
       UNION ALL SELECT 'expected', 0, 'pass', false
       UNION ALL SELECT 'single sum', 0, 'pass', true"""
)
def result_policy(t):
    """One violation count under six policies."""
    within = {"column_name": "l_quantity", "max_value": 40}
    name = "expect_column_values_to_be_between"
    specs = [
        CheckSpec(name, within, "wide"),
        CheckSpec(name, within, "warned", severity="warn"),
        CheckSpec(name, within, "tolerated", error_if="> 10000000000", warn_if="> 10000000000"),
        CheckSpec(name, within, "between", error_if="= 0", warn_if="> 4"),
        CheckSpec(name, within, "expected", fail_calc="cast((count(*) = 0) as int)"),
        CheckSpec("expect_column_values_to_be_within_n_stdevs", {"column_name": "l_tax"}, "single sum"),
        CheckSpec(name, within, "disabled", enabled=False),
    ]
    return run_suite(t("lineitem"), specs)


check(
    "unique", "unique", "lineitem",
    "SELECT l_orderkey AS unique_field, count(*) AS n_records FROM lineitem GROUP BY 1 HAVING count(*) > 1",
    column_name="l_orderkey",
)
check(
    "not_null", "not_null", "scored_documents",
    f"SELECT doc_id, false AS expression FROM {SCORED} WHERE quality IS NULL",
    column_name="quality", carry=["doc_id"],
)


@query("SELECT l_orderkey AS from_field FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')")
def relationships(t):
    filled = t("orders").filter("o_orderstatus = 'F'")
    return ck.kernel.relationships(t("lineitem"), "l_orderkey", filled, "o_orderkey")


CLAIM_CHECKS = f"""
SELECT 'unique:eob_id' AS "check", CAST(0 AS BIGINT) AS failures, 'pass' AS status, false AS vacuous
UNION ALL SELECT 'not_null:eob_id', 0, 'pass', false
UNION ALL SELECT 'not_null:patient_id', 0, 'pass', false
UNION ALL SELECT 'relationships:patient_id', count(*) FILTER (WHERE patient_id = ''),
          CASE WHEN count(*) FILTER (WHERE patient_id = '') > 0 THEN 'error' ELSE 'pass' END, false FROM ({EOB_SQL})
UNION ALL SELECT 'expect_column_values_to_be_between:total_payment', 0, 'pass', false
UNION ALL SELECT 'expect_column_values_to_be_between:service_start_date', 0, 'pass', false
UNION ALL SELECT 'expect_column_value_lengths_to_be_between:primary_diagnosis_code', 0, 'pass', false
"""


@query(CLAIM_CHECKS)
def claims_suite(t):
    """The suite of the claims mart: the mart is stored once, and the row checks share one scan of it."""
    patients = dim_patient(t)
    return run_suite(_stored_claims(t), mart_suites(patients)["fct_claims"])


def _stored_claims(t):
    """The columns of the claims mart that checks name, stored."""
    path = scratch_path(t.spark, "mart")
    checked = ("eob_id", "patient_id", "claim_type", "service_start_date", "primary_diagnosis_code")
    fct_claims(t).select(*checked, "total_payment", "total_amount").write.parquet(path)
    return t.spark.read.parquet(path)


def _broken(label: str, failures: str, failed: str = "error") -> str:
    return f"""SELECT '{label}' AS "check", {failures} AS failures,
        CASE WHEN {failures} > 0 THEN '{failed}' ELSE 'pass' END AS status, false AS vacuous FROM ({EOB_SQL})"""


def _rows(condition: str) -> str:
    return f"count(*) FILTER (WHERE {condition})"


@query(
    " UNION ALL ".join([
        _broken("payments", _rows("total_payment > 200000"), "warn"),
        _broken("dates", _rows("NOT service_start_date BETWEEN '1994-01-01' AND '1996-12-31'")),
        _broken("codes", _rows("length(primary_diagnosis_code) < 4")),
        _broken("paid in full", _rows("claim_type <> 'CARRIER' AND total_payment <> total_amount")),
        _broken("amounts", _rows("NOT (total_amount - total_payment BETWEEN 0 AND 100000)")),
        _broken("carrier maximum", "CAST(max(total_payment) FILTER (WHERE claim_type = 'CARRIER') > 100000 AS BIGINT)"),
    ])
)
def claims_suite_with_violations(t):
    """Bounds that some claims break; all six checks share one scan of the stored mart."""
    payment, carrier = {"column_name": "total_payment"}, "claim_type = 'CARRIER'"
    days = {"min_value": "date'1994-01-01'", "max_value": "date'1996-12-31'"}
    specs = [
        CheckSpec("expect_column_values_to_be_between", payment | {"max_value": 200000}, "payments", "warn"),
        CheckSpec("expect_column_values_to_be_between", {"column_name": "service_start_date"} | days, "dates"),
        CheckSpec(
            "expect_column_value_lengths_to_be_between",
            {"column_name": "primary_diagnosis_code", "min_value": 4, "max_value": 10}, "codes",
        ),
        CheckSpec(
            "expression_is_true",
            {"expression": "total_payment = total_amount", "row_condition": "claim_type <> 'CARRIER'"}, "paid in full",
        ),
        CheckSpec(
            "expression_between",
            {"expression": "total_amount - total_payment", "min_value": 0, "max_value": 100000}, "amounts",
        ),
        CheckSpec(
            "expect_column_max_to_be_between",
            payment | {"max_value": 100000, "row_condition": carrier}, "carrier maximum",
        ),
    ]
    return run_suite(_stored_claims(t), specs)


def _line_check(label: str, failures: str) -> str:
    return f"""SELECT '{label}' AS "check", CAST({failures} AS BIGINT) AS failures,
        CASE WHEN {failures} > 0 THEN 'error' ELSE 'pass' END AS status, false AS vacuous"""


def _lines(condition: str) -> str:
    return f"(SELECT count(*) FROM lineitem WHERE {condition})"


@query(
    " UNION ALL ".join([
        _line_check("repeated orders", "(SELECT count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1))"),
        _line_check("unknown parts", _lines("l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 5)")),
        _line_check("unfilled orders", _lines("l_tax = 0 AND l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')")),
        _line_check("flags", _lines("l_returnflag NOT IN ('A', 'R')")),
        _line_check("states", _lines("l_linestatus IS NULL")),
        _line_check("days", "(SELECT CASE WHEN count(DISTINCT l_shipdate) < 10 THEN 0 ELSE 1 END FROM lineitem)"),
        _line_check("quantities", "(SELECT CASE WHEN count(DISTINCT l_quantity) BETWEEN 1 AND 100 THEN 0 ELSE 1 END FROM lineitem)"),
    ])
)
def keyed_suite(t):
    """Seven checks on distinct values, most of which some lines break, in one scan of the lines."""
    filled = t("orders").filter("o_orderstatus = 'F'")
    large = t("part").filter("p_size > 5")
    specs = [
        CheckSpec("unique", {"column_name": "l_orderkey"}, "repeated orders"),
        CheckSpec("relationships", {"column_name": "l_partkey", "to": large, "field": "p_partkey"}, "unknown parts"),
        CheckSpec(
            "relationships",
            {"column_name": "l_orderkey", "to": filled, "field": "o_orderkey", "row_condition": "l_tax = 0"}, "unfilled orders",
        ),
        CheckSpec("expect_column_values_to_be_in_set", {"column_name": "l_returnflag", "value_set": ["A", "R"]}, "flags"),
        CheckSpec("expect_column_values_to_be_in_set", {"column_name": "l_linestatus", "value_set": ["F", "O"]}, "states"),
        CheckSpec("expect_column_distinct_count_to_be_less_than", {"column_name": "l_shipdate", "value": 10}, "days"),
        CheckSpec(
            "expect_column_unique_value_count_to_be_between",
            {"column_name": "l_quantity", "min_value": 1, "max_value": 100}, "quantities",
        ),
    ]
    return run_suite(t("lineitem"), specs)


@query(
    f"""SELECT 'unique:coverage_id' AS "check", CAST(0 AS BIGINT) AS failures, 'pass' AS status, false AS vacuous
        UNION ALL SELECT 'not_null:coverage_id', count(*) FILTER (WHERE coverage_id IS NULL), 'pass', false
                  FROM ({COVERAGE_SQL})
        UNION ALL SELECT 'not_null:patient_id', count(*) FILTER (WHERE patient_id IS NULL), 'pass', false
                  FROM ({COVERAGE_SQL})"""
)
def coverage_suite(t):
    return run_suite(stg_coverage(t), mart_suites(t("customer"))["stg_coverage"])


@query(
    """SELECT l_returnflag, count(*) AS n_records FROM lineitem WHERE l_tax = 0 GROUP BY 1 HAVING count(*) > 1"""
)
def custom_check(t):
    """A check of one's own is any function from a table to the rows that break its rule."""

    @register
    def flags_with_untaxed_lines(df, allowed=1):
        untaxed = df.filter("l_tax = 0").groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n_records"))
        return untaxed.filter(F.col("n_records") > allowed)

    return t("lineitem").transform(REGISTRY["flags_with_untaxed_lines"], allowed=1)


# --- shape -----------------------------------------------------------------------------------

ORDER_COLUMNS = "(SELECT upper(column_name) AS c, row_number() OVER () AS i FROM (DESCRIBE orders))"

check(
    "column_to_exist", "expect_column_to_exist", "orders",
    f"""SELECT 'O_CUSTKEY' AS column_name, CAST(i - 1 AS INTEGER) AS matching_column_index,
        false AS column_index_matches FROM {ORDER_COLUMNS} WHERE c = 'O_CUSTKEY' AND i <> 1""",
    column_name="o_custkey", column_index=1,
)


@query(
    """SELECT max(ts) AS max_timestamp FROM events WHERE ts <= TIMESTAMP '2024-02-10 00:00:00' AND event_type = 'signup'
       HAVING max(ts) < TIMESTAMP '2024-02-05 00:00:00'"""
)
def recent_data(t):
    return ck.shape.expect_row_values_to_have_recent_data(
        t("events"), "ts", "day", 5, "event_type = 'signup'", tz="UTC", as_of="2024-02-10 00:00:00"
    )


@query(
    """SELECT CAST(1 AS BIGINT) AS row_count, user_id, max(ts) AS latest_timestamp_column FROM events
       WHERE ts <= TIMESTAMP '2024-01-25 00:00:00' AND value > 1 GROUP BY user_id
       HAVING max(ts) < TIMESTAMP '2024-01-25 00:00:00' - INTERVAL 12 HOUR"""
)
def grouped_recent_data(t):
    return ck.shape.expect_grouped_row_values_to_have_recent_data(
        t("events"), ["user_id"], "ts", "hour", 12, "value > 1", tz="UTC", as_of="2024-01-25 00:00:00"
    )


check(
    "table_aggregation_to_equal_other_table", "expect_table_aggregation_to_equal_other_table", "orders",
    """SELECT a AS expression, b AS compare_expression, abs(a - b) AS expression_difference,
       abs(a - b) / a AS expression_difference_percent FROM (SELECT count(*) AS a FROM orders),
       (SELECT count(*) AS b FROM customer) WHERE abs(a - b) > 0""",
    expression="count(*)", compare_model="@customer",
)
check(
    "table_column_count_to_be_between", "expect_table_column_count_to_be_between", "orders",
    f"""SELECT CAST(count(*) AS INTEGER) AS number_actual_columns, 7 AS min_value, 0 AS max_value
        FROM {ORDER_COLUMNS} HAVING count(*) < 7""",
    min_value=7,
)
check(
    "table_column_count_to_equal", "expect_table_column_count_to_equal", "orders",
    f"""SELECT CAST(count(*) AS INTEGER) AS number_actual_columns, 5 AS value FROM {ORDER_COLUMNS}
        HAVING count(*) <> 5""",
    value=5,
)
check(
    "table_column_count_to_equal_other_table", "expect_table_column_count_to_equal_other_table", "orders",
    """SELECT CAST(a AS INTEGER) AS number_columns, CAST(b AS INTEGER) AS compare_number_columns
       FROM (SELECT count(*) AS a FROM (DESCRIBE orders)), (SELECT count(*) AS b FROM (DESCRIBE customer)) WHERE a <> b""",
    compare_model="@customer",
)
check(
    "table_columns_to_contain_set", "expect_table_columns_to_contain_set", "orders",
    f"""SELECT v AS input_column, CAST(NULL AS VARCHAR) AS relation_column
        FROM (VALUES ('O_ORDERKEY'), ('O_CLERK'), ('O_COMMENT')) s(v) WHERE v NOT IN (SELECT c FROM {ORDER_COLUMNS})""",
    column_list=["o_orderkey", "o_clerk", "O_COMMENT"],
)
check(
    "table_columns_to_not_contain_set", "expect_table_columns_to_not_contain_set", "orders",
    f"""SELECT v AS input_column, v AS relation_column FROM (VALUES ('O_ORDERKEY'), ('O_CLERK')) s(v)
        WHERE v IN (SELECT c FROM {ORDER_COLUMNS})""",
    column_list=["o_orderkey", "o_clerk"],
)
check(
    "table_columns_to_match_set", "expect_table_columns_to_match_set", "orders",
    f"""SELECT c AS relation_column, v AS input_column FROM {ORDER_COLUMNS}
        FULL JOIN (VALUES ('O_ORDERKEY'), ('O_CUSTKEY'), ('O_CLERK')) s(v) ON c = v WHERE c IS NULL OR v IS NULL""",
    column_list=["o_custkey", "o_orderkey", "o_clerk"],
)
check(
    "table_columns_to_match_ordered_list", "expect_table_columns_to_match_ordered_list", "orders",
    f"""SELECT CAST(i AS INTEGER) AS relation_column_idx, c AS relation_column,
        CAST(n AS INTEGER) AS input_column_idx, v AS input_column FROM {ORDER_COLUMNS}
        FULL JOIN (VALUES ('O_ORDERKEY', 1), ('O_ORDERSTATUS', 2), ('O_CUSTKEY', 3)) s(v, n) ON c = v AND i = n
        WHERE c IS NULL OR v IS NULL""",
    column_list=["o_orderkey", "o_orderstatus", "o_custkey"],
)
check(
    "table_row_count_to_be_between", "expect_table_row_count_to_be_between", "events",
    "SELECT user_id AS col_1, false AS expression FROM events GROUP BY 1 HAVING NOT (count(*) > 5 AND count(*) < 70)",
    min_value=5, max_value=70, strictly=True, group_by=["user_id"],
)
check(
    "table_row_count_to_equal", "expect_table_row_count_to_equal", "nation",
    "SELECT n_regionkey AS col_1, false AS expression FROM nation WHERE n_nationkey > 0 GROUP BY 1 HAVING count(*) <> 5",
    value=5, group_by=["n_regionkey"], row_condition="n_nationkey > 0",
)


def _counts_sql(factor: int) -> str:
    return f"""SELECT coalesce(a.k, b.k) AS col_1, a.v AS expression, b.v AS compare_expression,
       abs(coalesce(a.v, 0) - coalesce(b.v, 0)) AS expression_difference,
       round(abs(coalesce(a.v, 0) - coalesce(b.v, 0)) / nullif(a.v, 0), 6) AS expression_difference_percent
       FROM (SELECT l_orderkey AS k, count(*) AS v FROM lineitem WHERE l_tax > 0.01 GROUP BY 1) a
       FULL JOIN (SELECT o_orderkey AS k, count(*) * {factor} AS v FROM orders WHERE o_orderstatus <> 'O'
                  GROUP BY 1) b ON a.k = b.k
       WHERE abs(coalesce(a.v, 0) - coalesce(b.v, 0)) > 0"""


for _name, _factor in (
    ("table_row_count_to_equal_other_table", 1),
    ("table_row_count_to_equal_other_table_times_factor", 4),
):
    check(
        _name, f"expect_{_name}", "lineitem", _counts_sql(_factor),
        compare_model="@orders", factor=_factor, group_by=["l_orderkey"], compare_group_by=["o_orderkey"],
        row_condition="l_tax > 0.01", compare_row_condition="o_orderstatus <> 'O'",
    )
    _rounded(_name)

# --- values ----------------------------------------------------------------------------------

check(
    "values_to_be_unique", "expect_column_values_to_be_unique", "lineitem",
    "SELECT l_partkey, count(*) AS n_records FROM lineitem WHERE l_tax = 0 GROUP BY 1 HAVING count(*) > 1",
    column_name="l_partkey", row_condition="l_tax = 0",
)
check(
    "values_to_not_be_null", "expect_column_values_to_not_be_null", "scored_documents",
    f"SELECT doc_id, false AS expression FROM {SCORED} WHERE lang = 'en' AND toxic IS NULL",
    column_name="toxic", row_condition="lang = 'en'", carry=["doc_id"],
)
check(
    "values_to_be_null", "expect_column_values_to_be_null", "scored_documents",
    f"SELECT doc_id, false AS expression FROM {SCORED} WHERE toxic IS NOT NULL",
    column_name="toxic", carry=["doc_id"],
)
check(
    "values_to_be_of_type", "expect_column_values_to_be_of_type", "orders",
    """SELECT upper(column_name) AS relation_column, column_type AS relation_column_type FROM (DESCRIBE orders)
       WHERE column_name = 'o_totalprice' AND column_type <> 'VARCHAR'""",
    column_name="o_totalprice", column_type="varchar",
)
check(
    "values_to_be_in_type_list", "expect_column_values_to_be_in_type_list", "orders",
    """SELECT upper(column_name) AS relation_column, column_type AS relation_column_type FROM (DESCRIBE orders)
       WHERE column_name = 'o_orderkey' AND column_type NOT IN ('DATE', 'VARCHAR')""",
    column_name="O_Orderkey", column_type_list=["date", "varchar"],
)
MIXED = "CASE WHEN lang = 'en' THEN upper(source) ELSE source END"
check(
    "values_to_have_consistent_casing", "expect_column_values_to_have_consistent_casing", "documents",
    f"""SELECT * FROM (SELECT count(*) AS set_count, count(DISTINCT lower(v)) AS set_count_case_insensitive
        FROM (SELECT DISTINCT {MIXED} AS v FROM documents)) WHERE set_count <> set_count_case_insensitive""",
    column_name=MIXED,
)
check(
    "values_with_inconsistent_casing", "expect_column_values_to_have_consistent_casing", "documents",
    f"""SELECT lower(v) AS inconsistent_columns, count(v) AS set_count_case_insensitive
        FROM (SELECT DISTINCT {MIXED} AS v FROM documents) GROUP BY 1 HAVING count(v) > 1""",
    column_name=MIXED, display_inconsistent_columns=True,
)
check(
    "values_to_be_in_set", "expect_column_values_to_be_in_set", "scored_documents",
    f"SELECT quality AS value_field FROM {SCORED} WHERE quality IS NULL OR quality NOT IN (1)",
    column_name="quality", value_set=[1, 2], quote_values=False,
)
check(
    "values_to_not_be_in_set", "expect_column_values_to_not_be_in_set", "orders",
    "SELECT o_orderstatus AS value_field FROM orders WHERE o_orderstatus IN ('F', 'X') AND o_totalprice > 100000",
    column_name="o_orderstatus", value_set=["F", "X"], row_condition="o_totalprice > 100000",
)
check(
    "values_to_be_between", "expect_column_values_to_be_between", "lineitem",
    "SELECT l_orderkey, l_linenumber, false AS expression FROM lineitem WHERE NOT (l_discount BETWEEN 0.02 AND 0.08)",
    column_name="l_discount", min_value=0.02, max_value=0.08, carry=LINE,
)
RISING = """SELECT * FROM (SELECT ts AS sort_column, user_id, value AS value_field,
            lag(value) OVER (PARTITION BY user_id ORDER BY ts, value) AS value_field_lag FROM events
            WHERE event_type <> 'error') WHERE NOT value_field > value_field_lag"""
for _name, _whole in (("values_to_be_increasing", True), ("values_to_be_increasing_in_ranges", False)):
    check(
        _name, "expect_column_values_to_be_increasing", "events", RISING,
        column_name="value", sort_column="ts", group_by=["user_id"], row_condition="event_type <> 'error'",
        whole_groups=_whole,
    )
# Sorting by a column of few values makes almost every row equal to the one before it.
TIES = """SELECT * FROM (SELECT l_linenumber AS sort_column, l_quantity AS value_field,
          lag(l_quantity) OVER (ORDER BY l_linenumber, l_quantity) AS value_field_lag FROM lineitem)
          WHERE NOT (value_field > value_field_lag AND value_field - value_field_lag = 1)"""
check(
    "values_to_be_increasing_with_ties", "expect_column_values_to_be_increasing", "lineitem", TIES,
    column_name="l_quantity", sort_column="l_linenumber", step=1,
)
FALLING = """SELECT * FROM (SELECT o_orderdate AS sort_column, o_totalprice AS value_field,
             lag(o_totalprice) OVER (ORDER BY o_orderdate, o_totalprice DESC) AS value_field_lag FROM orders)
             WHERE NOT value_field <= value_field_lag"""
for _name, _whole in (("values_to_be_decreasing", True), ("values_to_be_decreasing_in_ranges", False)):
    check(
        _name, "expect_column_values_to_be_decreasing", "orders", FALLING,
        column_name="o_totalprice", sort_column="o_orderdate", strictly=False, whole_groups=_whole,
    )

# --- strings ---------------------------------------------------------------------------------

DOC = ("doc_id",)
PART = ("p_partkey",)
check(
    "value_lengths_to_be_between", "expect_column_value_lengths_to_be_between", "documents",
    "SELECT doc_id, false AS expression FROM documents WHERE NOT (length(text) BETWEEN 50 AND 5000)",
    column_name="text", min_value=50, max_value=5000, carry=DOC,
)
check(
    "value_lengths_to_equal", "expect_column_value_lengths_to_equal", "part",
    "SELECT p_partkey, false AS expression FROM part WHERE length(p_name) <> 10",
    column_name="p_name", value=10, carry=PART,
)
check(
    "values_to_match_regex", "expect_column_values_to_match_regex", "documents",
    "SELECT doc_id, false AS expression FROM documents WHERE NOT regexp_matches(text, '[A-Z][a-z]+\\. THE', 'i')",
    column_name="text", regex=r"[A-Z][a-z]+\. THE", flags="i", carry=DOC,
)
check(
    "values_to_not_match_regex", "expect_column_values_to_not_match_regex", "documents",
    "SELECT doc_id, false AS expression FROM documents WHERE regexp_matches(text, '[0-9a-z.]+@[a-z]+')",
    column_name="text", regex="[0-9a-z.]+@[a-z]+", carry=DOC,
)
A, B = "regexp_matches(text, '[0-9]{3}')", "regexp_matches(text, 'http')"
for _name, _on, _sql in (("any", "any", f"{A} OR {B}"), ("all", "all", f"{A} AND {B}")):
    check(
        f"values_to_match_regex_list_{_name}", "expect_column_values_to_match_regex_list", "documents",
        f"SELECT doc_id, false AS expression FROM documents WHERE NOT ({_sql})",
        column_name="text", regex_list=["[0-9]{3}", "http"], match_on=_on, carry=DOC,
    )
C, D = "regexp_matches(text, '[0-9]')", "regexp_matches(text, '[A-Z]{2}')"
for _name, _sql in (("any", f"NOT {C} OR NOT {D}"), ("all", f"NOT {C} AND NOT {D}")):
    check(
        f"values_to_not_match_regex_list_{_name}", "expect_column_values_to_not_match_regex_list", "documents",
        f"SELECT doc_id, false AS expression FROM documents WHERE NOT ({_sql})",
        column_name="text", regex_list=["[0-9]", "[A-Z]{2}"], match_on=_name, carry=DOC,
    )
check(
    "values_to_match_like_pattern", "expect_column_values_to_match_like_pattern", "part",
    "SELECT p_partkey, false AS expression FROM part WHERE p_name NOT LIKE '%e_ %'",
    column_name="p_name", like_pattern="%e_ %", carry=PART,
)
check(
    "values_to_not_match_like_pattern", "expect_column_values_to_not_match_like_pattern", "part",
    "SELECT p_partkey, false AS expression FROM part WHERE p_name LIKE '%ring'",
    column_name="p_name", like_pattern="%ring", carry=PART,
)
check(
    "values_to_match_like_pattern_list", "expect_column_values_to_match_like_pattern_list", "part",
    "SELECT p_partkey, false AS expression FROM part WHERE NOT (p_name LIKE 'small%' AND p_name LIKE '%ring')",
    column_name="p_name", like_pattern_list=["small%", "%ring"], match_on="all", carry=PART,
)
check(
    "values_to_not_match_like_pattern_list", "expect_column_values_to_not_match_like_pattern_list", "part",
    "SELECT p_partkey, false AS expression FROM part WHERE NOT (p_name NOT LIKE 'small%' OR p_name NOT LIKE '%ring')",
    column_name="p_name", like_pattern_list=["small%", "%ring"], carry=PART,
)

# --- aggregates ------------------------------------------------------------------------------


def grouped(query_name: str, check_name: str, key: str, table: str, holds: str, **arguments) -> None:
    """A check per group; the SQL negates the same condition."""
    check(
        query_name, check_name, table,
        f"SELECT {key} AS col_1, false AS expression FROM {table} GROUP BY 1 HAVING NOT ({holds})",
        group_by=[key], **arguments,
    )


PER_LINE = "l_linenumber"
grouped(
    "distinct_count_to_equal", "expect_column_distinct_count_to_equal", "o_custkey", "orders",
    "count(DISTINCT o_orderstatus) = 3", column_name="o_orderstatus", value=3,
)
grouped(
    "distinct_count_to_be_greater_than", "expect_column_distinct_count_to_be_greater_than", "o_custkey", "orders",
    "count(DISTINCT o_orderpriority) > 3", column_name="o_orderpriority", value=3,
)
grouped(
    "distinct_count_to_be_less_than", "expect_column_distinct_count_to_be_less_than", "o_custkey", "orders",
    "count(DISTINCT o_orderpriority) < 5", column_name="o_orderpriority", value=5,
)
check(
    "distinct_count_to_equal_other_table", "expect_column_distinct_count_to_equal_other_table", "lineitem",
    """SELECT a AS expression, b AS compare_expression, abs(a - b) AS expression_difference,
       abs(a - b) / a AS expression_difference_percent FROM (SELECT count(DISTINCT l_orderkey) AS a FROM lineitem),
       (SELECT count(DISTINCT o_orderkey) AS b FROM orders) WHERE abs(a - b) > 0""",
    column_name="l_orderkey", compare_model="@orders", compare_column_name="o_orderkey",
)
check(
    "distinct_values_to_be_in_set", "expect_column_distinct_values_to_be_in_set", "scored_documents",
    f"SELECT DISTINCT quality AS value_field FROM {SCORED} WHERE quality IS NULL OR quality <> 1",
    column_name="quality", value_set=[1], quote_values=False,
)
check(
    "distinct_values_to_contain_set", "expect_column_distinct_values_to_contain_set", "orders",
    """SELECT DISTINCT value_field FROM (VALUES ('F'), ('X'), ('Y'), ('X')) s(value_field)
       WHERE value_field NOT IN (SELECT o_orderstatus FROM orders)""",
    column_name="o_orderstatus", value_set=["F", "X", "Y", "X"],
)
check(
    "distinct_values_to_equal_set", "expect_column_distinct_values_to_equal_set", "scored_documents",
    f"""SELECT column_value, value_field FROM (SELECT DISTINCT quality AS column_value FROM {SCORED})
        FULL JOIN (VALUES (1), (7)) s(value_field) ON column_value = value_field
        WHERE column_value IS NULL OR value_field IS NULL""",
    column_name="quality", value_set=[1, 7, 7], quote_values=False,
)
for _name, _function, _column, _low, _high in (
    ("max", "max", "l_extendedprice", 90000, 104900),
    ("min", "min", "l_extendedprice", 0, 902),
    ("mean", "avg", "l_quantity", 25.3, 25.5),
    ("sum", "sum", "l_quantity", 200000, 218000),
    ("stdev", "stddev_samp", "l_quantity", 14.4, 14.5),
    ("median", "median", "l_extendedprice", 50000, 52500),
):
    grouped(
        f"{_name}_to_be_between", f"expect_column_{_name}_to_be_between", PER_LINE, "lineitem",
        f"{_function}({_column}) BETWEEN {_low} AND {_high}",
        column_name=_column, min_value=_low, max_value=_high,
    )
grouped(
    "median_to_be_between_in_ranges", "expect_column_median_to_be_between", PER_LINE, "lineitem",
    "median(l_extendedprice) > 52500", column_name="l_extendedprice", min_value=52500, strictly=True,
)
grouped(
    "quantile_values_to_be_between", "expect_column_quantile_values_to_be_between", PER_LINE, "lineitem",
    "quantile_cont(l_extendedprice, 0.95) <= 99700", column_name="l_extendedprice", quantile=0.95, max_value=99700,
)
grouped(
    "unique_value_count_to_be_between", "expect_column_unique_value_count_to_be_between", "l_suppkey", "lineitem",
    "count(DISTINCT l_partkey) >= 500", column_name="l_partkey", min_value=500,
)
grouped(
    "proportion_of_unique_values_to_be_between", "expect_column_proportion_of_unique_values_to_be_between",
    "l_suppkey", "lineitem", "count(DISTINCT l_quantity) / count(l_quantity) <= 0.08",
    column_name="l_quantity", max_value=0.08,
)
for _rank, _set in ((1, ["5-LOW"]), (3, ["1-URGENT"])):
    check(
        f"most_common_value_rank_{_rank}", "expect_column_most_common_value_to_be_in_set", "orders",
        f"""SELECT v AS value_field FROM (SELECT o_orderpriority AS v FROM orders GROUP BY 1
            QUALIFY row_number() OVER (ORDER BY count(*) DESC, o_orderpriority) = {_rank})
            WHERE v NOT IN ('{_set[0]}')""",
        column_name="o_orderpriority", value_set=_set, top_n=_rank,
    )
check(
    "most_common_number", "expect_column_most_common_value_to_be_in_set", "lineitem",
    """SELECT v AS value_field FROM (SELECT l_tax AS v FROM lineitem GROUP BY 1
       QUALIFY row_number() OVER (ORDER BY count(*) DESC, l_tax) = 2) WHERE v NOT IN (0.5)""",
    column_name="l_tax", value_set=[0.5], top_n=2, quote_values=False, data_type="double",
)

# --- several columns -------------------------------------------------------------------------

check(
    "pair_values_a_greater_than_b", "expect_column_pair_values_A_to_be_greater_than_B", "lineitem",
    "SELECT l_orderkey, l_linenumber, false AS expression FROM lineitem WHERE NOT l_extendedprice / 1500 >= l_quantity",
    column_A="l_extendedprice / 1500", column_B="l_quantity", or_equal=True, carry=LINE,
)
check(
    "pair_values_to_be_equal", "expect_column_pair_values_to_be_equal", "lineitem",
    "SELECT l_orderkey, l_linenumber, false AS expression FROM lineitem WHERE l_discount <> l_tax",
    column_A="l_discount", column_B="l_tax", carry=LINE,
)
check(
    "pair_values_to_be_in_set", "expect_column_pair_values_to_be_in_set", "lineitem",
    """SELECT l_orderkey, l_linenumber, false AS expression FROM lineitem
       WHERE (l_returnflag, l_linestatus) NOT IN (('A', 'F'), ('N', 'O'))""",
    column_A="l_returnflag", column_B="l_linestatus", value_pairs_set=[["'A'", "'F'"], ["'N'", "'O'"]], carry=LINE,
)
check(
    "compound_columns_to_be_unique", "expect_compound_columns_to_be_unique", "lineitem",
    "SELECT l_orderkey, l_linenumber, count(*) AS n_records FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
    column_list=["l_orderkey", "l_linenumber"],
)
check(
    "compound_columns_any_missing", "expect_compound_columns_to_be_unique", "scored_documents",
    f"SELECT quality, source, count(*) AS n_records FROM {SCORED} WHERE quality IS NOT NULL GROUP BY 1, 2 HAVING count(*) > 1",
    column_list=["quality", "source"], ignore_row_if="any_value_is_missing",
)
check(
    "multicolumn_sum_to_equal", "expect_multicolumn_sum_to_equal", "lineitem",
    """SELECT l_suppkey AS col_1, false AS expression FROM lineitem GROUP BY 1
       HAVING sum(l_linenumber) + sum(l_linenumber) <> sum(CAST(l_quantity AS BIGINT))""",
    column_list=["l_linenumber", "l_linenumber"], sum_total="cast(l_quantity as bigint)", group_by=["l_suppkey"],
)
@query(
    f"""SELECT doc_id, CAST(1 + len(list_distinct(list_filter([quality, toxic], lambda v: v IS NOT NULL))) AS INTEGER)
        AS column_values FROM {SCORED} WHERE quality IS NULL OR quality = toxic""",
)
def columns_unique_within_record(t):
    name = "expect_select_column_values_to_be_unique_within_record"
    return REGISTRY[name](rows_of(t, "scored_documents"), ["quality", "toxic", "lang"], carry=["doc_id"])


# --- distribution ----------------------------------------------------------------------------


@query(
    """SELECT * FROM (SELECT user_id, round(v, 4) AS value, round(avg(v) OVER (), 4) AS value_average,
           round(stddev_samp(v) OVER (), 4) AS value_stddev,
           round((v - avg(v) OVER ()) / stddev_samp(v) OVER (), 4) AS value_sigma
           FROM (SELECT user_id, sum(value) AS v FROM events GROUP BY 1)) WHERE abs(value_sigma) > 1.5"""
)
def within_n_stdevs(t):
    found = ck.distribution.expect_column_values_to_be_within_n_stdevs(t("events"), "value", ["user_id"], 1.5)
    return found.select("user_id", *[F.round(c, 4).alias(c) for c in found.columns[1:]])


@query("SELECT sum(value) AS value, avg(value) AS value_average, avg(value) AS value_stddev, avg(value) AS value_sigma FROM events HAVING false")
def within_n_stdevs_ungrouped(t):
    """A single sum has no deviation, so this form passes whatever the data."""
    return ck.distribution.expect_column_values_to_be_within_n_stdevs(t("events"), "value", None, 1)


def _moving_sql(take_logs: bool, take_diffs: bool) -> str:
    metric = (lambda c: f"coalesce(ln(nullif({c}, 0)), 0)") if take_logs else (lambda c: f"coalesce({c}, 0)")
    value = f"{metric('v')} - {metric('p')}" if take_diffs else metric("v")
    prior = "round(p, 4) AS prior_agg_metric_value," if take_diffs else ""
    return f"""
    SELECT metric_period, event_type, round(v, 4) AS agg_metric_value, {prior}
           round(x, 6) AS metric_test_value, round(a, 6) AS metric_test_rolling_average,
           round(s, 6) AS metric_test_rolling_stddev, round(x - a, 6) AS metric_test_delta,
           round((x - a) / nullif(s, 0), 4) AS metric_test_sigma
    FROM (SELECT *, avg(x) OVER w AS a, stddev_samp(x) OVER w AS s FROM (
        SELECT *, {value} AS x FROM (
            SELECT *, lag(v, 1) OVER (PARTITION BY event_type ORDER BY metric_period) AS p FROM (
                SELECT date_trunc('day', ts) AS metric_period, event_type, sum(value) AS v
                FROM events GROUP BY 1, 2)))
        WINDOW w AS (PARTITION BY event_type ORDER BY metric_period ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING))
    WHERE metric_period >= TIMESTAMP '2024-01-16' AND metric_period < TIMESTAMP '2024-01-30'
      AND NOT ((x - a) / nullif(s, 0) >= -1.5 AND (x - a) / nullif(s, 0) <= 1.5)"""


def _moving(take_logs: bool, take_diffs: bool):
    def build(t):
        found = ck.distribution.expect_column_values_to_be_within_n_moving_stdevs(
            t("events"), "value", "ts", ["event_type"], sigma_threshold=1.5, take_logs=take_logs,
            take_diffs=take_diffs, tz="UTC", as_of="2024-01-30 05:00:00",
        )
        digits = {"agg_metric_value": 4, "prior_agg_metric_value": 4, "metric_test_sigma": 4}
        kept = ["metric_period", "event_type"]
        return found.select(*kept, *[F.round(c, digits.get(c, 6)).alias(c) for c in found.columns if c not in kept])

    return build


for _logs in (True, False):
    for _diffs in (True, False):
        add(
            f"within_n_moving_stdevs{'_logs' if _logs else ''}{'_diffs' if _diffs else ''}",
            _moving(_logs, _diffs),
            _moving_sql(_logs, _diffs),
        )

PURCHASE_DAYS = "FROM events WHERE event_type = 'signup' AND value > 250"


@query(
    f"""SELECT date_day, true AS is_missing, CAST(0 AS BIGINT) AS row_cnt FROM (
            SELECT unnest(range(CAST(CAST(min(ts) AS DATE) AS TIMESTAMP), CAST(CAST(max(ts) AS DATE) AS TIMESTAMP),
                                INTERVAL 1 DAY)) AS date_day {PURCHASE_DAYS})
        WHERE date_day NOT IN (SELECT date_trunc('day', ts) {PURCHASE_DAYS})
          AND date_day <> TIMESTAMP '2024-01-03'"""
)
def data_for_every_day(t):
    return ck.distribution.expect_row_values_to_have_data_for_every_n_datepart(
        t("events"), "ts", "day", row_condition="event_type = 'signup' and value > 250",
        exclusion_condition="date_day <> timestamp_ntz'2024-01-03 00:00:00'",
    )


@query(
    f"""SELECT date_hour, true AS is_missing, CAST(0 AS BIGINT) AS row_cnt FROM (
            SELECT unnest(range(TIMESTAMP '2024-01-02', TIMESTAMP '2024-01-29', INTERVAL 6 HOUR)) AS date_hour)
        WHERE date_hour NOT IN (SELECT time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '2024-01-02') {PURCHASE_DAYS})"""
)
def data_for_every_six_hours(t):
    return ck.distribution.expect_row_values_to_have_data_for_every_n_datepart(
        t("events"), "ts", "hour", interval=6, row_condition="event_type = 'signup' and value > 250",
        test_start_date="2024-01-02", test_end_date="2024-01-29",
    )
