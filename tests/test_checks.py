"""Checks on small tables, each once with arguments that hold and once with arguments that do not."""

import re

import pytest

from veritally.checks import REGISTRY, CheckSpec, run_suite
from veritally.checks.suite import worst
from veritally.functions import scalar
from veritally.functions.scalar import regexp_instr, with_flags

DATA = [
    (1, "2020-10-21", 0.0, 1.0, "a", "b", None, None, 1.0, 2, -2),
    (2, "2020-10-22", 1.0, 0.0, "b", "ab", None, None, 1.0, 4, -4),
    (3, "2020-10-23", 0.5, 0.5, "c", "abc", None, None, 1.0, 6, -6),
    (4, "2020-10-23", 0.5, 0.5, "c", "abcd", None, None, 1.0, 8, -8),
]
NAMES = (
    "idx date_col col_numeric_a col_numeric_b col_string_a col_string_b col_null col_null_2 "
    "col_numeric_a_plus_b idx_multiplied_by_2 idx_multiplied_by_minus_2"
).split()
KINDS = ["int", "string", *["double"] * 2, *["string"] * 4, "double", "int", "int"]
TEXTS = [
    ("ab@gmail.com", "91001", "91001-123"),
    ("ab@mail.com", "90210", "90210-123"),
    ("abc@gmail.com", "90026", "90026-123"),
    ("abc.com@gmail.com", "09876", "09876-023"),
]


@pytest.fixture(scope="module")
def tables(spark):
    data = spark.createDataFrame(DATA, ", ".join(f"{n} {k}" for n, k in zip(NAMES, KINDS, strict=True)))
    factored = data.selectExpr("1 as factor", "*").unionAll(data.selectExpr("2 as factor", "*"))
    text = spark.createDataFrame(TEXTS, "email_address string, postal_code_5 string, postal_code_5_3 string")
    return {"data": data.persist(), "factored": factored, "text": text.persist()}


E = "email_address"
A = "col_numeric_a"
AB = [A, "col_numeric_b"]
# check (without its prefix), table, arguments, number of violations; "@x" names a table.
CASES = [
    ("column_values_to_match_regex", "text", {"column_name": E, "regex": "@[^.]*"}, 0),
    ("column_values_to_match_regex", "text", {"column_name": E, "regex": "&[^.]*"}, 4),
    ("column_values_to_match_regex", "text", {"column_name": E, "regex": "[A-Z]", "flags": "i"}, 0),
    ("column_values_to_match_regex", "text", {"column_name": E, "regex": "(?i)[A-Z]", "flags": "i"}, 0),
    ("column_values_to_match_regex", "text", {"column_name": E, "regex": "[A-Z]", "flags": "c"}, 4),
    ("column_values_to_match_regex", "text", {"column_name": "postal_code_5", "regex": r"^\d{5}", "is_raw": True}, 0),
    ("column_values_to_match_regex", "text", {"column_name": "postal_code_5_3", "regex": r"^\d{5}-\d{9}"}, 4),
    ("column_values_to_not_match_regex", "text", {"column_name": E, "regex": "[A-Z]"}, 0),
    ("column_values_to_not_match_regex", "text", {"column_name": E, "regex": "[a-z]"}, 4),
    ("column_values_to_match_regex_list", "text", {"column_name": E, "regex_list": ["@[^.]*", "&[^.]*"]}, 0),
    ("column_values_to_match_regex_list", "text", {"column_name": E, "regex_list": ["#[^.]*", "&[^.]*"]}, 4),
    ("column_values_to_match_regex_list", "text",
     {"column_name": E, "regex_list": ["@[^.]*", "&[^.]*"], "match_on": "all"}, 4),
    ("column_values_to_not_match_regex_list", "text", {"column_name": E, "regex_list": ["@[^.]*", "&[^.]*"]}, 0),
    ("column_values_to_not_match_regex_list", "text", {"column_name": E, "regex_list": ["@[^.]*", "@[^.]*"]}, 4),
    ("column_values_to_not_match_regex_list", "text",
     {"column_name": E, "regex_list": ["@[^.]*", "&[^.]*"], "match_on": "all"}, 4),
    ("column_values_to_match_like_pattern", "text", {"column_name": E, "like_pattern": "%@%"}, 0),
    ("column_values_to_match_like_pattern", "text", {"column_name": E, "like_pattern": "%&%"}, 4),
    ("column_values_to_not_match_like_pattern", "text", {"column_name": E, "like_pattern": "%@%"}, 4),
    ("column_values_to_match_like_pattern_list", "text", {"column_name": E, "like_pattern_list": ["%@%", "%&%"]}, 0),
    ("column_values_to_match_like_pattern_list", "text",
     {"column_name": E, "like_pattern_list": ["%@%", "%&%"], "match_on": "all"}, 4),
    ("column_values_to_not_match_like_pattern_list", "text",
     {"column_name": E, "like_pattern_list": ["%@%", "%&%"]}, 0),
    ("column_values_to_not_match_like_pattern_list", "text",
     {"column_name": E, "like_pattern_list": ["%@%", "%&%"], "match_on": "all"}, 4),
    ("compound_columns_to_be_unique", "data", {"column_list": ["date_col", "col_string_b"]}, 0),
    ("compound_columns_to_be_unique", "data",
     {"column_list": ["date_col", "col_null"], "ignore_row_if": "any_value_is_missing"}, 0),
    ("compound_columns_to_be_unique", "data",
     {"column_list": ["date_col", "col_null"], "ignore_row_if": "all_values_are_missing"}, 1),
    ("compound_columns_to_be_unique", "data", {"column_list": ["col_null", "col_null_2"]}, 0),
    ("table_row_count_to_equal", "data", {"value": 4}, 0),
    ("table_row_count_to_equal", "data", {"value": 5}, 1),
    ("table_row_count_to_be_between", "data", {"min_value": 1, "max_value": 4}, 0),
    ("table_row_count_to_be_between", "data", {"min_value": 4, "strictly": True}, 1),
    ("table_row_count_to_equal_other_table", "data", {"compare_model": "@data", "row_condition": "1=1"}, 0),
    ("table_row_count_to_equal_other_table_times_factor", "factored", {"compare_model": "@data", "factor": 2}, 0),
    ("table_row_count_to_equal_other_table_times_factor", "factored",
     {"compare_model": "@data", "factor": 2, "group_by": ["date_col", "idx"]}, 0),
    ("table_row_count_to_equal_other_table_times_factor", "factored",
     {"compare_model": "@data", "factor": 3, "group_by": ["date_col"]}, 3),
    ("table_column_count_to_equal", "data", {"value": 11}, 0),
    ("table_column_count_to_equal", "data", {"value": 10}, 1),
    ("table_column_count_to_be_between", "data", {"min_value": 1, "max_value": 11}, 0),
    ("table_column_count_to_be_between", "data", {"max_value": 10}, 1),
    ("table_column_count_to_be_between", "data", {"max_value": 0}, 0),
    ("table_column_count_to_equal_other_table", "data", {"compare_model": "@data"}, 0),
    ("table_column_count_to_equal_other_table", "data", {"compare_model": "@factored"}, 1),
    ("table_columns_to_contain_set", "data", {"column_list": ["col_numeric_b", "COL_STRING_A"]}, 0),
    ("table_columns_to_contain_set", "data", {"column_list": ["col_numeric_b", "nope"]}, 1),
    ("table_columns_to_not_contain_set", "data", {"column_list": ["col_numeric_c"]}, 0),
    ("table_columns_to_match_set", "data", {"column_list": list(reversed(NAMES))}, 0),
    ("table_columns_to_match_set", "data", {"column_list": [*NAMES[1:], "nope"]}, 2),
    ("table_columns_to_match_ordered_list", "data", {"column_list": NAMES}, 0),
    ("table_columns_to_match_ordered_list", "data", {"column_list": [NAMES[1], NAMES[0], *NAMES[2:]]}, 4),
    ("column_to_exist", "data", {"column_name": "idx", "column_index": 1}, 0),
    ("column_to_exist", "data", {"column_name": A, "column_index": 3}, 0),
    ("column_to_exist", "data", {"column_name": A, "column_index": 1}, 1),
    ("column_to_exist", "data", {"column_name": "nope"}, 1),
    ("table_aggregation_to_equal_other_table", "data",
     {"expression": f"sum({A})", "compare_expression": f"sum({A} * .99)", "compare_model": "@data",
      "group_by": ["idx"], "tolerance_percent": 0.95}, 0),
    ("table_aggregation_to_equal_other_table", "data",
     {"expression": f"sum({A})", "compare_expression": f"sum({A} * .9)", "compare_model": "@data",
      "group_by": ["idx"]}, 3),
    ("column_pair_values_to_be_in_set", "data",
     {"column_A": A, "column_B": "col_numeric_b", "value_pairs_set": [[0, 1], [1, 0], [0.5, 0.5]]}, 0),
    ("column_pair_values_to_be_in_set", "data",
     {"column_A": A, "column_B": "col_numeric_b", "value_pairs_set": [[0, 1], [1, 0]]}, 2),
    ("column_pair_values_A_to_be_greater_than_B", "data", {"column_A": f"{A}+10", "column_B": A}, 0),
    ("column_pair_values_A_to_be_greater_than_B", "data", {"column_A": A, "column_B": A, "or_equal": True}, 0),
    ("column_pair_values_A_to_be_greater_than_B", "data", {"column_A": A, "column_B": A}, 4),
    ("column_pair_values_to_be_equal", "data", {"column_A": A, "column_B": A}, 0),
    ("select_column_values_to_be_unique_within_record", "data",
     {"column_list": ["col_string_a", "col_string_b"], "ignore_row_if": "any_value_is_missing"}, 0),
    ("select_column_values_to_be_unique_within_record", "data", {"column_list": ["col_string_a", "col_null"]}, 4),
    ("multicolumn_sum_to_equal", "data", {"column_list": AB, "sum_total": 4}, 0),
    ("multicolumn_sum_to_equal", "data", {"column_list": AB, "sum_total": "col_numeric_a_plus_b"}, 0),
    ("multicolumn_sum_to_equal", "data",
     {"column_list": AB, "sum_total": "col_numeric_a_plus_b", "group_by": ["idx"]}, 0),
    ("multicolumn_sum_to_equal", "data", {"column_list": AB, "sum_total": 5}, 1),
    ("column_values_to_be_unique", "data", {"column_name": "idx"}, 0),
    ("column_values_to_be_increasing", "data", {"column_name": "idx", "sort_column": "idx"}, 0),
    ("column_values_to_be_increasing", "data", {"column_name": A, "sort_column": A, "strictly": False}, 0),
    ("column_values_to_be_increasing", "data", {"column_name": A, "sort_column": A}, 1),
    ("column_values_to_be_increasing", "data",
     {"column_name": "idx_multiplied_by_2", "sort_column": "idx", "step": 2}, 0),
    ("column_values_to_be_increasing", "data",
     {"column_name": "idx_multiplied_by_2", "sort_column": "idx", "step": 1}, 3),
    ("column_values_to_be_decreasing", "data",
     {"column_name": "idx_multiplied_by_minus_2", "sort_column": "idx", "step": 2}, 0),
    ("column_values_to_not_be_null", "data", {"column_name": A}, 0),
    ("column_values_to_be_null", "data", {"column_name": "col_null"}, 0),
    ("column_values_to_be_null", "data", {"column_name": A}, 4),
    ("column_values_to_be_between", "data", {"column_name": A, "min_value": 0, "max_value": 1}, 0),
    ("column_values_to_be_between", "data", {"column_name": A, "min_value": 0, "strictly": True}, 1),
    ("column_values_to_be_between", "data", {"column_name": "col_null", "min_value": "'a'"}, 0),
    ("column_sum_to_be_between", "data", {"column_name": A, "min_value": 1, "max_value": 3}, 0),
    ("column_min_to_be_between", "data", {"column_name": A, "min_value": 0, "max_value": 0}, 0),
    ("column_max_to_be_between", "data", {"column_name": A, "min_value": 1, "max_value": 1}, 0),
    ("column_mean_to_be_between", "data", {"column_name": A, "min_value": 0, "max_value": 0.4}, 1),
    ("column_median_to_be_between", "data", {"column_name": A, "min_value": 0.5, "max_value": 0.5}, 0),
    ("column_quantile_values_to_be_between", "data", {"column_name": A, "quantile": 0.95, "max_value": 0.9}, 1),
    ("column_unique_value_count_to_be_between", "data", {"column_name": A, "min_value": 3, "max_value": 3}, 0),
    ("column_proportion_of_unique_values_to_be_between", "data",
     {"column_name": A, "min_value": 0, "max_value": 0.75}, 0),
    ("column_proportion_of_unique_values_to_be_between", "data", {"column_name": "col_null", "max_value": 0.9}, 1),
    ("column_stdev_to_be_between", "data", {"column_name": A, "min_value": 0, "strictly": True}, 0),
    ("column_stdev_to_be_between", "data", {"column_name": A, "max_value": 0, "group_by": ["idx"]}, 0),
    ("column_most_common_value_to_be_in_set", "data",
     {"column_name": A, "value_set": [0.5], "top_n": 1, "quote_values": False, "data_type": "double"}, 0),
    ("column_most_common_value_to_be_in_set", "data",
     {"column_name": "col_string_a", "value_set": ["a"], "top_n": 1}, 1),
    ("column_most_common_value_to_be_in_set", "data", {"column_name": "idx", "value_set": ["9"], "top_n": 9}, 0),
    ("column_values_to_be_in_set", "data", {"column_name": "col_string_a", "value_set": ["a", "b", "c"]}, 0),
    ("column_values_to_be_in_set", "data", {"column_name": "col_null", "value_set": ["a"]}, 4),
    ("column_values_to_not_be_in_set", "data", {"column_name": "col_string_a", "value_set": ["2", "3"]}, 0),
    ("column_values_to_not_be_in_set", "data", {"column_name": "col_string_a", "value_set": ["c", "c"]}, 4),
    ("column_distinct_values_to_equal_set", "data",
     {"column_name": "col_string_a", "value_set": ["a", "b", "c", "c"]}, 0),
    ("column_distinct_values_to_equal_set", "data", {"column_name": "col_string_a", "value_set": ["a", "b", "x"]}, 2),
    ("column_distinct_values_to_be_in_set", "data",
     {"column_name": "col_string_a", "value_set": ["a", "b", "c", "d"]}, 0),
    ("column_distinct_values_to_contain_set", "data", {"column_name": "col_string_a", "value_set": ["a", "b"]}, 0),
    ("column_distinct_values_to_contain_set", "data", {"column_name": "col_string_a", "value_set": ["a", "z"]}, 1),
    ("column_value_lengths_to_equal", "data", {"column_name": "col_string_a", "value": 1}, 0),
    ("column_value_lengths_to_be_between", "data", {"column_name": "col_string_b", "max_value": 3}, 1),
    ("column_values_to_have_consistent_casing", "data", {"column_name": "col_string_a"}, 0),
    ("column_values_to_have_consistent_casing", "data", {"column_name": "col_null"}, 1),
    ("column_distinct_count_to_be_less_than", "data", {"column_name": "col_string_a", "value": 4}, 0),
    ("column_distinct_count_to_be_greater_than", "data", {"column_name": "col_string_a", "value": 3}, 1),
    ("column_distinct_count_to_equal_other_table", "data",
     {"column_name": "col_string_a", "compare_column_name": "idx"}, 1),
    ("column_values_to_be_of_type", "data", {"column_name": "idx", "column_type": "integer"}, 0),
    ("column_values_to_be_of_type", "data", {"column_name": "idx", "column_type": "string"}, 1),
    ("column_values_to_be_in_type_list", "data", {"column_name": "nope", "column_type_list": ["string"]}, 0),
]


def labels():
    return [f"{i}-{c}" for i, (c, *_) in enumerate(CASES)]


@pytest.mark.parametrize(("check", "table", "arguments", "violations"), CASES, ids=labels())
def test_case(tables, check, table, arguments, violations):
    given = {
        k: tables[v[1:]] if isinstance(v, str) and v.startswith("@") and v[1:] in tables else v
        for k, v in arguments.items()
    }
    assert REGISTRY[f"expect_{check}"](tables[table], **given).count() == violations


def test_bad_arguments(tables):
    data = tables["data"]
    with pytest.raises(ValueError):
        REGISTRY["expect_column_values_to_be_between"](data, "idx")
    with pytest.raises(ValueError):
        REGISTRY["expect_compound_columns_to_be_unique"](data, ["idx"], ignore_row_if="never")
    with pytest.raises(ValueError):
        REGISTRY["expect_column_pair_values_to_be_in_set"](data, "idx", "idx", [[1, 2, 3]])
    with pytest.raises(ValueError):
        with_flags("x", "U")
    with pytest.raises(ValueError):
        CheckSpec("no_such_check")


def test_null_groups_pair_only_if_asked(spark):
    table = spark.createDataFrame([(None, 1), ("a", 1)], "g string, x int")
    compare = REGISTRY["equal_expression"]
    assert compare(table, "sum(x)", group_by=["g"]).count() == 2
    assert compare(table, "sum(x)", group_by=["g"], null_safe=True).count() == 0


def test_empty_tables(spark):
    events = spark.createDataFrame([], "g string, ts timestamp_ntz")
    at = {"datepart": "day", "interval": 1, "tz": "UTC", "as_of": "2024-01-01"}
    assert REGISTRY["expect_row_values_to_have_recent_data"](events, "ts", **at).count() == 1
    grouped = "expect_grouped_row_values_to_have_recent_data"
    assert REGISTRY[grouped](events, ["g"], "ts", **at).count() == 0
    spec = CheckSpec(grouped, {"group_by": ["g"], "timestamp_column": "ts", **at})
    row = run_suite(events, [spec]).first()
    assert (row["status"], row["vacuous"]) == ("pass", True)


def test_period_alignment(spark):
    days = spark.createDataFrame([("2024-01-10",), ("2024-02-20",), ("2024-04-05",)], "d string")
    gaps = REGISTRY["expect_row_values_to_have_data_for_every_n_datepart"]
    months = gaps(days, "cast(d as date)", "month", align=True)
    assert [str(r[0].date()) for r in months.collect()] == ["2024-03-01"]
    # Without alignment the spine starts on the 10th and meets no truncated month.
    assert gaps(days, "cast(d as date)", "month").count() == 3


def test_suite(tables):
    between = "expect_column_values_to_be_between"
    specs = [
        CheckSpec("not_null", {"column_name": "idx"}),
        CheckSpec(between, {"column_name": A, "min_value": 0.5}, "low"),
        CheckSpec(between, {"column_name": A, "min_value": 0.5, "row_condition": "idx > 1"}, "conditional"),
        CheckSpec(between, {"column_name": A, "min_value": 0.5}, "warn", severity="warn", error_if="> 0"),
        CheckSpec("expect_column_sum_to_be_between", {"column_name": A, "max_value": 1}, "sum"),
        CheckSpec("unique", {"column_name": "date_col"}),
        CheckSpec("expect_column_values_to_be_null", {"column_name": "col_null"}, "inverted", error_if="= 0"),
    ]
    report = run_suite(tables["data"], specs)
    found = {r["check"]: (r["failures"], r["status"]) for r in report.collect()}
    assert found == {
        "not_null:idx": (0, "pass"),
        "low": (1, "error"),
        "conditional": (0, "pass"),
        "warn": (1, "warn"),
        "sum": (1, "error"),
        "unique:date_col": (1, "error"),
        "inverted": (0, "error"),
    }
    assert tuple(worst(report).first()) == (7, 2, 1, 4)


def test_suite_shares_one_scan(spark):
    lines = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    names = ("l_quantity", "l_tax", "l_discount")
    specs = [CheckSpec("not_null", {"column_name": c}) for c in names]
    specs += [CheckSpec("expect_column_max_to_be_between", {"column_name": c, "max_value": 9}) for c in names]
    plan = run_suite(lines, specs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    assert "ReadSchema: struct<l_quantity:double,l_discount:double,l_tax:double>" in plan


def test_suite_shares_expressions_and_conditions(spark):
    """Shared counts equal those of each check by itself; what cannot be shared still runs."""
    lines = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    returned = "l_returnflag = 'R'"
    specs = [
        CheckSpec("expression_is_true", {"expression": "l_tax + l_discount < 0.1"}),
        CheckSpec("expression_is_true", {"expression": "l_tax", "test_condition": "< 0.05", "row_condition": returned}),
        CheckSpec("expression_between", {"expression": "l_quantity * 2", "min_value": 10, "max_value": 60}),
        CheckSpec("expect_column_max_to_be_between", {"column_name": "l_tax", "max_value": 0.01, "row_condition": returned}),
        CheckSpec("expect_column_mean_to_be_between", {"column_name": "l_tax", "max_value": 1, "row_condition": "false"}),
    ]
    alone = [s.violations(lines).count() for s in specs]
    report = run_suite(lines, specs)
    assert report._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert [r["failures"] for r in report.collect()] == alone
    assert alone[0] and alone[1] and alone[2] and alone[3:] == [1, 0]

    unshared = [
        CheckSpec("expression_is_true", {"expression": "sum(l_tax) < 0"}),
        CheckSpec("expression_is_true", {"expression": "l_tax", "test_condition": "> 0 or expression < 0"}),
        CheckSpec("expression_is_true", {"expression": "sum(l_tax) < 0", "group_by_columns": ["l_returnflag"]}),
    ]
    assert [r["failures"] for r in run_suite(lines, unshared).collect()] == [
        s.violations(lines).count() for s in unshared
    ]


def test_sets_are_compared_as_values(spark):
    """Members written differently are one value, however long the set is; long lists plan at once."""
    numbers = spark.createDataFrame([(1,), (2,), (None,)], "v int")
    outside, inside = REGISTRY["expect_column_values_to_be_in_set"], REGISTRY["expect_column_values_to_not_be_in_set"]
    assert inside(numbers, "v", [1, "1.0"], quote_values=False).count() == 2
    assert inside(numbers, "v", ["1", "01"]).count() == 2
    assert outside(numbers, "v", [1, *range(5, 9000)], quote_values=False).count() == 2
    assert outside(numbers, "v", [str(k) for k in range(1, 9000)]).count() == 1


def test_long_lists_of_patterns(spark):
    texts = spark.createDataFrame([("a1",), ("zz",)], "v string")
    found = REGISTRY["expect_column_values_to_match_regex_list"](texts, "v", [f"a{k}" for k in range(2000)])
    assert found.count() == 1


def test_type_names(spark):
    table = spark.createDataFrame([], "t tinyint, b bigint, d decimal(10,2)")
    typed = REGISTRY["expect_column_values_to_be_of_type"]
    assert [typed(table, c, k).count() for c, k in (("t", "int8"), ("b", "int8"), ("d", "numeric"))] == [1, 0, 0]


def test_later_matches_keep_back_references(spark, rows):
    df = spark.createDataFrame([("xaaybb",), ("none",), (None,)], "s string")
    found = df.select(
        scalar.regexp_instr("s", r"([ab])\1", occurrence=2), scalar.regexp_instr("s", r"([ab])\1", position=4)
    )
    assert rows(found) == [(0, 0), (5, 5), (None, None)]


def test_positions_of_matches(spark):
    """Of the n-th match from a place on, as ``finditer`` finds them, with what stands before the place in sight."""
    texts = ["aaa", "xaxa", "a\uffffa\uffffa", "", "b", "foo bar foobar", "aab aab", "ab\nab"]
    table = spark.createDataFrame([(t,) for t in [*texts, None]], "t string")
    for pattern in ("a", "aa", "a*", r"\bfoo", r"(?<=x)a", r"(a)\1b", "o+", r"\Bb", "$", "."):
        for position in (1, 2, 3, 5):
            for occurrence in (1, 2, 3):
                found = {r[0]: r[1] for r in table.select("t", regexp_instr("t", pattern, position, occurrence)).collect()}
                for text in texts:
                    starts = [m.start() + 1 for m in re.compile(pattern).finditer(text, position - 1)]
                    if pattern == "$" and text.endswith("\n"):
                        continue
                    want = starts[occurrence - 1] if len(starts) >= occurrence else 0
                    if position - 1 > len(text):
                        want = 0
                    assert found[text] == want, (text, pattern, position, occurrence)
                assert found[None] is None
