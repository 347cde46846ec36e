"""The ways taken for groups too large for one task give the rows of the plain ways."""

import random
import time
from collections import Counter, defaultdict
from dataclasses import replace

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from veritally.checks import CheckSpec, kernel, run_suite, values
from veritally.checks.kernel import REGISTRY
from veritally.operators import ordered
from veritally.operators.latest import latest_by_key, upsert
from veritally.operators.membership import not_in
from veritally.operators.ordered import lag_rows, repeat_rows, running_sum, trailing
from veritally.operators.quantile import percentile_by
from veritally.operators.ranges import with_range

SEED = 5


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows in one group, a third of them equal, some values missing."""
    pick = random.Random(SEED)
    rows = []
    for i in range(3000):
        group = "hot" if i % 3 == 0 else pick.choice(["a", "b", "c", None])
        stamp = 7 if i % 9 == 0 else pick.randrange(400)
        value = 1.0 if i % 9 == 0 else pick.choice([None, float(pick.randrange(50)), pick.random()])
        rows.append((group, stamp, value, i))
    df = spark.createDataFrame(rows, "g string, s int, v double, i int")
    return df.repartition(8).persist()


def counted(df):
    return Counter(map(tuple, df.collect()))


@pytest.mark.parametrize("group_by", [None, ["g"]])
@pytest.mark.parametrize("strictly", [True, False])
@pytest.mark.parametrize("check", ["increasing", "decreasing"])
def test_order_checks(skewed, check, strictly, group_by):
    run = getattr(values, f"expect_column_values_to_be_{check}")
    plain, ranged = (
        run(skewed, "v", sort_column="s", strictly=strictly, group_by=group_by, whole_groups=whole)
        for whole in (True, False)
    )
    assert counted(plain) == counted(ranged)
    assert sum(counted(plain).values()) > 30


def test_order_check_against_brute_force(skewed):
    groups = defaultdict(list)
    for g, s, v, _ in skewed.collect():
        groups[g].append((s, v is not None, v))
    expected = Counter()
    for g, members in groups.items():
        members.sort(key=lambda m: (m[0], m[1], m[2] or 0))
        for (_, _, before), (s, _, v) in zip(members, members[1:], strict=False):
            if before is not None and v is not None and not v > before:
                expected[(s, g, v, before)] += 1
    found = values.expect_column_values_to_be_increasing(
        skewed, "v", sort_column="s", group_by=["g"]
    )
    assert counted(found) == expected


@pytest.mark.parametrize("quantile", [0.0, 0.1, 0.5, 0.77, 1.0])
@pytest.mark.parametrize("keys", [[], ["g"]])
def test_quantiles(skewed, quantile, keys):
    plain, ranged = (
        percentile_by(skewed, "v", quantile, keys, whole_groups=whole).collect() for whole in (True, False)
    )
    assert sorted(map(tuple, plain), key=repr) == sorted(map(tuple, ranged), key=repr)


def test_quantile_of_nothing(spark):
    empty = spark.createDataFrame([("a", None), ("b", 2.0)], "g string, v double")
    found = {r["g"]: r["percentile"] for r in percentile_by(empty, "v", 0.5, ["g"]).collect()}
    assert found == {"a": None, "b": 2.0}


@pytest.mark.parametrize("descending", [True, False])
def test_running_sums(skewed, descending):
    plain, ranged = (
        running_sum(skewed, "v", "s", ["g"], "t", descending, whole).select("i", F.round("t", 6)).collect()
        for whole in (True, False)
    )
    assert sorted(map(tuple, plain)) == sorted(map(tuple, ranged))


@pytest.mark.parametrize("rows_back", [1, 3, 40])
@pytest.mark.parametrize("keys", [[], ["g"]])
def test_rows_before(skewed, rows_back, keys):
    """Lags and trailing frames over ranges are those over whole groups, also where ranges hold fewer rows."""
    plain, ranged = (
        lag_rows(skewed, "v", ["s", "i"], rows_back, keys, "before", whole).collect() for whole in (True, False)
    )
    assert sorted(map(tuple, plain), key=repr) == sorted(map(tuple, ranged), key=repr)
    made = {"n": F.count("v"), "least": F.min("v"), "ids": F.collect_list("i")}
    for current in (False, True):
        plain, ranged = (
            trailing(skewed, made, ["s", "i"], rows_back, keys, current, whole).collect() for whole in (True, False)
        )
        assert sorted(map(repr, plain)) == sorted(map(repr, ranged))


def test_rows_before_against_brute_force(skewed):
    groups = defaultdict(list)
    for g, s, v, i in skewed.collect():
        groups[g].append((s, i, v))
    want = {}
    for members in groups.values():
        members.sort()
        for place, (_, i, _) in enumerate(members):
            want[i] = members[place - 7][2] if place >= 7 else None
    found = lag_rows(skewed, "v", ["s", "i"], 7, ["g"])
    assert {r["i"]: r["lag"] for r in found.collect()} == want


def test_pair_sets(spark):
    """A join to 100,000 pairs leaves the rows that the comparison one by one leaves, missing values included."""
    pick = random.Random(SEED)
    value = lambda: pick.choice([None, *range(6)])
    rows = spark.createDataFrame([(i, value(), value()) for i in range(400)], "i int, a int, b int")
    check = REGISTRY["expect_column_pair_values_to_be_in_set"]
    few = [[0, 1], [2, 2], [4, 0.0]]
    joined = check(rows, "a", "b", few, carry=["i"])
    compared = check(rows, "a", "b", [*few, ["0 + 0", "1"]], carry=["i"])
    assert counted(joined) == counted(compared) and 0 < joined.count() < 400
    many = few + [[n, n] for n in range(1000, 101_000)]
    start = time.monotonic()
    assert counted(check(rows, "a", "b", many, carry=["i"])) == counted(joined)
    assert time.monotonic() - start < 60
    text = spark.createDataFrame([("x", "y"), ("x", None), ("z", "y"), ("it's", "y")], "a string, b string")
    found = check(text, "a", "b", [["'x'", "'y'"], ["'it''s'", "'y'"]], carry=["a"])
    assert counted(found) == {("z", False): 1}


def test_suites_share_scans(spark):
    """Row checks in one scan, checks on distinct values in another, equal to each check by itself."""
    table = spark.createDataFrame(
        [(1, "a", 1.0), (1, "b", None), (2, None, 2.0), (None, "a", -0.0), (None, "c", 0.0)], "k int, s string, d double"
    )
    parents = spark.createDataFrame([(1,), (1,), (None,)], "p int")
    wide = parents.selectExpr("cast(p as bigint) as p")
    column = lambda c, **more: {"column_name": c, **more}
    specs = [
        CheckSpec("unique", column("k")), CheckSpec("expect_column_values_to_be_unique", column("d")),
        CheckSpec("unique", column("s", row_condition="k is null")),
        CheckSpec("relationships", column("k", to=parents, field="p")),
        CheckSpec("relationships", column("k", to=wide, field="p")),
        CheckSpec("expect_column_values_to_be_in_set", column("s", value_set=["a"])),
        CheckSpec("expect_column_values_to_be_in_set", column("s", value_set=[])),
        CheckSpec("expect_column_distinct_count_to_equal", column("s", value=3)),
        CheckSpec("expect_column_distinct_count_to_be_greater_than", column("d", value=3, row_condition="k = 1")),
        CheckSpec("expect_column_unique_value_count_to_be_between", column("k", min_value=3)),
        CheckSpec("not_null", column("s")),
    ]
    specs = [replace(s, label=str(i)) for i, s in enumerate(specs)]
    found = {r["check"]: r["failures"] for r in run_suite(table, specs).collect()}
    assert found == {s.name: s.violations(table).count() for s in specs}
    assert sum(found.values()) > 8
    empty = {r["check"]: r["failures"] for r in run_suite(table.limit(0), specs).collect()}
    assert empty == {s.name: s.violations(table.limit(0)).count() for s in specs}


def test_building_a_plan_runs_no_job(spark, skewed):
    context = spark.sparkContext
    skewed.count()
    context.setJobGroup("building", "plans")
    try:
        running_sum(skewed, "v", "s", ["g"])
        percentile_by(skewed, "v", 0.5, ["g"])
        values.expect_column_values_to_be_increasing(skewed, "v", sort_column="s", group_by=["g"])
        assert not context.statusTracker().getJobIdsForGroup("building")
        skewed.count()
        assert context.statusTracker().getJobIdsForGroup("building")
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize("descending", [True, False])
def test_ranges_follow_the_order(skewed, descending):
    """Also for text, where nulls and a common prefix must not blur the bounds."""
    texts = skewed.select("g", F.concat(F.lit("a common prefix "), "i").alias("x")).distinct()
    placed = with_range(texts, [("g", False), ("x", descending)]).collect()
    assert len({r["__range"] for r in placed}) > 8
    by_text = sorted(placed, key=lambda r: r["x"], reverse=descending)
    in_order = sorted(by_text, key=lambda r: (r["g"] is not None, r["g"] or ""))
    numbers = [r["__range"] for r in in_order]
    assert numbers == sorted(numbers)
    assert max(Counter(numbers).values()) < len(placed) / 4


def test_ranges_are_not_put_into_what_uses_them(spark, skewed):
    """A filter by the range must not write the search into itself, whose size doubles twice with every step."""
    placed = with_range(skewed.select("g", "i"), [("g", False), ("i", False)])
    plan = placed.filter("__range = 3")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("CASE WHEN") < 20
    assert placed.filter("__range = 3").count() == sum(r["__range"] == 3 for r in placed.collect()) > 0


def test_running_sums_at_the_default_partitions(spark, skewed):
    """One running sum on top of another, planned in seconds also with many ranges."""
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        started, df = time.monotonic(), skewed
        for alias, descending in (("up", False), ("down", True)):
            df = running_sum(df, "v", "s", ["g"], alias, descending)
        df._jdf.queryExecution().executedPlan()
        assert time.monotonic() - started < 60
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_repeated_rows(spark, monkeypatch):
    monkeypatch.setattr(ordered, "COPIES_PER_TASK", 7)
    df = spark.createDataFrame([("a", 1), ("b", 7), ("c", 8), ("d", 50)], "k string, n bigint")
    assert counted(repeat_rows(df, "n")) == {("a",): 1, ("b",): 7, ("c",): 8, ("d",): 50}


def test_latest_combines_before_the_shuffle(skewed):
    plan = latest_by_key(skewed, ["g"], "s")._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan and "Window" not in plan


def test_upsert_compares_only_touched_keys(spark):
    """Null is a key like others; older rows of the increment lose; the rest is neither sorted nor shuffled."""
    current = spark.createDataFrame([(1, 5, "a"), (2, 5, "b"), (None, 5, "c"), (4, 5, "d")], "k int, at int, v string")
    increment = spark.createDataFrame([(2, 6, "B"), (2, 7, "BB"), (None, 6, "C"), (4, 4, "old"), (9, 1, "new")], current.schema)
    found = upsert(current, increment, ["k"], "at")
    assert counted(found) == {(1, 5, "a"): 1, (2, 7, "BB"): 1, (None, 6, "C"): 1, (4, 5, "d"): 1, (9, 1, "new"): 1}
    assert counted(upsert(None, increment, ["k"], "at")) == counted(latest_by_key(increment, ["k"], "at"))
    assert counted(upsert(current, increment.limit(0), ["k"], "at")) == counted(current)


def test_relationships_keep_every_occurrence(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (None,), (3,)], "k int")
    parent = spark.createDataFrame([(2,), (None,)], "p int")
    assert counted(kernel.relationships(child, "k", parent, "p")) == {(1,): 2, (3,): 1}


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    left=st.lists(st.one_of(st.none(), st.integers(0, 3)), max_size=5),
    listed=st.lists(st.one_of(st.none(), st.integers(0, 3)), max_size=3),
)
def test_not_in_is_that_of_sql(spark, left, listed):
    rows = spark.createDataFrame([(v,) for v in left], "v int")
    members = spark.createDataFrame([(v,) for v in listed], "m int")
    rows.createOrReplaceTempView("l")
    members.createOrReplaceTempView("r")
    expected = spark.sql("SELECT v FROM l WHERE v NOT IN (SELECT m FROM r)")
    assert counted(not_in(rows, "v", members)) == counted(expected)


def test_filters_and_columns_reach_the_scan(spark):
    lines = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    found = values.expect_column_values_to_be_between(
        lines, "l_discount", 0.01, 0.05, row_condition="l_returnflag = 'N'"
    )
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(l_returnflag,N)" in plan
    assert "ReadSchema: struct<l_discount:double,l_returnflag:string>" in plan
    assert "Exchange" not in plan
