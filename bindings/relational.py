"""Joins, aggregates, windows and set operations on the star-schema and event tables."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from bindings.base import query
from veritally.checks import aggregates, distribution, kernel, values
from veritally.functions import scalar
from veritally.operators.date_dimension import (
    date_dimension,
    fiscal_year_dates,
    fiscal_year_ends,
)
from veritally.operators.latest import latest_by_key
from veritally.operators.membership import not_in
from veritally.operators.ordered import SORT, VALUE, lag_rows, neighbour_violations, running_sum, trailing
from veritally.operators.quantile import percentile_by, percentile_over

# --- joins -----------------------------------------------------------------------------------


@query(
    """SELECT o_orderkey, o_custkey, c_name, c_acctbal FROM orders
       LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) ON o_custkey = c_custkey"""
)
def left_join_using(t):
    solvent = t("customer").filter("c_acctbal > 0").withColumnRenamed("c_custkey", "o_custkey")
    return t("orders").join(solvent, "o_custkey", "left").select("o_orderkey", "o_custkey", "c_name", "c_acctbal")


@query(
    """SELECT f AS value_field FROM (SELECT nullif(l_returnflag, 'R') AS f FROM lineitem)
       WHERE f IS NULL OR f NOT IN ('A')"""
)
def left_anti_join(t):
    flags = t("lineitem").select(F.nullif("l_returnflag", F.lit("R")).alias("value_field"))
    members = values.set_frame(flags.sparkSession, ["A"], True).withColumnRenamed("value_field", "member")
    return flags.join(members, F.col("value_field") == F.col("member"), "left_anti")


@query(
    """SELECT l_returnflag AS value_field FROM lineitem
       JOIN (VALUES ('A'), ('A'), ('X')) s(v) ON l_returnflag = v"""
)
def inner_join_literals(t):
    return values.expect_column_values_to_not_be_in_set(t("lineitem"), "l_returnflag", ["A", "A", "X"])


@query(
    """SELECT coalesce(k, o_orderkey) AS order_key, line_total, o_totalprice
       FROM (SELECT l_orderkey AS k, round(sum(l_extendedprice), 2) AS line_total FROM lineitem GROUP BY 1)
       FULL JOIN orders ON k = o_orderkey"""
)
def full_outer_join(t):
    lines = t("lineitem").groupBy("l_orderkey").agg(F.round(F.sum("l_extendedprice"), 2).alias("line_total"))
    both = lines.join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey"), "full")
    key = F.coalesce("l_orderkey", "o_orderkey").alias("order_key")
    return both.select(key, "line_total", "o_totalprice")


@query(
    """SELECT a AS expression, b AS compare_expression, abs(a - b) AS expression_difference,
       abs(a - b) / CAST(a AS DOUBLE) AS expression_difference_percent
       FROM (SELECT count(*) AS a FROM lineitem), (SELECT count(*) AS b FROM orders) WHERE abs(a - b) > 0"""
)
def compare_single_rows(t):
    return kernel.equal_expression(t("lineitem"), "count(*)", t("orders"))


@query(
    """SELECT column_value, value_field FROM (SELECT DISTINCT o_orderstatus AS column_value FROM orders)
       FULL JOIN (VALUES ('F'), ('O'), ('X')) s(value_field) ON column_value = value_field
       WHERE column_value IS NULL OR value_field IS NULL"""
)
def full_join_literals(t):
    return aggregates.expect_column_distinct_values_to_equal_set(t("orders"), "o_orderstatus", ["F", "O", "X", "X"])


@query(
    """SELECT o_orderkey, o_orderpriority FROM orders
       WHERE o_orderpriority NOT IN (SELECT 'x' || c_mktsegment FROM customer UNION SELECT '5-LOW')"""
)
def not_in_subquery(t):
    segments = t("customer").select(F.concat(F.lit("x"), "c_mktsegment").alias("value_field"))
    listed = segments.unionByName(values.set_frame(segments.sparkSession, ["5-LOW"], True))
    return not_in(t("orders").select("o_orderkey", "o_orderpriority"), "o_orderpriority", listed)


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT CASE WHEN quality = 1 THEN doc_id END FROM labels)")
def not_in_with_nulls(t):
    """A null in the list leaves nothing."""
    good = t("labels").select(F.when(F.col("quality") == 1, F.col("doc_id")).alias("doc_id"))
    return not_in(t("documents").select("doc_id"), "doc_id", good)


def order_days(t):
    """The date dimension over the days of the orders."""
    bounds = t("orders").agg(F.min("o_orderdate").alias("a"), F.max("o_orderdate").alias("b"))
    return date_dimension(t.spark, bounds.select("a").scalar(), bounds.select("b").scalar())


DAYS_SQL = """
SELECT CAST(unnest(range(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS DATE) AS date_day FROM orders
"""
FISCAL_ENDS_SQL = f"""
SELECT * FROM (
    SELECT fy AS fiscal_year_number, lag(we) OVER (ORDER BY we) + 1 AS fiscal_year_start_date,
           we AS fiscal_year_end_date FROM (
        SELECT CAST(year(date_day) - 1 AS INTEGER) AS fy, date_day + 6 AS we FROM ({DAYS_SQL})
        WHERE month(date_day) = 1 AND dayofweek(date_day) = 0
        QUALIFY rank() OVER (PARTITION BY year(date_day)
                             ORDER BY abs(date_diff('day', date_day + 6, last_day(date_day)))) = 1))
"""
FISCAL_DATES_SQL = f"""
SELECT date_day, fiscal_year_number, fiscal_year_start_date, fiscal_year_end_date, week_start_date,
       week_start_date + 6 AS week_end_date,
       dense_rank() OVER (PARTITION BY fiscal_year_number ORDER BY week_start_date) AS fiscal_week_of_year
FROM ({DAYS_SQL}) JOIN ({FISCAL_ENDS_SQL})
  ON date_day BETWEEN fiscal_year_start_date AND fiscal_year_end_date
JOIN (SELECT date_day AS week_start_date FROM ({DAYS_SQL}) WHERE dayofweek(date_day) = 0)
  ON date_day BETWEEN week_start_date AND week_start_date + 6
"""


@query(
    f"""SELECT o_orderkey, fiscal_year_number, CAST(fiscal_week_of_year AS INTEGER) AS fiscal_week_of_year
        FROM orders JOIN ({FISCAL_DATES_SQL}) ON CAST(o_orderdate AS DATE) = date_day"""
)
def range_join_fiscal_weeks(t):
    weeks = fiscal_year_dates(order_days(t), year_end_month=1)
    orders = t("orders").withColumn("date_day", F.col("o_orderdate").cast("date"))
    return orders.join(weeks, "date_day").select("o_orderkey", "fiscal_year_number", "fiscal_week_of_year")


@query(
    """SELECT date_hour, true AS is_missing, CAST(0 AS BIGINT) AS row_cnt FROM (
           SELECT unnest(range(CAST(CAST(min(ts) AS DATE) AS TIMESTAMP),
                               CAST(CAST(max(ts) AS DATE) AS TIMESTAMP), INTERVAL 1 HOUR)) AS date_hour
           FROM events WHERE event_type = 'purchase')
       WHERE date_hour NOT IN (SELECT date_trunc('hour', ts) FROM events WHERE event_type = 'purchase')"""
)
def spine_left_join(t):
    return distribution.expect_row_values_to_have_data_for_every_n_datepart(
        t("events"), "ts", "hour", row_condition="event_type = 'purchase'"
    )


@query(
    f"""SELECT fiscal_year_number, month_end_date, week_end_date FROM (
            SELECT DISTINCT CAST(year(date_day) - 1 AS INTEGER) AS fiscal_year_number,
                   last_day(date_day) AS month_end_date FROM ({DAYS_SQL}) WHERE month(date_day) = 1)
        JOIN (SELECT CAST(year(date_day) - 1 AS INTEGER) AS y, date_day + 6 AS week_end_date
              FROM ({DAYS_SQL}) WHERE month(date_day) = 1 AND dayofweek(date_day) = 0)
          ON y = fiscal_year_number"""
)
def month_end_week_end_join(t):
    january = order_days(t).filter("month_of_year = 1")
    year = (F.col("year_number") - 1).alias("fiscal_year_number")
    months = january.select(year, "month_end_date").distinct()
    weeks = january.filter("day_of_week = 1").select(year, F.date_add("date_day", 6).alias("week_end_date"))
    return months.join(weeks, "fiscal_year_number")


# --- aggregates ------------------------------------------------------------------------------


@query(
    """SELECT l_returnflag AS col_1, l_linestatus AS col_2, round(sum(l_extendedprice * (1 - l_discount)), 2)
       AS expression FROM lineitem WHERE l_quantity > 10 GROUP BY 1, 2"""
)
def aggregate_by_columns(t):
    return kernel.aggregate_by(
        t("lineitem"),
        "round(sum(l_extendedprice * (1 - l_discount)), 2)",
        ["l_returnflag", "l_linestatus"],
        "l_quantity > 10",
    )


@query(
    """SELECT event_type AS col_1, CAST(ts AS DATE) AS col_2, count(*) AS expression FROM events GROUP BY 1, 2"""
)
def group_by_leading_columns(t):
    return kernel.aggregate_by(t("events"), "count(*)", ["event_type", "cast(ts as date)"])


@query("SELECT l_returnflag, count(DISTINCT l_partkey) AS parts FROM lineitem GROUP BY 1")
def count_distinct(t):
    return t("lineitem").groupBy("l_returnflag").agg(F.count_distinct("l_partkey").alias("parts"))


@query("SELECT l_returnflag, median(l_quantity) AS percentile FROM lineitem GROUP BY 1")
def median_by_group(t):
    return percentile_by(t("lineitem"), "l_quantity", 0.5, ["l_returnflag"], whole_groups=True)


@query(
    """SELECT l_returnflag, l_linestatus, quantile_cont(l_extendedprice, 0.9) AS percentile
       FROM lineitem GROUP BY 1, 2"""
)
def percentile_by_group(t):
    return percentile_by(t("lineitem"), "l_extendedprice", 0.9, ["l_returnflag", "l_linestatus"], whole_groups=True)


@query(
    """SELECT l_returnflag, l_linestatus, quantile_cont(l_extendedprice, 0.37) AS percentile
       FROM lineitem GROUP BY 1, 2"""
)
def percentile_in_ranges(t):
    """The default way, in which no group has to fit in one task."""
    return percentile_by(
        t("lineitem"), "l_extendedprice", 0.37, ["l_returnflag", "l_linestatus"]
    )


@query(
    """SELECT l_orderkey, l_linenumber, l_quantity, q FROM lineitem
       JOIN (SELECT l_linenumber AS n, quantile_cont(l_quantity, 0.25) AS q FROM lineitem GROUP BY 1)
         ON n = l_linenumber"""
)
def percentile_per_partition(t):
    lines = t("lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return percentile_over(lines, "l_quantity", 0.25, ["l_linenumber"], alias="q")


@query("SELECT l_orderkey, round(stddev_samp(l_quantity), 6) AS deviation FROM lineitem GROUP BY 1")
def sample_stddev(t):
    return t("lineitem").groupBy("l_orderkey").agg(F.round(F.stddev_samp("l_quantity"), 6).alias("deviation"))


@query(
    """SELECT l_orderkey, l_linenumber, count(*) AS n_records FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1"""
)
def duplicate_keys(t):
    counted = t("lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("n_records"))
    return counted.filter("n_records > 1")


@query(
    """SELECT l_returnflag, l_linestatus, min(l_quantity) AS low, max(l_quantity) AS high,
       round(sum(l_extendedprice), 2) AS total, round(avg(l_discount), 8) AS mean, count(*) AS n,
       count(*) FILTER (WHERE l_tax = 0) AS untaxed FROM lineitem GROUP BY 1, 2"""
)
def basic_aggregates(t):
    return t("lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.min("l_quantity").alias("low"),
        F.max("l_quantity").alias("high"),
        F.round(F.sum("l_extendedprice"), 2).alias("total"),
        F.round(F.avg("l_discount"), 8).alias("mean"),
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("l_tax") == 0).alias("untaxed"),
    )


# --- windows ---------------------------------------------------------------------------------


@query(
    """SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM orders
       QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1"""
)
def latest_row_per_key(t):
    orders = t("orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    return latest_by_key(orders, ["o_custkey"], "o_orderdate", ["o_orderkey"])


LAG_SQL = """
SELECT * FROM (SELECT ts AS sort_column, user_id, value AS value_field,
       lag(value) OVER (PARTITION BY user_id ORDER BY ts, value) AS value_field_lag FROM events)
WHERE value_field_lag > 2 * value_field
"""


def _halved(t, whole_groups):
    rows = t("events").select(F.col("ts").alias(SORT), "user_id", F.col("value").alias(VALUE))
    halved = lambda value, previous: F.coalesce(previous > value * 2, F.lit(False))
    return neighbour_violations(rows, halved, ["user_id"], whole_groups=whole_groups)


@query(LAG_SQL)
def lag_in_groups(t):
    return _halved(t, True)


@query(LAG_SQL)
def lag_in_ranges(t):
    """The default way, in which no group has to fit in one task."""
    return _halved(t, False)


DAILY_SQL = "SELECT event_type, CAST(ts AS DATE) AS d, sum(value) AS v FROM events GROUP BY 1, 2"


def _daily(t):
    return t("events").groupBy("event_type", F.col("ts").cast("date").alias("d")).agg(F.sum("value").alias("v"))


@query(
    f"""SELECT event_type, d, round(v, 4) AS v,
        round(v - lag(v, 7) OVER (PARTITION BY event_type ORDER BY d), 4) AS change FROM ({DAILY_SQL})"""
)
def lag_by_periods(t):
    before = F.lag("v", 7).over(W.partitionBy("event_type").orderBy("d"))
    return _daily(t).select("event_type", "d", F.round("v", 4).alias("v"), F.round(F.col("v") - before, 4).alias("change"))


@query(
    f"""SELECT event_type, d, round(avg(v) OVER w, 4) AS mean, round(stddev_samp(v) OVER w, 4) AS deviation
        FROM ({DAILY_SQL})
        WINDOW w AS (PARTITION BY event_type ORDER BY d ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)"""
)
def trailing_frame(t):
    before = W.partitionBy("event_type").orderBy("d").rowsBetween(-7, -1)
    return _daily(t).select(
        "event_type",
        "d",
        F.round(F.avg("v").over(before), 4).alias("mean"),
        F.round(F.stddev_samp("v").over(before), 4).alias("deviation"),
    )


@query(
    """SELECT event_id, value, lag(value, 5) OVER (ORDER BY ts, event_id) AS fifth_before FROM events"""
)
def lag_on_raw_events(t):
    """The whole table is one group, in ranges that see the last rows of the ranges before."""
    events = t("events").select("event_id", "ts", "value")
    return lag_rows(events, "value", ["ts", "event_id"], 5, alias="fifth_before").drop("ts")


@query(
    """SELECT event_id, event_type, round(sum(value) OVER w, 2) AS total, round(stddev_samp(value) OVER w, 4) AS deviation,
       count(*) OVER w AS n FROM events
       WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING)"""
)
def trailing_on_raw_events(t):
    events = t("events").select("event_id", "event_type", "ts", "value")
    made = {"total": F.sum("value"), "deviation": F.stddev_samp("value"), "n": F.count(F.lit(1))}
    found = trailing(events, made, ["ts", "event_id"], 20, ["event_type"]).drop("ts", "value")
    return found.withColumns({"total": F.round("total", 2), "deviation": F.round("deviation", 4)})


@query(
    """SELECT l_suppkey, round(v, 2) AS v, round(avg(v) OVER (), 2) AS mean, round(stddev_samp(v) OVER (), 2)
       AS deviation FROM (SELECT l_suppkey, sum(l_extendedprice) AS v FROM lineitem GROUP BY 1)"""
)
def global_statistics(t):
    sums = t("lineitem").groupBy("l_suppkey").agg(F.sum("l_extendedprice").alias("v"))
    stats = sums.agg(F.struct(F.avg("v").alias("a"), F.stddev_samp("v").alias("s")).alias("x")).scalar()
    return sums.withColumn("x", stats).select(
        "l_suppkey",
        F.round("v", 2).alias("v"),
        F.round("x.a", 2).alias("mean"),
        F.round("x.s", 2).alias("deviation"),
    )


@query(
    """SELECT o_orderpriority AS value_field FROM orders GROUP BY 1
       QUALIFY row_number() OVER (ORDER BY count(*) DESC, o_orderpriority) = 2"""
)
def ranked_frequency(t):
    return aggregates.ranked_value(t("orders").select(F.col("o_orderpriority").alias("value_field")), 2)


@query(FISCAL_ENDS_SQL)
def fiscal_year_bounds(t):
    return fiscal_year_ends(order_days(t), year_end_month=1)


@query(
    f"""SELECT fiscal_year_number, fiscal_year_start_date FROM ({FISCAL_ENDS_SQL})
        WHERE fiscal_year_start_date IS NOT NULL"""
)
def lag_plus_a_day(t):
    years = fiscal_year_ends(order_days(t), year_end_month=1)
    return years.select("fiscal_year_number", "fiscal_year_start_date").filter("fiscal_year_start_date is not null")


@query(
    """SELECT user_id, ts, CAST(dense_rank() OVER (PARTITION BY user_id ORDER BY CAST(ts AS DATE)) AS INTEGER)
       AS day_rank FROM events"""
)
def dense_rank_days(t):
    # Ranks of the distinct days, joined back: no group's rows have to meet in one task.
    events = t("events").select("user_id", "ts", F.col("ts").cast("date").alias("d"))
    by_day = W.partitionBy("user_id").orderBy("d")
    ranks = events.select("user_id", "d").distinct().withColumn("day_rank", F.row_number().over(by_day))
    return events.join(ranks, ["user_id", "d"]).select("user_id", "ts", "day_rank")


@query(
    """SELECT o_orderkey, len(list_distinct([md5(CAST(o_orderkey AS VARCHAR)), md5(CAST(o_custkey AS VARCHAR)),
       md5(o_orderstatus)])) AS distinct_values FROM orders"""
)
def distinct_values_in_row(t):
    hashes = F.array(*[scalar.md5_text(c) for c in ("o_orderkey", "o_custkey", "o_orderstatus")])
    return t("orders").select(
        "o_orderkey", F.size(F.array_distinct(hashes)).cast("bigint").alias("distinct_values")
    )


RUNNING_SQL = """
SELECT user_id, d, round(sum(value) OVER (PARTITION BY user_id ORDER BY d), 4) AS rising,
       round(sum(value) OVER (PARTITION BY user_id ORDER BY d DESC), 4) AS falling
FROM (SELECT user_id, CAST(ts AS DATE) AS d, value FROM events)
"""


def _running(t, whole_groups):
    # Events of one day share their sum.
    rows = t("events").select("user_id", F.col("ts").cast("date").alias("d"), "value")
    for alias, falls in (("rising", False), ("falling", True)):
        rows = running_sum(rows, "value", "d", ["user_id"], alias, falls, whole_groups)
    return rows.select("user_id", "d", *[F.round(c, 4).alias(c) for c in ("rising", "falling")])


@query(RUNNING_SQL)
def running_sums(t):
    return _running(t, True)


@query(RUNNING_SQL)
def running_sums_in_ranges(t):
    """The default way, in which no group has to fit in one task."""
    return _running(t, False)


# --- sets ------------------------------------------------------------------------------------


@query(
    """SELECT value_field, count(o_orderkey) AS orders FROM (VALUES ('F'), ('O'), ('O'), ('X')) s(value_field)
       LEFT JOIN orders ON o_orderstatus = value_field GROUP BY 1"""
)
def literal_rows(t):
    orders = t("orders").groupBy("o_orderstatus").agg(F.count("o_orderkey").alias("n"))
    members = values.set_frame(orders.sparkSession, ["F", "O", "O", "X"], True)
    joined = members.join(orders, F.col("value_field") == F.col("o_orderstatus"), "left")
    return joined.groupBy("value_field").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("orders"))


@query(
    """SELECT o_orderkey, 'o_custkey' AS column_name, CAST(o_custkey AS VARCHAR) AS column_value FROM orders
       UNION ALL SELECT o_orderkey, 'o_orderstatus', o_orderstatus FROM orders
       UNION ALL SELECT o_orderkey, 'o_orderpriority', o_orderpriority FROM orders"""
)
def unpivot_columns(t):
    orders = t("orders").withColumn("o_custkey", F.col("o_custkey").cast("string"))
    names = ["o_custkey", "o_orderstatus", "o_orderpriority"]
    return orders.unpivot("o_orderkey", names, "column_name", "column_value")


@query("SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders")
def distinct_rows(t):
    return t("orders").select("o_orderstatus", "o_orderpriority").distinct()


# --- scalar functions ------------------------------------------------------------------------


@query("SELECT event_id, round(ln(nullif(value, 0)), 9) AS log_value FROM events")
def log_natural(t):
    return t("events").select("event_id", F.round(scalar.log_natural(F.nullif("value", F.lit(0.0))), 9).alias("log_value"))


@query(
    """SELECT event_id, round(coalesce(CASE WHEN value > 50 THEN ln(value - 50) END, 0), 9) AS logged,
       value - 50 AS plain FROM events"""
)
def metric_values(t):
    events = t("events").withColumn("v", F.col("value") - 50)
    return events.select(
        "event_id",
        F.round(scalar.metric_value("v", True), 9).alias("logged"),
        scalar.metric_value("v", False).alias("plain"),
    )


@query("SELECT count(*) AS n, 0 AS outside, true AS spread FROM lineitem")
def random_numbers(t):
    drawn = t("lineitem").select(scalar.rand(7).alias("r"))
    spread = (F.min("r") < 0.05) & (F.max("r") > 0.95) & (F.abs(F.avg("r") - 0.5) < 0.05)
    return drawn.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(~F.col("r").between(0, 1) | (F.col("r") == 1)).cast("int").alias("outside"),
        spread.alias("spread"),
    )


@query("SELECT c_custkey, md5(c_name) AS name_hash, md5(CAST(c_custkey AS VARCHAR)) AS key_hash FROM customer")
def md5_hashes(t):
    return t("customer").select(
        "c_custkey", scalar.md5_text("c_name").alias("name_hash"), scalar.md5_text("c_custkey").alias("key_hash")
    )


@query(
    """SELECT l_orderkey, l_linenumber, nullif(l_tax, 0) AS tax, abs(l_discount - 0.05) AS gap,
       CAST(mod(l_partkey, 13) AS BIGINT) AS part_mod, CAST(least(floor(l_quantity / 13.0), 3) AS INTEGER) AS quarter,
       lpad(CAST(l_linenumber AS VARCHAR), 2, '0') AS padded, lower(l_returnflag) || '-W' AS label,
       CASE WHEN l_quantity BETWEEN 0 AND 13 THEN 1 WHEN l_quantity <= 30 THEN 2 ELSE 3 END AS band FROM lineitem"""
)
def scalar_expressions(t):
    quantity = F.col("l_quantity")
    return t("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.nullif("l_tax", F.lit(0.0)).alias("tax"),
        F.abs(F.col("l_discount") - 0.05).alias("gap"),
        F.pmod("l_partkey", F.lit(13)).alias("part_mod"),
        F.least(F.floor(quantity / 13), F.lit(3)).cast("int").alias("quarter"),
        F.lpad(F.col("l_linenumber").cast("string"), 2, "0").alias("padded"),
        F.concat(F.lower("l_returnflag"), F.lit("-W")).alias("label"),
        F.when(quantity.between(0, 13), 1).when(quantity <= 30, 2).otherwise(3).alias("band"),
    )


@query(
    """SELECT doc_id, CAST(CASE WHEN regexp_matches(text, '[0-9]') THEN
       length(regexp_extract(text, '(?s)^([^0-9]*)[0-9]', 1)) + 1 ELSE 0 END AS INTEGER) AS first_digit,
       CAST(CASE WHEN regexp_matches(text, '(?s)[0-9].*[0-9]') THEN
       length(regexp_extract(text, '(?s)^([^0-9]*[0-9][^0-9]*)[0-9]', 1)) + 1 ELSE 0 END AS INTEGER) AS second_digit
       FROM documents"""
)
def regexp_positions(t):
    return t("documents").select(
        "doc_id",
        scalar.regexp_instr("text", "[0-9]").alias("first_digit"),
        scalar.regexp_instr("text", "[0-9]", occurrence=2).alias("second_digit"),
    )
