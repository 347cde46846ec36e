"""Calendar functions on every order or event, and spines over the days they span."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings.base import add, query
from bindings.relational import DAYS_SQL, FISCAL_DATES_SQL, order_days
from veritally.functions import calendar as cal
from veritally.functions import locale_names
from veritally.operators import date_dimension as dd
from veritally.operators import spine

# --- one function per query --------------------------------------------------------------------

# DuckDB has no localized names; the SQL side names them by a list in calendar order.
LIST = "list_extract([{names}], CAST({number} AS INTEGER))"
DAY = "CAST(o_orderdate AS DATE)"


def listed(number: str, *names: str) -> str:
    return LIST.format(names=", ".join(f"'{n}'" for n in names), number=number)


INT = "CAST({} AS INTEGER)".format
DATE = "CAST({} AS DATE)".format
SUNDAY = f"({DAY} - CAST(dayofweek(o_orderdate) AS INTEGER))"
MONDAY = DATE("date_trunc('week', o_orderdate)")
NL_DAYS = ("maandag", "dinsdag", "woensdag", "donderdag", "vrijdag", "zaterdag", "zondag")
FI_DAYS = ("maanantai", "tiistai", "keskiviikko", "torstai", "perjantai", "lauantai", "sunnuntai")
DE_MONTHS = ("Jan", "Feb", "Mär", "Apr", "Mai", "Jun", "Jul", "Aug", "Sep", "Okt", "Nov", "Dez")
CS_MONTHS = ("led", "úno", "bře", "dub", "kvě", "čer", "čvc", "srp", "zář", "říj", "lis", "pro")
SV_SHORT = ("mån", "tis", "ons", "tor", "fre", "lör", "sön")
PL_MONTHS = ("styczeń", "luty", "marzec", "kwiecień", "maj", "czerwiec", "lipiec", "sierpień",
             "wrzesień", "październik", "listopad", "grudzień")

ON_ORDERS = {
    "day_of_month": (cal.day_of_month, INT("day(o_orderdate)")),
    "day_of_week_iso": (cal.day_of_week, INT("isodow(o_orderdate)")),
    "day_of_week_sunday": (
        lambda d: cal.day_of_week(d, isoweek=False),
        INT("dayofweek(o_orderdate) + 1"),
    ),
    "day_of_year": (cal.day_of_year, INT("dayofyear(o_orderdate)")),
    "day_name_long": (lambda d: cal.day_name(d, short=False), "dayname(o_orderdate)"),
    "day_name_short": (cal.day_name, "substr(dayname(o_orderdate), 1, 3)"),
    "day_name_dutch": (
        lambda d: cal.day_name(d, short=False, language="nl"),
        listed("isodow(o_orderdate)", *NL_DAYS),
    ),
    "day_name_localized": (
        lambda d: cal.day_name_localized(d, short=False, language="fi"),
        listed("isodow(o_orderdate)", *FI_DAYS),
    ),
    "day_name_swedish_short": (
        lambda d: cal.day_name_localized(d, short=True, language="sv"),
        listed("isodow(o_orderdate)", *SV_SHORT),
    ),
    "month_name_long": (lambda d: cal.month_name(d, short=False), "monthname(o_orderdate)"),
    "month_name_short": (cal.month_name, "substr(monthname(o_orderdate), 1, 3)"),
    "month_name_german_short": (
        lambda d: cal.month_name(d, language="de"),
        listed("month(o_orderdate)", *DE_MONTHS),
    ),
    "month_name_localized": (
        lambda d: cal.month_name_localized(d, short=True, language="cs"),
        listed("month(o_orderdate)", *CS_MONTHS),
    ),
    "month_name_polish_long": (
        lambda d: cal.month_name_localized(d, short=False, language="pl"),
        listed("month(o_orderdate)", *PL_MONTHS),
    ),
    "date_part_quarter": (lambda d: cal.date_part("quarter", d), INT("quarter(o_orderdate)")),
    "date_part_week": (
        lambda d: cal.date_part("week", d),
        INT("strftime(o_orderdate, '%U')"),
    ),
    "iso_week_of_year": (cal.iso_week_of_year, INT("weekofyear(o_orderdate)")),
    "iso_week_start": (cal.iso_week_start, MONDAY),
    "iso_week_end": (cal.iso_week_end, f"{MONDAY} + 6"),
    "iso_year_week": (cal.iso_year_week, "strftime(o_orderdate, '%G-W%V')"),
    "week_start": (cal.week_start, SUNDAY),
    "week_end": (cal.week_end, f"{SUNDAY} + 6"),
    "week_of_year": (cal.week_of_year, INT("strftime(o_orderdate, '%U')")),
    "week_of_year_iso": (lambda d: cal.week_of_year(d, "iso"), INT("weekofyear(o_orderdate)")),
    "week_of_year_blocks": (
        lambda d: cal.week_of_year(d, "year_day"),
        INT("ceil(dayofyear(o_orderdate) / 7)"),
    ),
    "n_days_ago": (lambda d: cal.n_days_ago(10, d), f"{DAY} - 10"),
    "n_days_away": (lambda d: cal.n_days_away(10, d), f"{DAY} + 10"),
    "tomorrow": (cal.tomorrow, f"{DAY} + 1"),
    "yesterday": (cal.yesterday, f"{DAY} - 1"),
    "make_date": (
        lambda d: cal.make_date(F.year(d), F.month(d), 1),
        "make_date(year(o_orderdate), month(o_orderdate), 1)",
    ),
    "season_name": (
        lambda d: locale_names.season_text(F.quarter(d), "da"),
        listed("quarter(o_orderdate)", "vinter", "forår", "sommer", "efterår"),
    ),
}

# The present is the time of the event itself; Los Angeles is 8 hours behind UTC in January, so
# some events fall on the day, week, month and year before.
LOCAL = "(ts - INTERVAL 8 HOUR)"
LOCAL_WEEK = f"(CAST({LOCAL} AS DATE) - CAST(dayofweek({LOCAL}) AS INTEGER))"


def _month(n: int) -> str:
    return DATE(f"date_trunc('month', {LOCAL}) + INTERVAL ({n}) MONTH")


AS_OF = {
    "now": (lambda ts: cal.now(as_of=ts), LOCAL),
    "now_amsterdam": (lambda ts: cal.now("Europe/Amsterdam", ts), "ts + INTERVAL 1 HOUR"),
    "today": (lambda ts: cal.today(as_of=ts), DATE(LOCAL)),
    "last_month": (lambda ts: cal.last_month(as_of=ts), _month(-1)),
    "last_month_name": (lambda ts: cal.last_month_name(short=False, as_of=ts), f"monthname({_month(-1)})"),
    "last_month_number": (lambda ts: cal.last_month_number(as_of=ts), INT(f"month({_month(-1)})")),
    "next_month": (lambda ts: cal.next_month(as_of=ts), _month(1)),
    "next_month_name": (lambda ts: cal.next_month_name(as_of=ts), f"substr(monthname({_month(1)}), 1, 3)"),
    "next_month_number": (lambda ts: cal.next_month_number(as_of=ts), INT(f"month({_month(1)})")),
    "n_months_ago": (lambda ts: cal.n_months_ago(14, as_of=ts), _month(-14)),
    "n_months_away": (lambda ts: cal.n_months_away(14, as_of=ts), _month(14)),
    "last_week": (lambda ts: cal.last_week(as_of=ts), f"{LOCAL_WEEK} - 7"),
    "next_week": (lambda ts: cal.next_week(as_of=ts), f"{LOCAL_WEEK} + 7"),
    "n_weeks_ago": (lambda ts: cal.n_weeks_ago(3, as_of=ts), f"{LOCAL_WEEK} - 21"),
    "n_weeks_away": (
        lambda ts: cal.n_weeks_away(3, as_of=ts, week="iso"),
        DATE(f"date_trunc('week', {LOCAL}) + INTERVAL 21 DAY"),
    ),
    "convert_timezone": (cal.convert_timezone, LOCAL),
    "convert_timezone_between": (
        lambda ts: cal.convert_timezone(ts, "Asia/Tokyo", "America/New_York"),
        "ts + INTERVAL 14 HOUR",
    ),
    "round_timestamp": (cal.round_timestamp, "date_trunc('day', ts + INTERVAL 12 HOUR)"),
    "to_unixtimestamp": (cal.to_unixtimestamp, "CAST(floor(epoch(ts)) AS BIGINT)"),
    "from_unixtimestamp": (
        lambda ts: cal.from_unixtimestamp(cal.to_unixtimestamp(ts)),
        "date_trunc('second', ts)",
    ),
    "from_unixtimestamp_millis": (
        lambda ts: cal.from_unixtimestamp(cal.to_unixtimestamp(ts) * 1000 + 7, "milliseconds"),
        "date_trunc('second', ts) + INTERVAL 7 MILLISECOND",
    ),
    "from_unixtimestamp_micros": (
        lambda ts: cal.from_unixtimestamp(cal.to_unixtimestamp(ts) * 1000000 + 7, "microseconds"),
        "date_trunc('second', ts) + INTERVAL 7 MICROSECOND",
    ),
    "make_datetime": (
        lambda ts: cal.in_utc(
            cal.make_datetime(F.year(ts), 1, F.dayofmonth(ts), 6, 14, tz="America/Los_Angeles")
        ),
        "make_timestamp(year(ts), 1, day(ts), 14, 14, 0)",
    ),
    "periods_since_days": (
        lambda ts: cal.periods_since(ts, "day", "UTC", "2024-02-10 01:00:00"),
        "date_diff('day', ts, TIMESTAMP '2024-02-10 01:00:00')",
    ),
    "periods_since_hours": (
        lambda ts: cal.periods_since(ts, "hour", "UTC", "2024-02-10 01:00:00"),
        "date_diff('hour', ts, TIMESTAMP '2024-02-10 01:00:00')",
    ),
    "periods_since_months": (
        lambda ts: cal.periods_since(ts, "month", "UTC", "2026-02-10 01:00:00"),
        "date_diff('month', ts, TIMESTAMP '2026-02-10 01:00:00')",
    ),
    "periods_since_weeks": (
        lambda ts: cal.periods_since(ts, "week", "UTC", "2024-02-10 01:00:00"),
        "date_diff('week', ts + INTERVAL 1 DAY, TIMESTAMP '2024-02-11 01:00:00')",
    ),
}


def _on(table: str, key: str, column: str, function):
    return lambda t: t(table).select(key, function(F.col(column)).alias("result"))


for _name, (_function, _sql) in ON_ORDERS.items():
    add(
        f"calendar_{_name}",
        _on("orders", "o_orderkey", "o_orderdate", _function),
        f"SELECT o_orderkey, {_sql} AS result FROM orders",
    )
for _name, (_function, _sql) in AS_OF.items():
    add(
        f"calendar_{_name}",
        _on("events", "event_id", "ts", _function),
        f"SELECT event_id, {_sql} AS result FROM events",
    )


def _names_on_days(language: str, datepart: str, number):
    def build(t):
        names = locale_names.localized_names(t.spark, language, datepart)
        days = t("orders").select("o_orderkey", number(F.col("o_orderdate")).alias("number"))
        return days.join(names, "number").select("o_orderkey", "long", "short")

    return build


add(
    "calendar_localized_names",
    _names_on_days("tr", "weekdays", lambda d: F.weekday(d) + 1),
    f"""SELECT o_orderkey, {listed("isodow(o_orderdate)", "Pazartesi", "Salı", "Çarşamba", "Perşembe",
        "Cuma", "Cumartesi", "Pazar")} AS long, {listed("isodow(o_orderdate)", "Pzt", "Sal", "Çar", "Per",
        "Cum", "Cmt", "Paz")} AS short FROM orders""",
)

# --- spines ------------------------------------------------------------------------------------


@query(
    f"""SELECT date_day, count(o_orderkey) AS orders FROM ({DAYS_SQL})
        LEFT JOIN orders ON CAST(o_orderdate AS DATE) = date_day GROUP BY 1"""
)
def date_spine(t):
    bounds = t("orders").agg(F.min("o_orderdate").alias("a"), F.max("o_orderdate").alias("b"))
    days = spine.date_spine(t.spark, "day", bounds.select("a").scalar(), bounds.select("b").scalar())
    counts = t("orders").groupBy(F.col("o_orderdate").cast("date").alias("date_day")).agg(
        F.count("o_orderkey").alias("n")
    )
    days = days.select(F.col("date_day").cast("date").alias("date_day"))
    return days.join(counts, "date_day", "left").select("date_day", F.coalesce("n", F.lit(0)).alias("orders"))


@query(
    """SELECT l_orderkey, l_linenumber, l_shipdate, date_diff('day', o_orderdate, l_shipdate) AS days,
       date_diff('month', o_orderdate, l_shipdate) AS months,
       date_diff('quarter', o_orderdate, l_shipdate) AS quarters,
       date_diff('year', o_orderdate, l_shipdate) AS years
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""
)
def intervals_between(t):
    joined = t("lineitem").join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    between = lambda part: cal.periods_between("o_orderdate", "l_shipdate", part).alias(f"{part}s")
    return joined.select(
        "l_orderkey", "l_linenumber", "l_shipdate", *[between(p) for p in ("day", "month", "quarter", "year")]
    )


@query(
    """SELECT n AS generated_number, CAST(count(o_orderkey) AS BIGINT) AS orders
       FROM generate_series(1, (SELECT max(o_orderkey) FROM orders)) s(n)
       LEFT JOIN orders ON o_orderkey = n GROUP BY 1"""
)
def number_series(t):
    last = t("orders").agg(F.max("o_orderkey")).first()[0]
    counts = t("orders").groupBy("o_orderkey").agg(F.count(F.lit(1)).alias("n"))
    numbers = spine.generate_series(t.spark, last)
    joined = numbers.join(counts, F.col("generated_number") == F.col("o_orderkey"), "left")
    return joined.select("generated_number", F.coalesce("n", F.lit(0)).alias("orders"))


HOURS = 24 * 28
WEEKS = 52
AS_OF_TIME = "2024-01-30 20:30:00"


def _events_per(t, periods, part: str):
    name = f"date_{part}"
    counts = t("events").groupBy(cal.date_trunc(part, "ts").alias(name)).agg(F.count(F.lit(1)).alias("n"))
    return periods.join(counts, name, "left").select(name, F.coalesce("n", F.lit(0)).alias("events"))


@query(
    f"""SELECT date_hour, count(event_id) AS events FROM (
            SELECT unnest(range(TIMESTAMP '2024-01-30' - INTERVAL {HOURS} HOUR, TIMESTAMP '2024-01-31',
                                INTERVAL 1 HOUR)) AS date_hour)
        LEFT JOIN events ON date_trunc('hour', ts) = date_hour GROUP BY 1"""
)
def hour_spine(t):
    return _events_per(t, spine.base_dates(t.spark, n_dateparts=HOURS, datepart="hour", as_of=AS_OF_TIME), "hour")


@query(
    f"""SELECT date_week, count(event_id) AS events FROM (
            SELECT unnest(range(TIMESTAMP '2024-01-28' - INTERVAL {7 * WEEKS} DAY, TIMESTAMP '2024-01-28',
                                INTERVAL 7 DAY)) AS date_week)
        LEFT JOIN events ON date_trunc('week', ts + INTERVAL 1 DAY) - INTERVAL 1 DAY = date_week GROUP BY 1"""
)
def week_spine(t):
    # Tomorrow, a Sunday, is where the spine ends and starts a week of its own.
    weeks = spine.base_dates(t.spark, n_dateparts=WEEKS, datepart="week", as_of="2024-01-28 20:00:00")
    return _events_per(t, weeks, "week")


@query(
    f"""SELECT date_day, CAST(4 AS BIGINT) AS groups, CAST(40 AS BIGINT) AS n, CAST(0 AS BIGINT) AS bad_logs
        FROM (SELECT DISTINCT CAST(ts AS DATE) AS date_day FROM events)"""
)
def random_time_series(t):
    days = t("events").select(F.col("ts").cast("date").alias("date_day")).distinct()
    series = spine.random_series(days, groups=4, rows=10, seed=11)
    bad = F.abs(F.exp("row_value_log") - F.col("row_value")) > 1e-9
    return series.groupBy("date_day").agg(
        F.count_distinct("group_id").alias("groups"), F.count(F.lit(1)).alias("n"), F.count_if(bad).alias("bad_logs")
    )


# --- date dimension ------------------------------------------------------------------------------


def _sunday(day: str) -> str:
    return f"({day} - CAST(dayofweek({day}) AS INTEGER))"


def _monday(day: str) -> str:
    return DATE(f"date_trunc('week', {day})")


YOY = "(date_day - 364)"
PRIOR = DATE("date_day - INTERVAL 1 YEAR")
QUARTER = DATE("date_trunc('quarter', date_day)")
YEAR = DATE("date_trunc('year', date_day)")
DIMENSION = {
    "date_day": "date_day",
    "prior_date_day": "date_day - 1",
    "next_date_day": "date_day + 1",
    "prior_year_date_day": PRIOR,
    "prior_year_over_year_date_day": YOY,
    "day_of_week": INT("dayofweek(date_day) + 1"),
    "day_of_week_iso": INT("isodow(date_day)"),
    "day_of_week_name": "dayname(date_day)",
    "day_of_week_name_short": "substr(dayname(date_day), 1, 3)",
    "day_of_month": INT("day(date_day)"),
    "day_of_year": INT("dayofyear(date_day)"),
    "week_start_date": _sunday("date_day"),
    "week_end_date": f"{_sunday('date_day')} + 6",
    "prior_year_week_start_date": _sunday(YOY),
    "prior_year_week_end_date": f"{_sunday(YOY)} + 6",
    "week_of_year": INT("strftime(date_day, '%U')"),
    "iso_week_start_date": _monday("date_day"),
    "iso_week_end_date": f"{_monday('date_day')} + 6",
    "prior_year_iso_week_start_date": _monday(YOY),
    "prior_year_iso_week_end_date": f"{_monday(YOY)} + 6",
    "iso_week_of_year": INT("weekofyear(date_day)"),
    "iso_year_week": "strftime(date_day, '%G-W%V')",
    "prior_year_week_of_year": INT(f"strftime({YOY}, '%U')"),
    "prior_year_iso_week_of_year": INT(f"weekofyear({YOY})"),
    "month_of_year": INT("month(date_day)"),
    "month_name": "monthname(date_day)",
    "month_name_short": "substr(monthname(date_day), 1, 3)",
    "month_start_date": DATE("date_trunc('month', date_day)"),
    "month_end_date": "last_day(date_day)",
    "prior_year_month_start_date": DATE(f"date_trunc('month', {PRIOR})"),
    "prior_year_month_end_date": f"last_day({PRIOR})",
    "quarter_of_year": INT("quarter(date_day)"),
    "quarter_start_date": QUARTER,
    "quarter_end_date": f"last_day({DATE(f'{QUARTER} + INTERVAL 2 MONTH')})",
    "year_number": INT("year(date_day)"),
    "year_start_date": YEAR,
    "year_end_date": f"last_day({DATE(f'{YEAR} + INTERVAL 11 MONTH')})",
}
DIMENSION_SQL = f"SELECT {', '.join(f'{sql} AS {name}' for name, sql in DIMENSION.items())} FROM ({DAYS_SQL})"

WEEK = "fiscal_week_of_year"
PERIOD = f"""CASE WHEN {WEEK} = 53 THEN 3 WHEN ({WEEK} - 1) % 13 <= 3 THEN 1
             WHEN ({WEEK} - 1) % 13 <= 8 THEN 2 ELSE 3 END"""
PERIODS_SQL = f"""
SELECT date_day, fiscal_year_number, week_start_date, week_end_date, {INT(WEEK)} AS {WEEK},
       CAST(dense_rank() OVER (PARTITION BY fiscal_period_number ORDER BY {WEEK}) AS INTEGER)
           AS fiscal_week_of_period,
       fiscal_period_number, fiscal_quarter_number, fiscal_period_of_quarter
FROM (SELECT *, {INT(f"least(({WEEK} - 1) // 13, 3) * 3 + {PERIOD}")} AS fiscal_period_number,
             {INT(f"least(({WEEK} - 1) // 13, 3) + 1")} AS fiscal_quarter_number,
             {INT(PERIOD)} AS fiscal_period_of_quarter FROM ({FISCAL_DATES_SQL}))
"""


@query(DIMENSION_SQL)
def date_dimension(t):
    return order_days(t)


@query(
    f"SELECT * REPLACE ({INT('fiscal_week_of_year')} AS fiscal_week_of_year) FROM ({FISCAL_DATES_SQL})"
)
def fiscal_year_dates(t):
    return dd.fiscal_year_dates(order_days(t), year_end_month=1)


@query(PERIODS_SQL)
def fiscal_periods(t):
    return dd.fiscal_periods(order_days(t), year_end_month=1, week_start_day=1)


@query(
    f"""SELECT d.*, f.fiscal_week_of_year, f.fiscal_week_of_period, f.fiscal_period_number,
        f.fiscal_quarter_number, f.fiscal_period_of_quarter
        FROM ({DIMENSION_SQL}) d LEFT JOIN ({PERIODS_SQL}) f ON d.date_day = f.date_day"""
)
def dim_date(t):
    return dd.dim_date(order_days(t), year_end_month=1)


@query(
    f"""SELECT fiscal_period_number, count(*) AS orders, round(sum(o_totalprice), 2) AS total
        FROM orders JOIN ({PERIODS_SQL}) ON CAST(o_orderdate AS DATE) = date_day GROUP BY 1"""
)
def orders_by_fiscal_period(t):
    periods = dd.fiscal_periods(order_days(t), 1, 1).select("date_day", "fiscal_period_number")
    orders = t("orders").withColumn("date_day", F.col("o_orderdate").cast("date"))
    return orders.join(periods, "date_day").groupBy("fiscal_period_number").agg(
        F.count(F.lit(1)).alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )
