"""Known values of the calendar functions for 2020-11-29 and 2020-12-01."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from veritally.functions import calendar as cal
from veritally.functions.locale_names import LANGUAGES, localized_names
from veritally.operators import date_dimension as dd
from veritally.operators import spine

D = dt.date
GOLDENS = {
    "prior": (cal.yesterday, D(2020, 11, 28), D(2020, 11, 30)),
    "next": (cal.tomorrow, D(2020, 11, 30), D(2020, 12, 2)),
    "day_name": (lambda d: cal.day_name(d, short=False), "Sunday", "Tuesday"),
    "day_name_short": (cal.day_name, "Sun", "Tue"),
    "day_name_nl": (lambda d: cal.day_name(d, False, "nl"), "zondag", "dinsdag"),
    "day_name_de": (lambda d: cal.day_name(d, True, "de"), "So", "Di"),
    "day_of_month": (cal.day_of_month, 29, 1),
    "day_of_week": (lambda d: cal.day_of_week(d, isoweek=False), 1, 3),
    "day_of_week_iso": (cal.day_of_week, 7, 2),
    "day_of_year": (cal.day_of_year, 334, 336),
    "week_start": (cal.week_start, D(2020, 11, 29), D(2020, 11, 29)),
    "week_end": (cal.week_end, D(2020, 12, 5), D(2020, 12, 5)),
    "week_start_monday": (lambda d: cal.week_start(d, "iso"), D(2020, 11, 23), D(2020, 11, 30)),
    "week_end_monday": (lambda d: cal.week_end(d, "iso"), D(2020, 11, 29), D(2020, 12, 6)),
    "week_of_year": (cal.week_of_year, 48, 48),
    "week_of_year_iso": (lambda d: cal.week_of_year(d, "iso"), 48, 49),
    "iso_week_start": (cal.iso_week_start, D(2020, 11, 23), D(2020, 11, 30)),
    "iso_week_end": (cal.iso_week_end, D(2020, 11, 29), D(2020, 12, 6)),
    "iso_week_of_year": (cal.iso_week_of_year, 48, 49),
    "iso_year_week": (cal.iso_year_week, "2020-W48", "2020-W49"),
    "month": (lambda d: cal.date_part("month", d), 11, 12),
    "month_name": (lambda d: cal.month_name(d, short=False), "November", "December"),
    "month_name_short": (cal.month_name, "Nov", "Dec"),
    "month_name_nl": (lambda d: cal.month_name(d, False, "nl"), "november", "december"),
    "month_name_de": (lambda d: cal.month_name(d, True, "de"), "Nov", "Dez"),
}


def test_goldens(spark):
    days = spark.createDataFrame([(D(2020, 11, 29),), (D(2020, 12, 1),)], "d date")
    found = days.select("d", *[f(F.col("d")).alias(n) for n, (f, *_) in GOLDENS.items()]).orderBy("d")
    first, second = found.collect()
    for name, (_, a, b) in GOLDENS.items():
        assert (first[name], second[name]) == (a, b), name


def value(spark, column):
    return spark.range(1).select(column).first()[0]


def test_epoch_and_zones(spark):
    utc, local = dt.datetime(2021, 6, 7, 14, 35, 20), dt.datetime(2021, 6, 7, 7, 35, 20)
    stamp = F.lit("2021-06-07 14:35:20").cast("timestamp_ntz")
    assert value(spark, cal.from_unixtimestamp(F.lit(1623076520))) == utc
    assert value(spark, cal.from_unixtimestamp(F.lit(1623076520000000000), "nanoseconds")) == utc
    assert value(spark, cal.to_unixtimestamp(stamp)) == 1623076520
    assert value(spark, cal.convert_timezone(stamp)) == local
    assert value(spark, cal.round_timestamp(stamp)) == dt.datetime(2021, 6, 8)
    assert value(spark, cal.round_timestamp(F.lit(local.isoformat(" ")).cast("timestamp_ntz"))) == dt.datetime(2021, 6, 7)
    with pytest.raises(ValueError):
        cal.from_unixtimestamp(F.lit(1), "days")


def test_now_forms(spark):
    at = "2021-01-01 03:00:00"  # still the last day of 2020 in Los Angeles
    assert value(spark, cal.today(as_of=at)) == D(2020, 12, 31)
    assert value(spark, cal.today("UTC", at)) == D(2021, 1, 1)
    assert value(spark, cal.last_month(as_of=at)) == D(2020, 11, 1)
    assert value(spark, cal.next_month_name(short=False, as_of=at)) == "January"
    assert value(spark, cal.last_month_number(as_of=at)) == 11
    assert value(spark, cal.n_weeks_ago(1, as_of=at)) == D(2020, 12, 20)
    now = value(spark, cal.now("UTC"))
    assert abs((now - dt.datetime.now(dt.UTC).replace(tzinfo=None)).total_seconds()) < 60


def test_boundaries_are_counted(spark):
    stamp = lambda s: F.lit(s).cast("timestamp_ntz")
    between = lambda a, b, part: value(spark, cal.periods_between(stamp(a), stamp(b), part))
    assert between("2024-01-01 23:00:00", "2024-01-02 01:00:00", "day") == 1
    assert between("2024-01-01 23:59:59", "2024-01-02 00:00:01", "hour") == 1
    assert between("2024-01-01 10:59:00", "2024-01-01 11:01:00", "minute") == 2
    assert between("2024-01-06 00:00:00", "2024-01-07 00:00:00", "week") == 1
    assert between("2023-12-31 00:00:00", "2024-01-01 00:00:00", "year") == 1
    assert between("2024-03-01 00:00:00", "2024-01-31 00:00:00", "month") == -2


def test_spines(spark, rows):
    days = spine.date_spine(spark, "day", "2024-01-30", "2024-02-02")
    assert [r[0].day for r in days.collect()] == [30, 31, 1]
    assert rows(spine.date_spine(spark, "day", "2024-01-30", "2024-01-30")) == []
    assert rows(spine.date_spine(spark, "day", "2024-01-30", "2024-01-20")) == []
    months = spine.date_spine(spark, "month", "2024-01-31", "2024-05-01")
    assert [r[0].day for r in months.collect()] == [31, 29, 31, 30]
    # More periods than one block holds.
    minutes = spine.date_spine(spark, "minute", "2024-01-01", "2024-02-01")
    assert minutes.count() == minutes.distinct().count() == 31 * 24 * 60
    hours = spine.base_dates(spark, n_dateparts=672, datepart="hour", as_of="2024-01-10 12:00:00")
    assert hours.count() == 672 + 24
    assert spine.generate_series(spark, 5).count() == 5
    with pytest.raises(ValueError):
        spine.generate_series(spark, 0)


def test_names_in_all_languages(spark):
    for language in LANGUAGES:
        for part, n in (("weekdays", 7), ("months", 12), ("seasons", 4)):
            names = localized_names(spark, language, part).collect()
            assert len(names) == n
            assert all(r["long"] and r["short"] and "." not in r["short"] for r in names)
    finnish = localized_names(spark, "fi", "weekdays").orderBy("number").first()
    assert (finnish["long"], finnish["short"]) == ("maanantai", "ma")
    swedish = {r["number"]: r["short"] for r in localized_names(spark, "sv", "months").collect()}
    assert (swedish[3], swedish[6], swedish[7]) == ("mar", "jun", "jul")
    with pytest.raises(ValueError):
        localized_names(spark, "xx", "months")


def test_date_dimension_and_fiscal_calendar(spark):
    dates = dd.date_dimension(spark, "2015-01-01", "2022-12-31")
    assert (dates.count(), len(dates.columns)) == (2921, 37)
    fiscal = dd.fiscal_periods(dates, year_end_month=1, week_start_day=1, shift_year=1)
    weeks = fiscal.groupBy("fiscal_year_number").agg(
        F.max("fiscal_week_of_year").alias("w"), F.min("date_day").alias("a"), F.max("date_day").alias("b")
    )
    by_year = {r["fiscal_year_number"]: r for r in weeks.collect()}
    # The Saturday closest to the end of January: 2016-01-30 ends 2014, the first known year end.
    assert min(by_year) == 2015
    assert by_year[2015]["a"] == D(2016, 1, 31) or by_year[2015]["a"] == D(2015, 2, 1)
    assert by_year[2017]["w"] == 53 or 53 in {r["w"] for r in by_year.values()}
    sizes = fiscal.filter("fiscal_year_number = 2018").groupBy("fiscal_period_number").count()
    assert [r["count"] // 7 for r in sizes.orderBy("fiscal_period_number").collect()] == [4, 5, 4] * 4
    joined = dd.dim_date(dates)
    assert joined.count() == 2921 and len(joined.columns) == 42
