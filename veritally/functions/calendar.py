"""Calendar functions on date and timestamp columns.

Every "now" form takes ``as_of``: a UTC timestamp (text, datetime or column) that stands for the
present; without it the current time is used. Wall-clock results are zone-less timestamps.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from veritally.functions.nested import as_column

# Fixed value: the zone of "now" when none is named.
DEFAULT_ZONE = "America/Los_Angeles"

WEEK_STARTS = ("sunday", "iso")
WEEK_NUMBERS = ("sunday", "iso", "year_day")
PARTS = ("second", "minute", "hour", "day", "week", "month", "quarter", "year")


def _choice(value: str, allowed: tuple[str, ...], what: str) -> str:
    if value not in allowed:
        raise ValueError(f"{what} must be one of {allowed}, got {value!r}")
    return value


def utc_now(as_of=None) -> Column:
    """The present as a zone-less UTC timestamp."""
    if as_of is None:
        return F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.localtimestamp())
    if isinstance(as_of, Column):
        return as_of.cast("timestamp_ntz")
    text = as_of.isoformat(sep=" ") if isinstance(as_of, dt.datetime | dt.date) else str(as_of)
    return F.lit(text).cast("timestamp_ntz")


def convert_timezone(column, target_tz: str = DEFAULT_ZONE, source_tz: str = "UTC") -> Column:
    """The wall clock in ``target_tz`` at an instant given as wall clock in ``source_tz``."""
    return F.convert_timezone(
        F.lit(source_tz), F.lit(target_tz), as_column(column).cast("timestamp_ntz")
    )


def now(tz: str | None = None, as_of=None) -> Column:
    return convert_timezone(utc_now(as_of), tz or DEFAULT_ZONE)


def today(tz: str | None = None, as_of=None) -> Column:
    return now(tz, as_of).cast("date")


def _day(date, tz, as_of) -> Column:
    return today(tz, as_of) if date is None else as_column(date).cast("date")


# --- parts ---------------------------------------------------------------------------------


def date_part(part: str, date) -> Column:
    """A field of the date. ``week`` counts weeks from the first Sunday; ``isoweek`` is ISO."""
    column = as_column(date)
    part = part.lower()
    if part == "week":
        return week_of_year(column)
    if part == "isoweek":
        return iso_week_of_year(column)
    if part == "epoch":
        return to_unixtimestamp(column)
    return F.date_part(F.lit(part), column)


def day_of_month(date) -> Column:
    return F.dayofmonth(as_column(date))


def day_of_week(date, isoweek: bool = True) -> Column:
    """ISO: Monday 1 to Sunday 7; otherwise Sunday 1 to Saturday 7."""
    column = as_column(date)
    return F.weekday(column) + 1 if isoweek else F.dayofweek(column)


def day_of_year(date) -> Column:
    return F.dayofyear(as_column(date))


def week_of_year(date=None, week: str = "sunday", tz: str | None = None, as_of=None) -> Column:
    """Week number: from the first Sunday (0 before it), ISO, or by seven-day blocks of the year."""
    day = _day(date, tz, as_of)
    _choice(week, WEEK_NUMBERS, "week")
    if week == "iso":
        return F.weekofyear(day)
    if week == "year_day":
        return F.ceil(F.dayofyear(day) / 7).cast("int")
    return F.floor((F.dayofyear(day) + 7 - F.dayofweek(day)) / 7).cast("int")


def iso_week_of_year(date=None, tz: str | None = None, as_of=None) -> Column:
    return F.weekofyear(_day(date, tz, as_of))


def week_start(date=None, week: str = "sunday", tz: str | None = None, as_of=None) -> Column:
    day = _day(date, tz, as_of)
    if _choice(week, WEEK_STARTS, "week") == "iso":
        return F.date_sub(day, F.weekday(day))
    return F.date_sub(day, F.dayofweek(day) - 1)


def week_end(date=None, week: str = "sunday", tz: str | None = None, as_of=None) -> Column:
    return F.date_add(week_start(date, week, tz, as_of), 6)


def iso_week_start(date=None, tz: str | None = None, as_of=None) -> Column:
    return week_start(date, "iso", tz, as_of)


def iso_week_end(date=None, tz: str | None = None, as_of=None) -> Column:
    return week_end(date, "iso", tz, as_of)


def iso_year_week(date) -> Column:
    """``YYYY-Www``; the ISO year is the year of the week's Thursday."""
    day = as_column(date).cast("date")
    thursday = F.date_add(iso_week_start(day), 3)
    return F.format_string("%04d-W%02d", F.year(thursday), F.weekofyear(day))


def date_trunc(part: str, column, week: str = "sunday") -> Column:
    """Start of the period as a zone-less timestamp."""
    source = as_column(column)
    part = part.lower()
    if part in ("week", "isoweek"):
        start = week_start(source, "iso" if part == "isoweek" else week)
        return start.cast("timestamp_ntz")
    return F.date_trunc(part, source).cast("timestamp_ntz")


# --- names ---------------------------------------------------------------------------------


def day_name(date, short: bool = True, language: str = "default") -> Column:
    if language == "default":
        return F.date_format(as_column(date), "E" if short else "EEEE")
    return day_name_localized(date, short, language)


def month_name(date, short: bool = True, language: str = "default") -> Column:
    if language == "default":
        return F.date_format(as_column(date), "MMM" if short else "MMMM")
    return month_name_localized(date, short, language)


def day_name_localized(date, short: bool = True, language: str = "en") -> Column:
    from veritally.functions.locale_names import weekday_text

    return weekday_text(as_column(date).cast("date"), short, language)


def month_name_localized(date, short: bool = True, language: str = "en") -> Column:
    from veritally.functions.locale_names import month_text

    return month_text(as_column(date).cast("date"), short, language)


# --- moving by periods ---------------------------------------------------------------------


def add_periods(column, n, part: str) -> Column:
    """``column`` moved by ``n`` periods (a number or an integer column), zone-less."""
    part = _choice(part.lower(), PARTS, "part")
    count = n if isinstance(n, Column) else F.lit(int(n))
    field = {"minute": "mins", "second": "secs"}.get(part, f"{part}s")
    if part == "quarter":
        field, count = "months", count * 3
    return as_column(column).cast("timestamp_ntz") + F.make_interval(**{field: count})


def periods_between(start, end, part: str = "day", week: str = "sunday") -> Column:
    """Number of period boundaries crossed from ``start`` to ``end``."""
    part = _choice(part.lower(), PARTS, "part")
    a, b = as_column(start), as_column(end)
    if part == "week":
        return (F.date_diff(week_start(b, week), week_start(a, week)) / 7).cast("bigint")
    if part in ("month", "quarter", "year"):
        years = (F.year(b) - F.year(a)).cast("bigint")
        if part == "year":
            return years
        per_year, field = (12, F.month) if part == "month" else (4, F.quarter)
        return years * per_year + field(b) - field(a)
    crossed = F.date_diff(b.cast("date"), a.cast("date")).cast("bigint")
    for name, size, field in (("hour", 24, F.hour), ("minute", 60, F.minute), ("second", 60, F.second)):
        if part == "day":
            break
        crossed = crossed * size + field(b.cast("timestamp_ntz")) - field(a.cast("timestamp_ntz"))
        if part == name:
            break
    return crossed


def periods_since(date_col, period_name: str = "day", tz: str | None = None, as_of=None) -> Column:
    return periods_between(date_col, now(tz, as_of), period_name)


def n_days_ago(n: int, date=None, tz: str | None = None, as_of=None) -> Column:
    return F.date_sub(_day(date, tz, as_of), int(n))


def n_days_away(n: int, date=None, tz: str | None = None, as_of=None) -> Column:
    return n_days_ago(-int(n), date, tz, as_of)


def yesterday(date=None, tz: str | None = None, as_of=None) -> Column:
    return n_days_ago(1, date, tz, as_of)


def tomorrow(date=None, tz: str | None = None, as_of=None) -> Column:
    return n_days_away(1, date, tz, as_of)


def n_weeks_away(n: int, tz: str | None = None, as_of=None, week: str = "sunday") -> Column:
    return week_start(F.date_add(today(tz, as_of), 7 * int(n)), week)


def n_weeks_ago(n: int, tz: str | None = None, as_of=None, week: str = "sunday") -> Column:
    return n_weeks_away(-int(n), tz, as_of, week)


def last_week(tz: str | None = None, as_of=None, week: str = "sunday") -> Column:
    return n_weeks_ago(1, tz, as_of, week)


def next_week(tz: str | None = None, as_of=None, week: str = "sunday") -> Column:
    return n_weeks_away(1, tz, as_of, week)


def n_months_away(n: int, tz: str | None = None, as_of=None) -> Column:
    return F.trunc(F.add_months(today(tz, as_of), int(n)), "month")


def n_months_ago(n: int, tz: str | None = None, as_of=None) -> Column:
    return n_months_away(-int(n), tz, as_of)


def last_month(tz: str | None = None, as_of=None) -> Column:
    return n_months_ago(1, tz, as_of)


def next_month(tz: str | None = None, as_of=None) -> Column:
    return n_months_away(1, tz, as_of)


def last_month_number(tz: str | None = None, as_of=None) -> Column:
    return F.month(last_month(tz, as_of))


def next_month_number(tz: str | None = None, as_of=None) -> Column:
    return F.month(next_month(tz, as_of))


def last_month_name(short: bool = True, tz: str | None = None, as_of=None) -> Column:
    return month_name(last_month(tz, as_of), short)


def next_month_name(short: bool = True, tz: str | None = None, as_of=None) -> Column:
    return month_name(next_month(tz, as_of), short)


# --- conversions ---------------------------------------------------------------------------


def in_utc(instant) -> Column:
    """Zone-less UTC timestamp of an instant, whatever the zone of the session."""
    local = as_column(instant).cast("timestamp_ntz")
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), local)


def from_unixtimestamp(epochs, format: str = "seconds") -> Column:
    """Zone-less UTC timestamp of an epoch count."""
    column = as_column(epochs)
    micros_per = {"seconds": 1_000_000, "milliseconds": 1_000, "microseconds": 1}
    if format == "nanoseconds":
        micros = F.floor(column / 1000).cast("bigint")
    elif format in micros_per:
        micros = column.cast("bigint") * micros_per[format]
    else:
        raise ValueError(f"no epoch is counted in {format!r}")
    return in_utc(F.timestamp_micros(micros))


def to_unixtimestamp(timestamp) -> Column:
    """Whole seconds since the epoch; a zone-less timestamp counts as UTC."""
    column = as_column(timestamp).cast("timestamp_ntz")
    in_session = F.convert_timezone(F.lit("UTC"), F.current_timezone(), column)
    return F.unix_seconds(in_session.cast("timestamp"))


def round_timestamp(timestamp) -> Column:
    """The nearest midnight."""
    return date_trunc("day", add_periods(timestamp, 12, "hour"))


def make_date(year, month, day) -> Column:
    parts = [p if isinstance(p, Column) else F.lit(p) for p in (year, month, day)]
    return F.make_date(*parts)


def make_datetime(
    year, month, day, hour=0, minute=0, second=0, microsecond=0, tz: str | None = None
) -> Column:
    """The instant of a wall clock in ``tz`` (the default zone if none), as a timestamp."""
    fields = [p if isinstance(p, Column) else F.lit(p) for p in (year, month, day, hour, minute)]
    seconds = (second if isinstance(second, Column) else F.lit(second)) + (
        microsecond if isinstance(microsecond, Column) else F.lit(microsecond)
    ) / 1_000_000
    return F.make_timestamp(*fields, seconds.cast("decimal(16,6)"), F.lit(tz or DEFAULT_ZONE))
