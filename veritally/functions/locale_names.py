"""Weekday, month and season names in thirteen languages.

Weekday and month names come from the locale data of the JVM, which Spark's CSV date formatter
exposes; only the spellings that differ from it are listed here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The languages, and the season names (1 winter, 2 spring, 3 summer, 4 autumn).
SEASONS = {
    "en": ("winter", "spring", "summer", "autumn"),
    "nl": ("winter", "lente", "zomer", "herfst"),
    "de": ("Winter", "Frühling", "Sommer", "Herbst"),
    "fr": ("hiver", "printemps", "été", "automne"),
    "es": ("invierno", "primavera", "verano", "otoño"),
    "it": ("inverno", "primavera", "estate", "autunno"),
    "pt": ("inverno", "primavera", "verão", "outono"),
    "pl": ("zima", "wiosna", "lato", "jesień"),
    "da": ("vinter", "forår", "sommer", "efterår"),
    "sv": ("vinter", "vår", "sommar", "höst"),
    "tr": ("kış", "ilkbahar", "yaz", "sonbahar"),
    "cs": ("zima", "jaro", "léto", "podzim"),
    "fi": ("talvi", "kevät", "kesä", "syksy"),
}
LANGUAGES = tuple(SEASONS)

# Short names that are the first three letters of the long one.
THREE_LETTERS = ("sv",)
# Short month names with a spelling of their own, by (language, month).
SHORT_MONTHS = {("cs", 6): "čer"}
# Fixed value: the case ending Finnish weekday names carry inside a date.
FINNISH_ENDING = "na$"


def _formatted(day: Column, pattern: str, language: str) -> Column:
    if language not in LANGUAGES:
        raise ValueError(f"language must be one of {LANGUAGES}, got {language!r}")
    text = F.to_csv(F.struct(day.alias("d")), {"dateFormat": pattern, "locale": language})
    return F.when(day.isNotNull(), F.replace(text, F.lit("."), F.lit("")))


def weekday_text(day: Column, short: bool, language: str) -> Column:
    if language in THREE_LETTERS and short:
        return F.substring(weekday_text(day, False, language), 1, 3)
    text = _formatted(day, "EEE" if short else "EEEE", language)
    return F.regexp_replace(text, FINNISH_ENDING, "") if language == "fi" and not short else text


def month_text(day: Column, short: bool, language: str) -> Column:
    if language in THREE_LETTERS and short:
        return F.substring(month_text(day, False, language), 1, 3)
    text = _formatted(day, "LLL" if short else "LLLL", language)
    if short:
        for (lang, month), name in SHORT_MONTHS.items():
            if lang == language:
                text = F.when(F.month(day) == month, F.lit(name)).otherwise(text)
    return text


def season_text(number: Column, language: str) -> Column:
    """Name of season 1 to 4."""
    return F.get(F.array(*[F.lit(name) for name in SEASONS[language]]), number - 1)


def localized_names(spark: SparkSession, language: str, datepart: str) -> DataFrame:
    """All names of a part (``weekdays``, ``months``, ``seasons``): number, long, short."""
    if datepart == "seasons":
        numbers = spark.range(1, 5).select(F.col("id").cast("int").alias("number"))
        name = season_text(F.col("number"), language)
        return numbers.select("number", name.alias("long"), name.alias("short"))
    if datepart not in ("weekdays", "months"):
        raise ValueError(f"datepart must be weekdays, months or seasons, got {datepart!r}")
    weekdays = datepart == "weekdays"
    # 2024-01-01 is a Monday in January.
    start = F.lit("2024-01-01").cast("date")
    step = F.col("number") - 1
    day = F.date_add(start, step) if weekdays else F.add_months(start, step)
    text = weekday_text if weekdays else month_text
    numbers = spark.range(1, 8 if weekdays else 13).select(F.col("id").cast("int").alias("number"))
    return numbers.select(
        "number", text(day, False, language).alias("long"), text(day, True, language).alias("short")
    )
