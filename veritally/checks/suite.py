"""Suites of checks: many checks on one table, in few scans, with a report."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veritally.checks.keyed import Keyed, failures, fits
from veritally.checks.kernel import REGISTRY

DEFAULT_FAIL_CALC = "count(*)"


@dataclass(frozen=True)
class CheckSpec:
    """A check by name with its arguments, and what its violations mean.

    ``fail_calc`` is an aggregate over the violations. It is compared with ``error_if`` and
    ``warn_if``; at severity ``warn`` only the latter counts.
    """

    check: str
    arguments: dict = field(default_factory=dict)
    label: str | None = None
    severity: str = "error"
    error_if: str = "!= 0"
    warn_if: str = "!= 0"
    fail_calc: str = DEFAULT_FAIL_CALC
    enabled: bool = True

    def __post_init__(self):
        if self.severity not in ("error", "warn"):
            raise ValueError(f"severity must be 'error' or 'warn', got {self.severity!r}")
        if self.check not in REGISTRY:
            raise ValueError(f"no check is called {self.check!r}")

    @property
    def name(self) -> str:
        return self.label or f"{self.check}:{self.arguments.get('column_name', 'table')}"

    def violations(self, df: DataFrame) -> DataFrame:
        return REGISTRY[self.check](df, **self.arguments)

    def status(self) -> Column:
        warn = F.when(F.expr(f"failures {self.warn_if}"), "warn").otherwise("pass")
        if self.severity == "warn":
            return warn
        return F.when(F.expr(f"failures {self.error_if}"), "error").otherwise(warn)

    def vacuous(self, df: DataFrame) -> Column:
        tell = getattr(REGISTRY[self.check], "vacuous", None)
        answer = tell(df, **self.arguments) if tell else False
        return answer if isinstance(answer, Column) else F.lit(answer)

    def fused_count(self, df: DataFrame) -> Column | None:
        """The failures as one aggregate of the checked table, if the check allows that."""
        check, arguments = REGISTRY[self.check], dict(self.arguments)
        level = getattr(check, "level", None)
        if level is None or level == "single" or self.fail_calc != DEFAULT_FAIL_CALC:
            return None
        condition = arguments.pop("row_condition", None)
        arguments.pop("carry", None)
        if arguments.pop("group_by", None) or arguments.pop("group_by_columns", None):
            return None
        if level == "aggregate":
            if condition and not check.skips_nulls:
                return None
            if condition:
                column = arguments["column_name"]
                arguments["column_name"] = f"CASE WHEN {condition} THEN {column} END"
            broken = ~check.predicate(**arguments)
            return F.when(broken, 1).otherwise(0).cast("bigint")
        holds = check.predicate(**arguments)
        if holds is None:
            return None
        count = F.count_if(F.expr(condition) & ~holds if condition else ~holds)
        return count if level == "row" or _is_plain(df, count) else None


    def keyed_count(self, df: DataFrame) -> tuple[Keyed, str | None] | None:
        """The failures as a count over the distinct values of a column, if the check allows that."""
        make, arguments = getattr(REGISTRY[self.check], "keyed", None), dict(self.arguments)
        if make is None or self.fail_calc != DEFAULT_FAIL_CALC or arguments.pop("group_by", None):
            return None
        condition = arguments.pop("row_condition", None)
        made = make(**arguments)
        return (made, condition) if fits(df, made) else None


def _is_plain(df: DataFrame, count: Column) -> bool:
    """Whether the counted expression looks at one row; aggregates and windows cannot be counted."""
    try:
        return bool(df.agg(count).columns)
    except AnalysisException:
        return False


def run_suite(df: DataFrame, specs: Sequence[CheckSpec]) -> DataFrame:
    """(check, failures, status, vacuous), one row per enabled check.

    All checks and expressions that look at one row, and all plain aggregates, with or without a
    row condition, share a single scan of the table that reads only the columns they name. Checks
    on distinct values (unique, partners in another table, members of a set, distinct counts)
    share a second one. The others run as jobs of their own. Nothing is collected: violations are
    counted where they are.
    """
    active = [s for s in specs if s.enabled]
    if not active:
        raise ValueError("no check is enabled")
    fused = [(s, s.fused_count(df)) for s in active]
    shared = [(s, count) for s, count in fused if count is not None]
    reports = []
    if shared:
        counts = df.agg(*[count.alias(f"c{i}") for i, (_, count) in enumerate(shared)])
        reports.append(_report(_numbered(counts), [s for s, _ in shared], df))
    by_value = [(s, s.keyed_count(df)) for s, count in fused if count is None]
    keyed = [(s, made) for s, made in by_value if made is not None]
    if keyed:
        counts = failures(df, [made for _, made in keyed])
        reports.append(_report(_numbered(counts), [s for s, _ in keyed], df))
    for spec in [s for s, made in by_value if made is None]:
        counted = spec.violations(df).agg(F.expr(spec.fail_calc).cast("bigint").alias("failures"))
        reports.append(_report(counted.withColumn("position", F.lit(0)), [spec], df))
    return reduce(DataFrame.unionByName, reports)


def _numbered(counts: DataFrame) -> DataFrame:
    """(position, failures) of the columns c0, c1, ... of a single row."""
    rows = [
        F.struct(F.lit(i).alias("position"), F.col(c).alias("failures")) for i, c in enumerate(counts.columns)
    ]
    return counts.select(F.inline(F.array(*rows)))


def _report(numbered: DataFrame, specs: Sequence[CheckSpec], df: DataFrame) -> DataFrame:
    def pick(values: list[Column]) -> Column:
        return F.get(F.array(*values), F.col("position"))

    failures = F.coalesce(F.col("failures"), F.lit(0).cast("bigint"))
    return numbered.withColumn("failures", failures).select(
        pick([F.lit(s.name) for s in specs]).alias("check"),
        "failures",
        pick([s.status() for s in specs]).alias("status"),
        pick([s.vacuous(df) for s in specs]).alias("vacuous"),
    )


def worst(report: DataFrame) -> DataFrame:
    """The report in one row: checks, and how many passed, warned and failed."""
    return report.agg(
        F.count(F.lit(1)).alias("checks"),
        *[
            F.count_if(F.col("status") == status).alias(alias)
            for status, alias in (("pass", "passed"), ("warn", "warned"), ("error", "failed"))
        ],
    )


def mart_suites(dim_patient: DataFrame) -> dict[str, list[CheckSpec]]:
    """The checks applied to the staging models and marts."""

    def key(column: str) -> list[CheckSpec]:
        return [CheckSpec(c, {"column_name": column}) for c in ("unique", "not_null")]

    def filled(column: str) -> list[CheckSpec]:
        return [CheckSpec("not_null", {"column_name": column})]

    claims = [
        *key("eob_id"),
        *filled("patient_id"),
        CheckSpec(
            "relationships", {"column_name": "patient_id", "to": dim_patient, "field": "patient_id"}
        ),
        CheckSpec(
            "expect_column_values_to_be_between",
            {"column_name": "total_payment", "min_value": 0, "max_value": 5000000},
            severity="warn",
        ),
        CheckSpec(
            "expect_column_values_to_be_between",
            {
                "column_name": "service_start_date",
                "min_value": "date'1980-01-01'",
                "max_value": "date'2030-01-01'",
            },
            severity="warn",
        ),
        CheckSpec(
            "expect_column_value_lengths_to_be_between",
            {"column_name": "primary_diagnosis_code", "min_value": 3, "max_value": 10},
        ),
    ]
    return {
        "stg_patient": key("patient_id"),
        "stg_coverage": [*key("coverage_id"), *filled("patient_id")],
        "stg_eob": [*key("eob_id"), *filled("patient_id")],
        "dim_patient": key("patient_id"),
        "fct_claims": claims,
        "fct_coverage": filled("patient_id"),
    }
