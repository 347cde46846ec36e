"""Registration of queries beside their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from veritally.session import scratch_path
from veritally.sources.tables import write_snapshot

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
_LANDED: dict[tuple[str, str, str], str] = {}


class Tables:
    """The tables of one scale factor, by name."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._made: dict[str, DataFrame] = {}

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def __call__(self, name: str) -> DataFrame:
        return self.once(f"table {name}", lambda: self.spark.read.parquet(self.path(name)))

    def split(self, name: str) -> DataFrame:
        """The table in files that let its scan use all cores.

        The test tables are a single row group each, which one task has to read. They are landed
        again, once a session, as a few files for every core.
        """
        key = (self.spark.sparkContext.applicationId, self.folder, name)
        if key not in _LANDED:
            table, files = self(name), 2 * self.spark.sparkContext.defaultParallelism
            root = scratch_path(self.spark, "landed")
            _LANDED[key] = write_snapshot(table, root, name, "once", max(1, -(-table.count() // files)))
        return self.once(f"landed {name}", lambda: self.spark.read.schema(self(name).schema).parquet(_LANDED[key]))

    def once(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """A plan that several parts of a query use, built a single time."""
        if name not in self._made:
            self._made[name] = build()
        return self._made[name]


def shared(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    """Let all parts of a query share the plan that ``build`` makes."""
    return lambda t: t.once(build.__name__, lambda: build(t))


def add(name: str, build: Callable[[Tables], DataFrame], sql: str | None = None) -> None:
    if name in QUERIES:
        raise ValueError(f"query {name!r} is registered twice")
    QUERIES[name] = lambda spark, folder: build(Tables(spark, folder))
    if sql:
        ORACLE[name] = " ".join(sql.split())


def query(sql: str | None = None, name: str | None = None):
    """Register the decorated function, which takes the tables and returns a DataFrame."""

    def wrap(build: Callable[[Tables], DataFrame]):
        add(name or build.__name__, build, sql)
        return build

    return wrap
