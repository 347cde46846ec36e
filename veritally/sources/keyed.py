"""Keyed tables in hash buckets: an increment rewrites the buckets its keys fall in, and no others.

Every bucket of every version is a folder of its own, and a commit names one folder for each
bucket. So an upsert reads and writes only the buckets of its keys; all others are carried on by
name. The number of buckets is fixed when the table is first written.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veritally.operators.latest import upsert
from veritally.session import scratch_path
from veritally.sources import files
from veritally.sources.versions import counted_write, fresh_folder, log_of, remove_unnamed, schema_of

logger = logging.getLogger(__name__)

BUCKETS = 64
BUCKET = "__bucket"


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


class KeyedTable:
    """The rows of ``location``, in ``buckets`` buckets by ``keys``; the latest by ``order``, then ``tie``, stays."""

    def __init__(
        self,
        spark: SparkSession,
        location: str,
        keys: Sequence[str],
        order: str = "last_updated",
        tie: Sequence[str] = (),
        buckets: int = BUCKETS,
    ):
        self.spark, self.location, self.log = spark, location, log_of(spark, location)
        self.keys, self.order, self.tie, self.buckets = list(keys), order, tuple(tie), buckets

    def version(self) -> int | None:
        """The number of the last commit, or None for a table never written."""
        numbers = self.log.numbers()
        return numbers[-1] if numbers else None

    def entry(self, version: int | None = None) -> dict:
        number = self.version() if version is None else version
        if number is None:
            raise FileNotFoundError(f"nothing was stored in {self.location}")
        entry = self.log.read(number)
        if entry["keys"] != self.keys:
            raise ValueError(f"{self.location} has the keys {entry['keys']}, not {self.keys}")
        return entry

    def read(self, version: int | None = None, buckets: Sequence[int] | None = None) -> DataFrame:
        """All rows of a version (the present one by default), or those of some buckets."""
        entry = self.entry(version)
        wanted = range(len(entry["folders"])) if buckets is None else buckets
        paths = [f"{self.location}/{entry['folders'][b]}/{BUCKET}={b}" for b in wanted if entry["folders"][b]]
        schema = schema_of(entry)
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def replace(self, df: DataFrame) -> int:
        """Make ``df``, as it is, the whole table; return the number of the commit."""
        before = self.version()
        count = self.buckets if before is None else len(self.entry(before)["folders"])
        return self._commit(df, [None] * count, before)

    def upsert(self, increment: DataFrame, version: int | None = None) -> int:
        """Merge the latest row of every key of ``increment``; return the number of the commit.

        With ``version`` the increment is merged into that earlier state, which undoes what came
        after it: so a load that runs again replaces what its first run stored.
        """
        before = self.version()
        if before is None:
            return self._commit(upsert(None, increment, self.keys, self.order, self.tie), [None] * self.buckets, None)
        entry = self.entry(version)
        schema = schema_of(entry)
        if increment.schema.simpleString() != schema.simpleString():
            raise ValueError(f"the increment of {self.location} has other columns than the table")
        # Stored once: its buckets are needed before its rows, and reading it may be dear.
        path = scratch_path(self.spark, "increment")
        try:
            rows = counted_write(increment, path)
            stored = self.spark.read.schema(schema).parquet(path)
            place = bucket_of(self.keys, len(entry["folders"]))
            touched = sorted(r[0] for r in stored.select(place).distinct().collect()) if rows else []
            merged = upsert(self.read(version, touched), stored, self.keys, self.order, self.tie) if rows else stored
            folders = [None if b in set(touched) else f for b, f in enumerate(entry["folders"])]
            return self._commit(merged, folders, before)
        finally:
            files.remove(self.spark, path)

    def _commit(self, rows: DataFrame, folders: list[str | None], before: int | None) -> int:
        """Write ``rows`` and commit them beside the buckets that ``folders`` carries on."""
        folder, schema = fresh_folder(), rows.schema
        placed = rows.withColumn(BUCKET, bucket_of(self.keys, len(folders))).hint("rebalance", BUCKET)
        written = counted_write(placed, f"{self.location}/{folder}", BUCKET)
        made = {name for name, _, _ in files.listed(self.spark, f"{self.location}/{folder}")}
        now = [folder if f"{BUCKET}={b}" in made else kept for b, kept in enumerate(folders)]
        number = 0 if before is None else before + 1
        self.log.append(number, {"folders": now, "rows": written, "keys": self.keys, "schema": schema.json()})
        logger.info("%s: %d rows written, %d of %d buckets", self.location, written, len(made & _names(now)), len(now))
        return number

    def vacuum(self, keep: int = 2) -> list[str]:
        """Remove the buckets that none of the last ``keep`` commits names; not to be run beside a writer."""
        named = {(f, f"{BUCKET}={b}") for e in self.log.expire(keep) for b, f in enumerate(e["folders"]) if f}
        folders = {folder for folder, _ in named}
        gone = remove_unnamed(self.spark, self.location, folders)
        for folder in folders:
            for name, _, _ in files.listed(self.spark, f"{self.location}/{folder}"):
                if name.startswith(BUCKET) and (folder, name) not in named:
                    files.remove(self.spark, f"{self.location}/{folder}/{name}")
                    gone.append(f"{folder}/{name}")
        return gone


def _names(folders: list[str | None]) -> set[str]:
    return {f"{BUCKET}={b}" for b, f in enumerate(folders) if f}
