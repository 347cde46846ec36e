"""Stored intermediates, bounded Arrow batches, fixed-size bitmaps and word hashes."""

from __future__ import annotations

import functools

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veritally.session import scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
# Words are runs of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
BATCH_BYTES = 16 << 20
BLOCK_BYTES = 1 << 20


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def lowered(text: Column) -> Column:
    """``text`` with A-Z in lower case and null as empty; no other character changes."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches to Python limited by bytes, so that long texts do not make large batches.

    The session keeps the limit, or a lower one that it had.
    """
    limit_batches(spark, BATCH_BYTES)


def limit_batches(spark: SparkSession, most: int) -> None:
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(key)
    if not now.isdigit() or not 0 < int(now) <= most:
        spark.conf.set(key, str(most))


class Scratch:
    """Tables written to the shared folder, removed when the ``with`` block ends.

    ``table`` stores an intermediate result. ``result`` stores what outlives the block. Both cut
    the lineage: what is read back survives the loss of any executor.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.label, self.paths = spark, label, []

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        for path in self.paths:
            self.remove(path)

    def remove(self, path: str) -> None:
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(at, True)

    def result(self, df: DataFrame) -> DataFrame:
        path = scratch_path(self.spark, self.label)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def table(self, df: DataFrame) -> DataFrame:
        path = scratch_path(self.spark, self.label)
        self.paths.append(path)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


BUCKET_BITS = 8 * 4096  # fixed by Spark's bitmap functions


def bitmap_of(keys: DataFrame, key: str, bits: int) -> DataFrame:
    """A bit for every value of the long column ``key``, modulo ``bits``.

    At most ``bits / 32768`` rows of 4 KiB, whatever the number of keys: safe to broadcast.
    """
    place = F.pmod(F.col(key), F.lit(bits))
    return keys.groupBy(F.bitmap_bucket_number(place).alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("_bits")
    )


def with_bit(rows: DataFrame, key: Column, bitmap: DataFrame, bits: int, name: str) -> DataFrame:
    """``rows`` with the boolean ``name``: whether the bit of ``key`` is set (false hits are possible)."""
    place = F.pmod(key, F.lit(bits))
    marks = F.broadcast(bitmap.select(F.col("_bucket").alias("_b"), F.col("_bits").alias("_m")))
    byte = F.expr("cast(conv(hex(substring(_m, cast(_p div 8 as int) + 1, 1)), 16, 10) as int)")
    bit = F.getbit(byte, F.col("_p") % 8) == 1
    return (
        rows.withColumn("_p", F.bitmap_bit_position(place))
        .withColumn("_n", F.bitmap_bucket_number(place))
        .join(marks, F.col("_n") == F.col("_b"), "left")
        .withColumn(name, F.coalesce(bit, F.lit(False)))
        .drop("_p", "_n", "_b", "_m")
    )


# ---- words of many texts at once ----

_LOWER_BYTES = np.arange(256, dtype=np.uint8)
_LOWER_BYTES[65:91] += 32
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0x9E3779B97F4A7C15  # odd, so that its powers have inverses modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)


@functools.lru_cache(2)
def _powers(log2: int) -> tuple[np.ndarray, np.ndarray]:
    made = []
    for base in (_BASE, _INVERSE):
        out = np.full(1 << log2, base, dtype=np.uint64)
        out[0] = 1
        made.append(np.cumprod(out, dtype=np.uint64))
    return made[0], made[1]


def mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of a 64-bit number spread over all bits, one to one."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def text_buffer(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row bounds of an Arrow string column; a null takes no bytes."""
    import pyarrow as pa

    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    bounds = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return (np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)), bounds


def row_blocks(bounds: np.ndarray, limit: int = BLOCK_BYTES):
    """Slices of rows of about ``limit`` bytes; a longer text has a slice of its own."""
    first = 0
    while first < len(bounds) - 1:
        last = int(np.searchsorted(bounds, bounds[first] + limit, side="right")) - 1
        last = max(first + 1, min(last, len(bounds) - 1))
        yield first, last
        first = last


def words_of(data: np.ndarray, bounds: np.ndarray, first: int, last: int):
    """(hash of every word, row bounds among the words, byte start of every word, byte end)."""
    start, end = int(bounds[first]), int(bounds[last])
    text = data[start:end]
    edges = (bounds[first : last + 1] - start).astype(np.int64)
    if not len(text):
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), np.zeros(last - first + 1, np.int64), none, none
    low = _LOWER_BYTES[text]
    solid = ~_IS_SPACE[text]
    inner = edges[1:-1][edges[1:-1] < len(text)]
    opens = solid.copy()
    opens[1:] &= ~solid[:-1]
    opens[inner] = solid[inner]
    starts = np.flatnonzero(opens)
    closes = solid.copy()
    closes[:-1] &= ~solid[1:]
    before = inner[inner > 0] - 1
    closes[before] = solid[before]
    ends = np.flatnonzero(closes) + 1
    up, down = _powers(max(BLOCK_BYTES.bit_length(), len(text).bit_length()))
    total = np.empty(len(text) + 1, dtype=np.uint64)
    total[0] = 0
    np.cumsum((low.astype(np.uint64) + np.uint64(1)) * up[: len(text)], dtype=np.uint64, out=total[1:])
    hashes = (total[ends] - total[starts]) * down[starts]
    hashes = mixed(hashes ^ ((ends - starts).astype(np.uint64) << np.uint64(40)))
    return hashes, np.searchsorted(starts, edges), starts, ends


def grams_of(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of every run of ``size`` words, also of runs that cross texts."""
    count = len(words) - size + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    out = words[:count].copy()
    for k in range(1, size):
        out *= np.uint64(0xD6E8FEB86659FD93)
        out += words[k : k + count]
    return mixed(out)
