"""Exact duplicates by progressive refinement: length, then a hash of the prefix, then of the whole.

Each step sees only rows whose group in the step before had company. What a step passes on is a
bitmap of fixed size, which every scan can hold, so no text is ever shuffled: the rows that move
are (length), (length, prefix hash) and (full hash, id). A bit shared by chance lets a row
through to the next step and changes no result, as the last step groups by the full hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veritally.llm.common import bitmap_of, lowered, with_bit

PREFIX_CHARS = 256
BITS = 1 << 24  # of each bitmap: 2 MiB


def full_hash(text: Column) -> Column:
    return F.sha2(lowered(text).cast("binary"), 256)


def company(rows: DataFrame, keys: list[str], bits: int) -> DataFrame:
    """Bitmap of the keys that occur at least twice."""
    several = rows.groupBy(*keys).count().filter("count > 1")
    return bitmap_of(several.select(F.xxhash64(*keys).alias("_key")), "_key", bits)


def suspects(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix_chars: int = PREFIX_CHARS, bits: int = BITS
) -> DataFrame:
    """(doc_id, _text, suspect): whether another row has the same length and the same prefix hash."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("_text"))
    rows = rows.withColumn("_size", F.octet_length("_text"))  # A-Z to a-z keeps the length
    rows = with_bit(rows, F.xxhash64("_size"), company(rows, ["_size"], bits), bits, "_sized")
    start = F.xxhash64(lowered(F.substring("_text", 1, prefix_chars)))
    rows = rows.withColumn("_start", F.when(F.col("_sized"), start))
    alike = company(rows.filter("_sized"), ["_size", "_start"], bits)
    rows = with_bit(rows, F.xxhash64("_size", "_start"), alike, bits, "_alike")
    return rows.select("doc_id", "_text", (F.col("_sized") & F.col("_alike")).alias("suspect"))


def exact_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    digest: str | None = None,
    prefix_chars: int = PREFIX_CHARS,
    bits: int = BITS,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept.

    Texts are equal if identical once A-Z is lower-cased; null is empty, and all empty texts are
    one group. The largest doc_id of a group stays. Repeated rows of one doc_id share their fate,
    a null doc_id loses against any other, and in a group of null ids keep_id is null and all
    stay. ``digest`` names an extra column with the full hash of every text, suspect or not.
    Other columns of ``docs`` are not looked at; an empty table gives an empty result.
    """
    rows = suspects(docs, id_col, text_col, prefix_chars, bits)
    whole = full_hash(F.col("_text"))
    groups = (
        rows.filter("suspect")
        .select("doc_id", whole.alias("_hash"), F.substring(whole, 1, 1).alias("_first"))
        .groupBy("_first", "_hash")
        .agg(F.max("doc_id").alias("_keep"), F.count("*").alias("_n"))
        .filter("_n > 1")
        .select(F.col("_hash").alias("_group"), "_keep", "_n")
    )
    # Rows without company get a key of their own, so that they do not meet in one partition.
    alone = F.concat(F.lit("#"), F.hex(F.xxhash64("doc_id", F.substring("_text", 1, 64))))
    key = whole if digest else F.when(F.col("suspect"), whole).otherwise(alone)
    found = rows.select("doc_id", key.alias("_hash")).join(groups, F.col("_hash") == F.col("_group"), "left")
    grouped = F.col("_n").isNotNull()
    return found.select(
        "doc_id",
        F.when(grouped, F.col("_keep")).otherwise(F.col("doc_id")).alias("keep_id"),
        F.coalesce("_n", F.lit(1)).cast("long").alias("group_size"),
        F.when(grouped, F.col("doc_id").eqNullSafe(F.col("_keep"))).otherwise(F.lit(True)).alias("kept"),
        *([F.col("_hash").alias(digest)] if digest else []),
    )


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    A row is known by its id and its text, so that of rows that share an id only those go whose
    own text a larger id has.
    """
    found = exact_duplicates(docs, id_col, text_col, digest="_digest")
    gone = found.filter("not kept").select(F.col("doc_id").alias("_gone"), F.col("_digest").alias("_with"))
    same = F.col(id_col).eqNullSafe(F.col("_gone")) & (full_hash(F.col(text_col)) == F.col("_with"))
    return docs.join(gone, same, "left_anti")
