"""A corpus pipeline of the operators in ``veritally.llm``: each stage works on all the last one kept.

``run`` stores every stage's rows as Parquet in the shared folder and reads them again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veritally.llm import exact_dedup, jaccard_join, language_id, mixing, packing
from veritally.llm.common import Scratch, limit_batches, read

# A document whose best language has a lower mean probability is rejected: 1.6 times that of a
# guess among all languages, at most 0.4.
LEAST_SCORE, LEAST_SHARE = 0.4, 1.6
BATCH_BYTES = 4 << 20  # the stages share their executors, so each gets less memory than alone
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language, which ``lang`` becomes."""
    limit_batches(spark, BATCH_BYTES)
    docs = docs.select(*COLUMNS)
    model = language_id.fit(docs.filter(~F.coalesce(language_id.held_out("doc_id"), F.lit(True))))
    found = language_id.identify(docs, model, carry=COLUMNS)
    good = found.filter((F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= least_score(model)))
    kept = good.select("carry.*", "lang_pred")
    return kept.withColumn("lang", F.col("lang_pred")).select(*COLUMNS)


def least_score(model: language_id.LanguageModel | None) -> float:
    return min(LEAST_SCORE, LEAST_SHARE / len(model.names)) if model else LEAST_SCORE


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id."""
    limit_batches(spark, BATCH_BYTES)
    return exact_dedup.drop_exact_duplicates(docs.select(*COLUMNS))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of linked documents the one with the smallest id.

    Rows whose id is missing, or has another text as well, are documents of their own under a
    negative number made from their text; of rows alike in both one stays.
    """
    limit_batches(spark, BATCH_BYTES)
    with Scratch(spark, "stage-near") as scratch:
        docs = docs.select(*COLUMNS)
        shared = docs.groupBy("doc_id").count().filter("count > 1 or doc_id is null")
        shared = scratch.table(shared.select(F.col("doc_id").alias("_shared"), F.lit(True).alias("_many")))
        numbered = docs.join(shared, F.col("doc_id").eqNullSafe(F.col("_shared")), "left")
        own = F.shiftrightunsigned(F.xxhash64("doc_id", "text"), 2)
        key = F.when(F.col("_many"), -own - 1).otherwise(F.col("doc_id"))
        numbered = numbered.select(*COLUMNS, key.alias("_key"), "_many")
        once = numbered.filter("_many").dropDuplicates(["_key"])
        numbered = numbered.filter("_many is null").unionByName(once).drop("_many")
        kept = jaccard_join.drop_near_duplicates(numbered, scratch, id_col="_key")
        return scratch.result(kept.select(*COLUMNS))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix takes: every document once for each time that blocks of it are drawn."""
    limit_batches(spark, BATCH_BYTES)
    with Scratch(spark, "stage-mix") as scratch:
        return scratch.result(mixing.mixed_documents(docs.select(*COLUMNS), scratch))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, with the sequence and the place there."""
    limit_batches(spark, BATCH_BYTES)
    with Scratch(spark, "stage-pack") as scratch:
        return scratch.result(packing.pack_documents(docs, scratch))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language ID", identify_language),
    ("exact dedup", drop_exact_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing sources to target weights", mix),
    ("best-fit packing", pack),
]

# Networks, tokens and keyed permutations have no SQL: tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of the mix of all documents that the stages keep.

    Texts without a letter go, null and empty ones among them, and no other row goes for its id:
    one that is missing or repeats loses no text. Ties are settled by the stages; an empty table
    gives no rows. Columns beyond ``COLUMNS`` are not looked at.
    """
    docs = read(spark, sf_dir, "documents")
    with Scratch(spark, "pipeline") as scratch:
        for _, stage in STAGES[:-1]:
            docs = scratch.table(stage(spark, docs, sf_dir))
        return scratch.result(STAGES[-1][1](spark, docs, sf_dir))
