"""The registered queries: against their SQL, and the pipeline's stages against each other."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from bindings.compare import compare, connect
from veritally.llm import language_id
from veritally.llm.queries import ORACLE, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_against_sql(spark, name):
    assert compare(spark, connect(FOLDER), FOLDER, QUERIES[name], ORACLE[name]) is None


def test_every_operator_has_a_query():
    assert {int(name[2:].split("_")[0]) for name in QUERIES} == set(range(1, 14))


def test_pipeline(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    kept = [docs]
    for _, stage in corpus_pipeline.STAGES:
        kept.append(stage(spark, kept[-1], FOLDER).cache())
    assert all(set(k.columns) == set(docs.columns) for k in kept[:-1])
    ids = [{r["doc_id"] for r in k.select("doc_id").collect()} for k in kept]
    assert all(b <= a for a, b in zip(ids[:-1], ids[1:], strict=True))
    labels = {r["doc_id"]: r for r in language_id.train_and_identify(docs).collect()}
    assert ids[1] == {i for i, r in labels.items() if r["lang_pred"] != "und" and r["score"] >= corpus_pipeline.LEAST_SCORE}
    texts = [r["text"] for r in kept[2].collect()]
    assert len(texts) == len(set(t.lower() for t in texts))
    assert ids[5] == ids[4]
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, empty, FOLDER).count() == 0


def test_pipeline_keeps_every_text(spark):
    """Ids that are missing or repeat, with different texts, lose none of them on the way to the mix."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select(*corpus_pipeline.COLUMNS)
    number = F.col("doc_id")
    blurred = F.when(number % 3 == 0, F.lit(None)).when(number % 3 == 1, F.lit(5)).otherwise(number)
    mixed_up = docs.withColumn("doc_id", blurred.cast("long")).union(docs.limit(3).withColumn("text", F.lit(None).cast("string")))
    kept = mixed_up
    for name, stage in corpus_pipeline.STAGES[:3]:
        kept = stage(spark, kept, FOLDER).cache()
        assert kept.columns == docs.columns, name
    assert len({r["text"].lower() for r in kept.collect()}) == kept.count()
    # Near copies go, and only they: about as many as with ids that tell all rows apart.
    alone = docs
    for _, stage in corpus_pipeline.STAGES[:3]:
        alone = stage(spark, alone, FOLDER).cache()
    assert kept.count() == alone.count() and kept.filter("doc_id is null").count() > 10
    words = kept.select(F.sum(F.regexp_count("text", F.lit(r"[^\\x20\\x09-\\x0D]+")))).head()[0]
    taken = corpus_pipeline.mix(spark, kept, FOLDER)
    assert taken.select(F.sum(F.regexp_count("text", F.lit(r"[^\\x20\\x09-\\x0D]+")))).head()[0] >= 0.9 * words
    pieces = corpus_pipeline.pack(spark, taken.cache(), FOLDER)
    assert pieces.filter("piece = 0").count() == taken.count()
    assert corpus_pipeline.pack(spark, docs.limit(0), FOLDER).count() == 0
