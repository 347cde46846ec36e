"""Every operator of this subpackage on its whole table, with SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veritally.llm import (
    alignment,
    exact_dedup,
    html_extraction,
    jaccard_join,
    language_id,
    license_scan,
    merkle,
    mixing,
    packing,
    suffix_dedup,
    token_counts,
    topk_search,
    toxicity,
)
from veritally.llm.common import LOWER, UPPER, Scratch, read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(build: Callable[[SparkSession, str], DataFrame]):
    QUERIES[build.__name__] = build
    return build


@query
def op2_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language_id.train_and_identify(read(spark, folder, "documents"))


@query
def op3_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    with Scratch(spark, "packing") as scratch:
        return scratch.result(packing.pack_documents(read(spark, folder, "documents"), scratch))


@query
def op4_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    with Scratch(spark, "mixing") as scratch:
        return scratch.result(mixing.mix_sources(read(spark, folder, "documents"), scratch).taken())


@query
def op8_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_duplicates(read(spark, folder, "documents"), digest="text_sha256")


@query
def op9_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    with Scratch(spark, "jaccard") as scratch:
        return scratch.result(jaccard_join.jaccard_components(read(spark, folder, "documents"), scratch))


ORACLE["op8_exact_dedup"] = f"""
WITH d AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), '{UPPER}', '{LOWER}')) AS h FROM documents
)
SELECT doc_id, max(doc_id) OVER (PARTITION BY h) AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
  doc_id = max(doc_id) OVER (PARTITION BY h) AS kept, h AS text_sha256
FROM d
"""


@query
def op6_topk_search(spark: SparkSession, folder: str) -> DataFrame:
    with Scratch(spark, "topk") as scratch:
        return scratch.result(topk_search.top_k(read(spark, folder, "embeddings"), scratch))


ORACLE["op6_topk_search"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS q FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id
), r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
    vec_id, score FROM s
)
SELECT * FROM r WHERE rank <= 20
"""


@query
def op10_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    with Scratch(spark, "tokens") as scratch:
        return scratch.result(token_counts.document_tokens(read(spark, folder, "documents"), scratch))


@query
def op5_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return html_extraction.extract(read(spark, folder, "pages"))


@query
def op7_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    with Scratch(spark, "suffixes") as scratch:
        return scratch.result(suffix_dedup.repeated_passages(read(spark, folder, "documents"), scratch))


def with_paths(docs: DataFrame) -> DataFrame:
    """Documents as files of a tree: source, then two levels by id; one of 64 is its folder's licence file."""
    number = F.col("doc_id")
    name = F.when(number % 64 == 0, F.lit("LICENSE")).otherwise(number.cast("string"))
    folders = [F.coalesce("source", F.lit("none")), F.floor(number / 4096), F.floor(number / 64)]
    return docs.select("doc_id", "text", F.concat_ws("/", *folders, name).alias("path"))


@query
def op1_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    with Scratch(spark, "licenses") as scratch:
        return scratch.result(license_scan.scan_licenses(with_paths(read(spark, folder, "documents")), scratch))


@query
def op11_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    with Scratch(spark, "merkle") as scratch:
        return scratch.result(merkle.merkle_manifest(read(spark, folder, "documents"), scratch))


def merkle_sql(levels: int = 5, top_levels: int = 3) -> str:
    """The manifest level by level, for up to 16**levels rows a source and 16**top_levels sources."""

    def field(name: str) -> str:
        return f"coalesce(strlen({name}::VARCHAR)::VARCHAR || ':' || {name}::VARCHAR, '-')"

    def leaf(text: str) -> str:
        head = " || ".join(field(c) for c in merkle.FIELDS[:-1])
        return f"sha256({head} || coalesce(strlen({text})::VARCHAR || ':' || {text}, '-'))"

    def siblings(name: str, rows: str) -> str:
        over = f"PARTITION BY tree, spot // {merkle.FAN} ORDER BY spot ROWS BETWEEN {rows}"
        return f"coalesce(string_agg(digest, '') OVER ({over}), '') AS {name}"

    def reduced(stage: str, count: int) -> list[str]:
        parts = []
        for k in range(count):
            parts.append(
                f"{stage}w{k} AS (SELECT *, {siblings('lefts', 'UNBOUNDED PRECEDING AND 1 PRECEDING')}, "
                f"{siblings('rights', '1 FOLLOWING AND UNBOUNDED FOLLOWING')} FROM {stage}{k})"
            )
            parts.append(
                f"{stage}{k + 1} AS (SELECT tree, spot // {merkle.FAN} AS spot, (size + {merkle.FAN - 1}) // {merkle.FAN} AS size, "
                f"CASE WHEN size > 1 THEN sha256(string_agg(digest, '' ORDER BY spot)) ELSE any_value(digest) END AS digest "
                f"FROM {stage}{k} GROUP BY tree, spot // {merkle.FAN}, size)"
            )
        return parts

    def climbed(start: str, stage: str, way: str, count: int) -> list[str]:
        names = [start, *[f"{way}{k}" for k in range(1, count + 1)]]
        return [
            f"{names[k + 1]} AS (SELECT f.* REPLACE (f.spot // {merkle.FAN} AS spot, f.proof || w.lefts || w.rights AS proof, "
            "CASE WHEN w.size > 1 THEN sha256(w.lefts || f.folded || w.rights) ELSE f.folded END AS folded) "
            f"FROM {names[k]} f JOIN {stage}w{k} w ON f.tree = w.tree AND f.spot = w.spot)"
            for k in range(count)
        ]

    step = "xor(a >> 1, (a & 1) * 3988292384)"
    crc = (
        "xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, strlen(doc_id::VARCHAR) + 1), "
        "lambda i: ascii(substr(doc_id::VARCHAR, i, 1))::BIGINT)), lambda c, x: "
        f"list_reduce(list_prepend(xor(c, x), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda a, z: {step})), 4294967295)"
    )
    lower = f"translate(text, '{UPPER}', '{LOWER}')"
    parts = [
        f"d AS (SELECT doc_id, source, {field('source')} AS tree, {leaf('text')} AS digest, "
        f"CASE WHEN {crc} % {merkle.TAMPER_EVERY} = 0 THEN {leaf(lower)} END AS tampered FROM documents)",
        "n0 AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, digest) - 1 AS spot, "
        "count(*) OVER (PARTITION BY tree) AS size FROM d)",
        *reduced("n", levels),
        f"r AS (SELECT DISTINCT tree, source FROM d), s AS (SELECT n{levels}.tree AS own, digest, "
        f"row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS spot, count(*) OVER () AS size, 't' AS tree "
        f"FROM n{levels} JOIN r ON n{levels}.tree = r.tree)",
        "t0 AS (SELECT tree, spot, size, digest FROM s)",
        *reduced("t", top_levels),
        "f0 AS (SELECT doc_id, tree, digest AS leaf, coalesce(tampered, digest) AS folded, '' AS proof, spot FROM n0)",
        *climbed("f0", "n", "f", levels),
        f"g0 AS (SELECT f.doc_id, f.leaf, f.folded, f.proof, s.digest AS subroot, s.tree, s.spot FROM f{levels} f "
        "JOIN s ON f.tree = s.own)",
        *climbed("g0", "t", "g", top_levels),
    ]
    return (
        "WITH " + ",\n".join(parts) + f"\nSELECT g.doc_id, g.leaf, g.subroot, t.digest AS root, sha256(g.proof) AS proof_sha256, "
        f"g.folded AS folded_root, g.folded = t.digest AS verified FROM g{top_levels} g CROSS JOIN t{top_levels} t"
    )


ORACLE["op11_merkle_manifest"] = merkle_sql()


@query
def op12_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = read(spark, folder, "documents"), read(spark, folder, "labels")
    with Scratch(spark, "toxicity") as scratch:
        return toxicity.score(docs, toxicity.fit(docs, labels, scratch))


@query
def op13_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    with Scratch(spark, "alignment") as scratch:
        return scratch.result(alignment.align_tokenizers(read(spark, folder, "documents"), scratch))
