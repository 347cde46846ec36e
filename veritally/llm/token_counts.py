"""Token counts by a separator scan of flat token files.

A flat token file is one run of token ids without any index; a document is what stands between
two end-of-document ids. Files are read in blocks of fixed size, which cut documents anywhere.
Every block is searched for the separator in one vectorised comparison and gives the number of
tokens before its first separator, between its separators, and after its last one. A prefix scan
over the blocks of a file then numbers the documents and stitches those that cross blocks.
"""

from __future__ import annotations

import functools

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from veritally.llm.common import Scratch, bounded_batches
from veritally.llm.packing import TOKENIZER, encoder

SEPARATOR = 50256  # <|endoftext|>, which no text encodes to
BLOCK_TOKENS = 1 << 18
BLOCKS = "file long, block long, ordinal long, doc_id long, tokens binary"


def flat_files(batches, tokenizer: str, separator: int, block_tokens: int):
    """One flat file for each task: blocks of ids, and as rows of their own the ids of its documents."""
    import pyarrow as pa
    from pyspark import TaskContext

    encode, file = encoder(tokenizer), TaskContext.get().partitionId()
    waiting, held, block, ordinal = [], 0, 0, 0
    names = ["file", "block", "ordinal", "doc_id", "tokens"]
    kinds = [pa.int64()] * 4 + [pa.binary()]

    def rows(*columns):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    for batch in batches:
        keys = batch.column(0).to_pylist()
        n = len(keys)
        yield rows([file] * n, [None] * n, range(ordinal, ordinal + n), keys, [None] * n)
        ordinal += n
        for text in batch.column(1):
            ids = encode(text.as_py() or "")
            ids.append(separator)
            waiting.append(np.array(ids, "<u4"))
            held += len(ids)
            if held >= block_tokens:
                flat = np.concatenate(waiting)
                for at in range(0, held - block_tokens + 1, block_tokens):
                    yield rows([file], [block], [None], [None], [flat[at : at + block_tokens].tobytes()])
                    block += 1
                waiting, held = [flat[held - held % block_tokens :]], held % block_tokens
    if held:
        yield rows([file], [block], [None], [None], [np.concatenate(waiting).tobytes()])


SCANNED = "file long, block long, ordinal long, doc_id long, size long, separators array<long>"


def scan_blocks(batches, separator: int):
    """Positions of the separators of every block; rows that name documents pass unchanged."""
    import pyarrow as pa

    for batch in batches:
        sizes, found = [], []
        for tokens in batch.column(4):
            if not tokens.is_valid:
                sizes.append(None)
                found.append(None)
                continue
            ids = np.frombuffer(tokens.as_buffer(), "<u4")
            sizes.append(len(ids))
            found.append(np.flatnonzero(ids == separator))
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:4], pa.array(sizes, pa.int64()), pa.array(found, pa.list_(pa.int64()))],
            names=["file", "block", "ordinal", "doc_id", "size", "separators"],
        )


def documents_of(scanned: DataFrame) -> DataFrame:
    """(file, ordinal, start, n_tokens) of every document of scanned blocks; the separator is not counted.

    Tokens after the last separator of a file are a last document, if there are any. Windows run
    over one narrow row for each block of a file (size, separators, place of the last one), and what
    they give is joined back to the places of the separators.
    """
    blocks = scanned.filter("size is not null").select("file", "block", "size", "separators")
    order = Window.partitionBy("file").orderBy("block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    narrow = blocks.select(
        "file",
        "block",
        "size",
        F.size("separators").cast("long").alias("_count"),
        F.get("separators", F.size("separators") - 1).alias("_last"),
    )
    placed = narrow.select(
        "file",
        "block",
        "size",
        "_count",
        "_last",
        F.coalesce(F.sum("size").over(before), F.lit(0)).alias("_at"),
        F.coalesce(F.sum("_count").over(before), F.lit(0)).alias("_documents"),
    )
    placed = placed.withColumn("_end", F.col("_at") + F.col("_last"))
    # The separator before the block: the last of the nearest earlier block that has one.
    placed = placed.withColumn("_open", F.coalesce(F.max("_end").over(before), F.lit(-1)))
    starts = placed.select("file", "block", "_at", "_documents", "_open")
    joined = blocks.filter(F.size("separators") > 0).join(starts.hint("merge"), ["file", "block"])
    ends = joined.select(
        "file", "_at", "_documents", "_open", "separators", F.posexplode("separators").alias("k", "place")
    )
    inner = F.col("_at") + F.get("separators", F.col("k") - 1)
    start = F.when(F.col("k") > 0, inner).otherwise(F.col("_open")) + 1
    whole = ends.select(
        "file",
        (F.col("_documents") + F.col("k")).alias("ordinal"),
        start.alias("start"),
        (F.col("_at") + F.col("place") - start).alias("n_tokens"),
    )
    total = placed.groupBy("file").agg(
        F.sum("_count").alias("ordinal"),
        (F.coalesce(F.max("_end"), F.lit(-1)) + 1).alias("start"),
        F.sum("size").alias("_size"),
    )
    tail = total.select("file", "ordinal", "start", (F.col("_size") - F.col("start")).alias("n_tokens"))
    return whole.unionByName(tail.filter("n_tokens > 0"))


def cut_files(batches, block_tokens: int):
    """Blocks of the files of every batch of (path, content)."""
    import pyarrow as pa

    step = 4 * block_tokens
    for batch in batches:
        for path, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            held = content.as_buffer()
            if held.size % 4:
                raise ValueError(f"{path} has {held.size} bytes, which is no number of 32-bit ids")
            for block in range(-(-held.size // step)):
                part = held.slice(block * step, min(step, held.size - block * step))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path]), pa.array([block], pa.int64()), pa.array([part.to_pybytes()], pa.binary())],
                    names=["path", "block", "tokens"],
                )


def flat_blocks(spark: SparkSession, path: str, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """(path, file, block, tokens) of the flat files in a folder: little-endian 32-bit ids and nothing else.

    ``file`` is a hash of the path. Spark's reader holds a file at a time in its task and takes up
    to 2 GB; files of some 100 MB suit it. An empty file gives no blocks, a cut id fails.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    cut = files.mapInArrow(functools.partial(cut_files, block_tokens=block_tokens), "path string, block long, tokens binary")
    return cut.select("path", F.xxhash64("path").alias("file"), "block", "tokens")


def count_tokens(blocks: DataFrame, separator: int = SEPARATOR, scratch: Scratch | None = None) -> DataFrame:
    """(file, ordinal, start, n_tokens) for blocks (file, block, tokens) of flat files of 32-bit ids.

    Blocks may have any length, also 0, and cut documents anywhere; ``block`` orders those of a file.
    With ``scratch`` the scan is stored, without it the blocks are read twice.
    """
    rows = blocks.select(
        F.col("file").cast("long").alias("file"), F.col("block").cast("long").alias("block"),
        F.lit(None).cast("long").alias("ordinal"), F.lit(None).cast("long").alias("doc_id"),
        F.coalesce("tokens", F.lit(b"")).alias("tokens"),
    )
    scanned = rows.mapInArrow(functools.partial(scan_blocks, separator=separator), SCANNED)
    return documents_of(scratch.table(scanned) if scratch else scanned)


def document_tokens(
    docs: DataFrame,
    scratch: Scratch,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str = TOKENIZER,
    separator: int = SEPARATOR,
    block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, file, ordinal, start.

    Every task writes its documents as one flat file, block by block, and the scan reads the blocks
    as they come; only sizes and separator positions are stored. Null and empty texts have 0
    tokens, a null doc_id stays null, repeated rows are documents of their own, and an empty table
    gives no rows. Other columns are not looked at.
    """
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    write = functools.partial(flat_files, tokenizer=tokenizer, separator=separator, block_tokens=block_tokens)
    scan = functools.partial(scan_blocks, separator=separator)
    scanned = scratch.table(rows.mapInArrow(write, BLOCKS).mapInArrow(scan, SCANNED))
    named = scanned.filter("size is null").select("file", "ordinal", "doc_id")
    counted = documents_of(scanned)
    return named.join(counted.hint("merge"), ["file", "ordinal"]).select("doc_id", "n_tokens", "file", "ordinal", "start")
