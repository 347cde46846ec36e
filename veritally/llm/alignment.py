"""Alignment of the tokens of two tokenizers over the same bytes, with corpus-wide pair counts.

Both tokenizers cut the same bytes, so every token start of one side lies in one token of the
other: two ``merge_asof`` calls per block of documents, keyed by document, find them, and the union
of both directions is all overlaps. Starts that coincide begin the groups.

Pair counts need the whole corpus. A block of documents writes its own dictionary of id pairs with
the number of its documents that hold each, and its documents refer to places in that dictionary.
Only dictionaries are shuffled to be counted; the counts come back to the block, cogrouped with its
documents. So a pair that every document holds costs a row per block, not a row per document.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritally.llm.common import Scratch, bounded_batches, row_blocks, text_buffer

SIDE_A, SIDE_B = "byte_bpe_50k", "piece_bpe_32k"
RADIX = 1 << 20  # more than any id of side B
ALIGN_BYTES = 1 << 20  # of text in a block of documents; a longer text is a block of its own
ALIGNED = (
    "block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "places array<int>, times array<int>, pairs array<long>, pair_docs array<long>"
)
RESULT = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
)


# ---- the two sides ----


@functools.lru_cache(2)
def side_a(name: str):
    """(text to ids, bytes of every id, their numbers) of a byte-level vocabulary, for texts with their leading space."""
    from veritally.llm.packing import encoder, ranks

    table: list[bytes] = []
    for piece, number in sorted(ranks(name).items(), key=lambda item: item[1]):
        table += [b""] * (number - len(table)) + [piece]
    return encoder(name), table, np.array([len(x) for x in table], np.int64)


@functools.lru_cache(2)
def side_b(name: str):
    """(text to ids, bytes of every id, their numbers) of a piece vocabulary, which adds the leading space itself."""
    import public_tokenizers
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(f"{name}.model"))
    table = []
    for number in range(model.get_piece_size()):
        piece = model.id_to_piece(number)
        table.append(bytes([int(piece[3:5], 16)]) if model.is_byte(number) else piece.replace("▁", " ").encode())
    return model.encode, table, np.array([len(x) for x in table], np.int64)


@functools.lru_cache(2)
def digits(most: int) -> np.ndarray:
    """The decimal digits of 0 to ``most`` as rows of bytes, padded with zero bytes, one byte to spare."""
    text = np.arange(most + 1).astype(f"S{len(str(most))}")
    out = np.zeros((most + 1, len(str(most)) + 1), np.uint8)
    out[:, :-1] = text.view(np.uint8).reshape(most + 1, -1)
    return out


# ---- one block of documents ----


def overlaps(a_at: np.ndarray, a_doc: np.ndarray, b_at: np.ndarray, b_doc: np.ndarray):
    """(A token, B token) of every overlap, and for both sides whether a token's start begins a group.

    Starts are places in one line of all documents, so they ascend on both sides.
    """
    import pandas as pd

    a = pd.DataFrame({"at": a_at, "doc": a_doc})
    b = pd.DataFrame({"at": b_at, "doc": b_doc})
    in_b = pd.merge_asof(a, b.assign(b=np.arange(len(b))), on="at", by="doc")["b"].to_numpy()
    in_a = pd.merge_asof(b, a.assign(a=np.arange(len(a))), on="at", by="doc")["a"].to_numpy()
    a_begins, b_begins = b_at[in_b] == a_at, a_at[in_a] == b_at
    later = np.flatnonzero(~b_begins)  # the others are pairs that the first direction has found
    return np.concatenate([np.arange(len(a)), in_a[later]]), np.concatenate([in_b, later]), a_begins, b_begins


def group_texts(a_ids, a_group, b_ids, b_group, last_group: np.ndarray, width_table: np.ndarray):
    """The groups of all documents as bytes, and where each document's end; ``last_group`` are its last groups."""
    size = len(a_ids) + len(b_ids)
    a_place = np.arange(len(a_ids)) + np.searchsorted(b_group, a_group, side="left")
    b_place = np.arange(len(b_ids)) + np.searchsorted(a_group, b_group, side="right")
    ids, group, side = np.empty(size, np.int64), np.empty(size, np.int64), np.zeros(size, np.int8)
    ids[a_place], ids[b_place] = a_ids, b_ids
    group[a_place], group[b_place] = a_group, b_group
    side[b_place] = 1
    same = np.append(group[1:] == group[:-1], False)
    mark = np.where(same, np.where(np.append(side[1:] == side[:-1], False), ord(","), ord("|")), ord(";"))
    ends = np.searchsorted(group, last_group, side="right") - 1
    mark[ends] = 0
    rows = width_table[ids]
    rows[:, -1] = mark
    solid = rows != 0
    return rows[solid].tobytes(), np.cumsum(solid.sum(axis=1))[ends]


def align_texts(texts: list[str | None], a_side: str, b_side: str):
    """Per document (n_a, n_b, n_groups, n_links, groups_sha256), and all links as (document, A id, B id)."""
    encode_a, bytes_a, long_a = side_a(a_side)
    encode_b, bytes_b, long_b = side_b(b_side)
    a_lists, b_lists, kept = [], [], []
    for number, text in enumerate(texts):
        if not text:
            continue
        whole = (" " + text).encode()
        a, b = encode_a(" " + text), encode_b(text)
        if b"".join(map(bytes_a.__getitem__, a)) == whole and b"".join(map(bytes_b.__getitem__, b)) == whole:
            a_lists.append(np.array(a, np.int64))
            b_lists.append(np.array(b, np.int64))
            kept.append(number)
    counts = np.zeros((4, len(texts)), np.int64)
    hashes = [""] * len(texts)
    none = np.zeros(0, np.int64)
    if not kept:
        return counts, hashes, (none, none, none)
    kept = np.array(kept)
    a_sizes, b_sizes = [np.array([len(x) for x in lists]) for lists in (a_lists, b_lists)]
    a_ids, b_ids = np.concatenate(a_lists), np.concatenate(b_lists)
    a_doc, b_doc = np.repeat(kept, a_sizes), np.repeat(kept, b_sizes)
    a_long, b_long = long_a[a_ids], long_b[b_ids]
    a_link, b_link, a_begins, b_begins = overlaps(np.cumsum(a_long) - a_long, a_doc, np.cumsum(b_long) - b_long, b_doc)
    a_group, b_group = np.cumsum(a_begins) - 1, np.cumsum(b_begins) - 1
    last = a_group[np.cumsum(a_sizes) - 1]
    text, ends = group_texts(a_ids, a_group, b_ids, b_group, last, digits(max(len(bytes_a), len(bytes_b))))
    for number, start, end in zip(kept.tolist(), [0, *ends[:-1].tolist()], ends.tolist(), strict=True):
        hashes[number] = hashlib.sha256(text[start:end]).hexdigest()
    link_doc = a_doc[a_link]
    counts[0, kept], counts[1, kept] = a_sizes, b_sizes
    counts[2, kept] = np.diff(last, prepend=-1)
    counts[3] = np.bincount(link_doc, minlength=len(texts))
    return counts, hashes, (link_doc, a_ids[a_link], b_ids[b_link])


def align_blocks(batches, a_side: str, b_side: str):
    """A row per document; the first row of a block also carries the block's dictionary of pairs."""
    import pyarrow as pa
    from pyspark import TaskContext

    block = TaskContext.get().partitionId() << 32
    for batch in batches:
        _, bounds = text_buffer(batch.column(1))
        for first, last in row_blocks(bounds, ALIGN_BYTES):
            texts = batch.column(1).slice(first, last - first).to_pylist()
            counts, hashes, (doc, a, b) = align_texts(texts, a_side, b_side)
            pair = a * RADIX + b
            pairs, place = np.unique(pair, return_inverse=True)
            held, times = np.unique(doc * max(1, len(pairs)) + place, return_counts=True)
            holder, place = held // max(1, len(pairs)), held % max(1, len(pairs))
            offsets = pa.array(np.searchsorted(holder, np.arange(len(texts) + 1)), pa.int32())
            only_first = pa.array([0, *[len(pairs)] * len(texts)], pa.int32())
            columns = [
                pa.array(np.full(len(texts), block), pa.int64()),
                batch.column(0).slice(first, last - first),
                *[pa.array(c) for c in counts],
                pa.array(hashes, pa.string()),
                pa.ListArray.from_arrays(offsets, pa.array(place, pa.int32())),
                pa.ListArray.from_arrays(offsets, pa.array(times, pa.int32())),
                pa.ListArray.from_arrays(only_first, pa.array(pairs, pa.int64())),
                pa.ListArray.from_arrays(only_first, pa.array(np.bincount(place, minlength=len(pairs)), pa.int64())),
            ]
            names = [part.split()[0] for part in ALIGNED.split(", ")]
            yield pa.RecordBatch.from_arrays(columns, names=names)
            block += 1


# ---- counts over all blocks ----


def pair_counts(dictionaries: DataFrame) -> DataFrame:
    """pair, docs, best: the documents that hold a pair, and whether no other pair of its A id has more."""
    counts = dictionaries.groupBy("pair").agg(F.sum("n").alias("docs"))
    counts = counts.withColumn("a", F.floor(F.col("pair") / RADIX))
    most = counts.groupBy("a").agg(F.max("docs").alias("most"))
    return counts.join(most, "a").select("pair", "docs", (F.col("docs") == F.col("most")).alias("best"))


def count_block(docs, places):
    """The documents of one block with the sums over their links."""
    import pyarrow as pa

    at = places.column("place").to_numpy()
    count, best = np.zeros(len(at), np.int64), np.zeros(len(at), bool)
    count[at] = places.column("docs").to_numpy()
    best[at] = places.column("best").to_numpy()
    place, times = docs.column("places").combine_chunks(), docs.column("times").combine_chunks()
    row = np.repeat(np.arange(docs.num_rows), np.diff(place.offsets.to_numpy()))
    place, times = place.flatten().to_numpy(), times.flatten().to_numpy().astype(np.int64)
    sums = [np.zeros(docs.num_rows, np.int64) for _ in range(2)]
    np.add.at(sums[0], row, times * best[place])
    np.add.at(sums[1], row, times * count[place])
    keep = ["doc_id", "n_a", "n_b", "n_groups", "n_links"]
    return pa.table(
        [*[docs.column(c) for c in keep], *[pa.array(s) for s in sums], docs.column("groups_sha256")],
        names=[*keep, "n_best", "count_sum", "groups_sha256"],
    )


def align_tokenizers(
    docs: DataFrame,
    scratch: Scratch,
    id_col: str = "doc_id",
    text_col: str = "text",
    a_side: str = SIDE_A,
    b_side: str = SIDE_B,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    Side A encodes the text after a space, side B the text, to which it adds that space. Null and
    empty texts, and texts whose tokens do not spell space and text again on both sides, have no
    tokens: zeros and an empty digest. Every row is a document of its own, so repeated rows each
    add to the counts; a null doc_id stays null; an empty table gives an empty result. Of several
    best pairs of an A id all are best. Other columns are not looked at. A task holds one block,
    so that its memory grows with the longest text and not with the table.
    """
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    make = functools.partial(align_blocks, a_side=a_side, b_side=b_side)
    aligned = scratch.table(rows.mapInArrow(make, ALIGNED))
    entries = aligned.filter("size(pairs) > 0").select(
        "block", F.posexplode(F.arrays_zip("pairs", "pair_docs")).alias("place", "entry")
    )
    entries = entries.select("block", "place", F.col("entry.pairs").alias("pair"), F.col("entry.pair_docs").alias("n"))
    found = entries.join(pair_counts(entries), "pair").select(F.col("block").alias("home"), "place", "docs", "best")
    return (
        aligned.drop("pairs", "pair_docs")
        .groupBy("block")
        .cogroup(found.groupBy("home"))
        .applyInArrow(count_block, RESULT)
    )
