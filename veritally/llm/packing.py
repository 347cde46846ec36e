"""Best-fit packing of documents into sequences, level by level.

Every partition packs its items best-fit decreasing and lets go of bins that are nearly full. The
underfull bins are the items of the next level, which has an eighth of the partitions; a level of
one partition, or one that no longer saves bins, ends the merging. No partition ever holds more
than ``PART_ITEMS`` items, so a corpus whose bins cannot be merged costs no large task.
"""

from __future__ import annotations

import functools
import math
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritally.llm.common import Scratch, bounded_batches

CAPACITY = 1024
SLACK = 8
PART_ITEMS = 50_000
FAN_IN = 8
END_ID = 2
TOKENIZER = "byte_bpe_50k"
MEMBER = "struct<doc_id:long,piece:int,start:long,length:long,ids_crc32:long>"


@functools.lru_cache(2)
def ranks(name: str) -> dict[bytes, int]:
    """The ids of a byte-level vocabulary by their bytes."""
    import base64

    import public_tokenizers

    with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


@functools.lru_cache(2)
def slow_encoder(name: str):
    import public_tokenizers
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(public_tokenizers.path(f"{name}.json"))
    made.encode_special_tokens = True
    return made


@functools.lru_cache(2)
def encoder(name: str):
    """A function from text to ids. The rank file has the vocabulary and merges of the json file,
    and its library gives the same ids in a third of the time; only runs of white space beyond the
    depth of its stack, some hundred thousand characters, are left to the other library."""
    import public_tokenizers
    import tiktoken

    made = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks(name), special_tokens={})

    def encode(text: str) -> list[int]:
        try:
            return made.encode_ordinary(text)
        except BaseException as error:
            if type(error).__name__ != "PanicException":
                raise
            return slow_encoder(name).encode(text, add_special_tokens=False).ids

    return encode


def piece_bounds(total: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces: all of full length, but for the first of a longer document."""
    if total <= capacity:
        return [(0, total)]
    first = total % capacity
    starts = ([0] if first else []) + list(range(first, total, capacity))
    return [(s, first if s == 0 and first else capacity) for s in starts]


def tokenized(batches, name: str, end_id: int, capacity: int):
    import pyarrow as pa

    encode = encoder(name)
    for batch in batches:
        out = ([], [], [], [], [])
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            ids = encode(text.as_py() or "")
            ids.append(end_id)
            raw = np.array(ids, dtype="<u4").tobytes()
            for number, (start, length) in enumerate(piece_bounds(len(ids), capacity)):
                crc = zlib.crc32(raw[4 * start : 4 * (start + length)])
                for column, value in zip(out, (doc, number, start, length, crc), strict=True):
                    column.append(value)
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(out, kinds, strict=True)],
            names=["doc_id", "piece", "start", "length", "ids_crc32"],
        )
    pa.default_memory_pool().release_unused()


def token_pieces(
    docs: DataFrame, id_col: str, text_col: str, tokenizer: str = TOKENIZER, end_id: int = END_ID, capacity: int = CAPACITY
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: the tokens of every document, its end id last."""
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    make = functools.partial(tokenized, name=tokenizer, end_id=end_id, capacity=capacity)
    return rows.mapInArrow(make, "doc_id long, piece int, start long, length long, ids_crc32 long")


def best_fit(fills: np.ndarray, capacity: int) -> list[list[int]]:
    """Items by bin: largest items first, each into the open bin with the least room that takes it."""
    bins: list[list[int]] = []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r is set while a bin has r left
    for item in np.argsort(-fills, kind="stable").tolist():
        size = int(fills[item])
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            into = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
            bins[into].append(item)
        else:
            room, into = capacity, len(bins)
            bins.append([item])
        by_room[room - size].append(into)
        rooms |= 1 << (room - size)
    return bins


def pack_partition(batches, capacity: int, slack: int):
    """Bins of one partition: (fill, members, closed)."""
    import pyarrow as pa

    table = pa.Table.from_batches(list(batches)) if (batches := [b for b in batches if b.num_rows]) else None
    if table is None:
        return
    fills = table.column("fill").to_numpy()
    lists = table.column("members").combine_chunks()
    if isinstance(lists, pa.ChunkedArray):
        lists = pa.concat_arrays(lists.chunks)
    bins = best_fit(fills, capacity)
    order = np.fromiter((i for b in bins for i in b), np.int64, len(fills))
    taken = lists.take(pa.array(order))
    bounds = taken.offsets.to_numpy()[np.concatenate([[0], np.cumsum([len(b) for b in bins])])]
    members = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), taken.values)
    sums = np.add.reduceat(fills[order], np.concatenate([[0], np.cumsum([len(b) for b in bins])[:-1]]))
    yield pa.RecordBatch.from_arrays(
        [pa.array(sums, pa.int64()), members, pa.array(sums >= capacity - slack)], names=["fill", "members", "closed"]
    )


def pack_pieces(
    pieces: DataFrame, scratch: Scratch, capacity: int = CAPACITY, slack: int = SLACK, part_items: int = PART_ITEMS
) -> DataFrame:
    """``pieces`` (stored) with sequence_id and offset; every length is between 1 and ``capacity``."""
    member = F.struct("doc_id", "piece", "start", "length", "ids_crc32")
    items = pieces.select(F.col("length").alias("fill"), F.array(member).alias("members"))
    done = [items.filter(F.col("fill") >= capacity - slack)]
    items = items.filter(F.col("fill") < capacity - slack)
    count = items.count()
    parts = max(1, math.ceil(count / part_items))
    make = functools.partial(pack_partition, capacity=capacity, slack=slack)
    while count:
        # By the number of the row in the stored table: ids may be missing or repeat.
        dealt = items.select("fill", "members", F.monotonically_increasing_id().alias("_row")).repartition(parts, "_row")
        dealt = dealt.select("fill", "members")
        bins = scratch.table(dealt.mapInArrow(make, f"fill long, members array<{MEMBER}>, closed boolean"))
        done.append(bins.filter("closed").select("fill", "members"))
        items = bins.filter("not closed").select("fill", "members")
        left = items.count()
        if parts == 1 or left > 0.98 * count:
            break
        count, parts = left, max(math.ceil(left / part_items), math.ceil(parts / FAN_IN))
    sequences = functools.reduce(DataFrame.unionByName, [*done, items] if count else done)
    numbered = sequences.withColumn("sequence_id", F.monotonically_increasing_id())
    return numbered.mapInArrow(
        spread_members,
        "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long",
    )


def spread_members(batches):
    import pyarrow as pa

    for batch in batches:
        lists, fills = batch.column(1), batch.column(0).to_numpy()
        values, per = lists.flatten(), np.diff(lists.offsets.to_numpy())
        length = values.field("length").to_numpy(zero_copy_only=False)
        offset = np.cumsum(length) - length - np.repeat(np.cumsum(fills) - fills, per)
        sequence = np.repeat(batch.column(2).to_numpy(), per)
        names = ["doc_id", "piece", "start", "length", "ids_crc32"]
        columns = [values.field(n) for n in names] + [pa.array(sequence), pa.array(offset)]
        yield pa.RecordBatch.from_arrays(columns, names=[*names, "sequence_id", "offset"])


def pack_documents(
    docs: DataFrame,
    scratch: Scratch,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str = TOKENIZER,
    end_id: int = END_ID,
    capacity: int = CAPACITY,
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece of every document.

    A document is its ids and then ``end_id``; one longer than ``capacity`` is cut into pieces of
    that length, only the first being shorter. Null and empty texts are a piece of the end id
    alone; repeated rows are packed as often as they occur; a null doc_id stays null; an empty
    table gives no rows. Offsets in a sequence leave no gap. Other columns are not looked at.
    """
    pieces = scratch.table(token_pieces(docs, id_col, text_col, tokenizer, end_id, capacity))
    return pack_pieces(pieces, scratch, capacity)
