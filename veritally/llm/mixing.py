"""Mixing sources to target weights by blocks.

The words of a source lie end to end and are cut into blocks of fixed length. Every output shard
has a fixed number of slots; how many of them each source fills is a multinomial draw conditioned
on the totals (a multivariate hypergeometric one), made by halving the range of shards, so that a
shard finds its own counts and its place in every source without the others. Slot j of a source
takes block permutation(j), a keyed permutation of the block numbers that is new in every epoch,
and slots meet blocks in one join on (source, block).
"""

from __future__ import annotations

import functools
import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from veritally.llm.common import WORD, Scratch, bounded_batches

BLOCK_WORDS = 64
SHARD_SLOTS = 4096
MOST_REPEATS = 3.0
WEIGHTS = (1.0, 2.0, 3.0)
SEED = 20240601


def targets(sizes: list[float], weights: list[float], most: float = MOST_REPEATS) -> list[float]:
    """Shares of the total by weight; none above ``most`` times its size, the excess reshared.

    If every source reaches its limit, the targets stay below the total.
    """
    total, out = float(sum(sizes)), [0.0] * len(sizes)
    open_, left = [i for i in range(len(sizes))], float(sum(sizes))
    while open_ and total > 0:
        weight = sum(weights[i] for i in open_)
        over = {i for i in open_ if left * weights[i] / weight > most * sizes[i]}
        if not over:
            for i in open_:
                out[i] = left * weights[i] / weight
            break
        for i in sorted(over):
            out[i] = most * sizes[i]
            left -= out[i]
        open_ = [i for i in open_ if i not in over]
    return out


def draw(rng: np.random.Generator, counts: np.ndarray, slots: int) -> np.ndarray:
    """``slots`` of the ``counts`` slots per source, without replacement."""
    total = int(counts.sum())
    if total < 10**9:
        return rng.multivariate_hypergeometric(counts, slots, method="marginals")
    # Beyond numpy's range the draw is binomial, then moved to the exact sum.
    out = np.minimum(rng.binomial(counts, slots / total), counts)
    while (short := slots - int(out.sum())) != 0:
        room = counts - out if short > 0 else out
        out += np.sign(short) * np.minimum(room, np.ceil(room * (abs(short) / room.sum())).astype(np.int64))
        if abs(slots - int(out.sum())) < len(out):
            for i in np.argsort(-counts):
                step = min(max(slots - int(out.sum()), -int(out[i])), int(counts[i] - out[i]))
                out[i] += step
    return out


def shard_counts(counts: np.ndarray, slots: int, shard: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(slots of each source before this shard, slots of each source in it)."""
    low, high = 0, max(1, math.ceil(int(counts.sum()) / slots))
    here, before = counts.astype(np.int64), np.zeros(len(counts), np.int64)
    while high - low > 1:
        mid = (low + high) // 2
        left = draw(np.random.default_rng([seed, low, high]), here, min((mid - low) * slots, int(here.sum())))
        if shard < mid:
            here, high = left, mid
        else:
            before, here, low = before + left, here - left, mid
    return before, here


def permuted(index: np.ndarray, size: int, key: int) -> np.ndarray:
    """A keyed permutation of 0..size-1: a Feistel network walked until it falls in the range."""
    half = max(1, ((size - 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    rounds = np.random.default_rng(key).integers(0, 1 << 63, 4, dtype=np.uint64)
    out, wait = index.astype(np.uint64), np.ones(len(index), dtype=bool)
    while wait.any():
        x = out[wait]
        left, right = x >> np.uint64(half), x & mask
        for r in rounds:
            f = (right + r) * np.uint64(0x9E3779B97F4A7C15)
            f ^= f >> np.uint64(29)
            f *= np.uint64(0xBF58476D1CE4E5B9)
            left, right = right, left ^ ((f >> np.uint64(32)) & mask)
        out[wait] = (left << np.uint64(half)) | right
        wait = out >= np.uint64(size)
    return out.astype(np.int64)


def slot_blocks(shards, counts, blocks, slots, seed):
    """Rows (shard, slot, source_no, block) of each shard in ``shards``."""
    import pyarrow as pa

    counts, blocks = np.array(counts, np.int64), np.array(blocks, np.int64)
    for batch in shards:
        for shard in batch.column(0).to_pylist():
            before, here = shard_counts(counts, slots, shard, seed)
            source = np.repeat(np.arange(len(here)), here)
            at = np.arange(len(source)) - np.repeat(np.cumsum(here) - here, here) + np.repeat(before, here)
            block = np.empty(len(source), np.int64)
            for s in np.flatnonzero(here):
                rows = np.flatnonzero(source == s)
                epoch = at[rows] // blocks[s]
                for e in np.unique(epoch):
                    some = rows[epoch == e]
                    block[some] = permuted(at[some] % blocks[s], int(blocks[s]), [seed, int(s), int(e)])
            order = np.random.default_rng([seed, shard, 7]).permutation(len(source))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(source), shard, np.int64)),
                    pa.array(np.arange(len(source), dtype=np.int64)),
                    pa.array(source[order].astype(np.int32)),
                    pa.array(block[order]),
                ],
                names=["shard", "slot", "source_no", "block"],
            )


class Mix:
    """The parts of a mix: ``docs`` with spans, ``slots`` of the output, and ``taken`` per document."""

    def __init__(self, docs: DataFrame, slots: DataFrame, block_words: int):
        self.docs, self.slots, self.block_words = docs, slots, block_words

    def draws(self) -> DataFrame:
        """(source_no, block, copies): how often the mix takes each block."""
        return self.slots.groupBy("source_no", "block").agg(F.count("*").alias("copies"))

    def pieces(self) -> DataFrame:
        """Documents cut at block borders: source_no, start, doc_id, size, block, from, words."""
        length = self.block_words
        rows = self.docs.filter("size > 0").select("doc_id", "size", "source_no", "start")
        last = F.expr(f"(start + size - 1) div {length}")
        rows = rows.select("*", F.explode(F.sequence(F.expr(f"start div {length}"), last)).alias("block"))
        begin = F.greatest(F.col("start"), F.col("block") * length)
        end = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * length)
        return rows.select("*", (begin - F.col("start")).alias("from_word"), (end - begin).alias("words"))

    def taken_pieces(self) -> DataFrame:
        # The draws come from few numbers of shards, from which Spark would guess them to be small.
        return self.pieces().hint("merge").join(self.draws(), ["source_no", "block"])

    def taken(self) -> DataFrame:
        """doc_id, size, source_size, target, taken of every document."""
        sums = (
            self.taken_pieces()
            .groupBy("source_no", "start", "doc_id", "size")
            .agg(F.sum(F.col("words") * F.col("copies")).alias("taken"))
        )
        full = self.docs.filter("size > 0").select("doc_id", "size", "source_size", "target", "source_no", "start")
        key = ["source_no", "start"]  # no two non-empty documents of a source begin at one word
        some = full.join(sums.select(*key, "taken"), key, "left")
        none = self.docs.filter("size = 0").withColumn("taken", F.lit(0).cast("long"))
        columns = ["doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken")]
        return some.select(*columns).unionByName(none.select(*columns))


def mix_sources(
    docs: DataFrame,
    scratch: Scratch,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[float, ...] = WEIGHTS,
    most_repeats: float = MOST_REPEATS,
    block_words: int = BLOCK_WORDS,
    shard_slots: int = SHARD_SLOTS,
    seed: int = SEED,
) -> Mix:
    """Plan a mix whose total is that of ``docs``, in words.

    Sources stand in code-point order, null last, with ``weights`` repeating. The number of slots
    of a source is its target in blocks, at most ``most_repeats`` times its blocks, so that no
    block, and no document, is taken more often than that. The words taken miss the target by
    less than one block. The same rows give the same mix. Null and empty texts have size 0 and
    nothing taken; repeated rows are documents of their own; a table without words gives targets
    of 0. The driver and every task hold three numbers for each source, whatever their number.
    """
    spark = docs.sparkSession
    size = F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(WORD)).cast("long")
    # Many rows may share an id, or have none: their texts tell them apart.
    mark = F.xxhash64(F.col(id_col), F.col(text_col)).alias("_mark")
    sized = scratch.table(
        docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), size.alias("size"), mark)
    )
    found = (
        sized.groupBy("source")
        .agg(F.sum("size").alias("size"), F.count("*").alias("n"))
        .orderBy(F.asc_nulls_last("source"))
        .toArrow()
        .to_pydict()
    )
    sizes = found["size"]
    wanted = targets(sizes, [weights[i % len(weights)] for i in range(len(sizes))], most_repeats)
    blocks = [math.ceil(s / block_words) for s in sizes]
    counts = [
        min(round(t * b / s), math.floor(most_repeats * b)) if s else 0
        for t, b, s in zip(wanted, blocks, sizes, strict=True)
    ]
    table = spark.createDataFrame(
        list(zip(found["source"], range(len(sizes)), sizes, wanted, strict=True)),
        "_source string, source_no int, source_size long, target double",
    )
    table = scratch.table(table)  # stored, so that Spark knows its size and how to join it
    # Words before each document: within hash chunks of a source, plus the chunks before.
    parts = math.isqrt(sum(found["n"])) + 1
    rows = sized.join(table, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    rows = rows.withColumn("_part", F.pmod(F.col("_mark"), F.lit(parts)))
    per_part = rows.groupBy("source_no", "_part").agg(F.sum("size").alias("_sum"))
    earlier = Window.partitionBy("source_no").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    base = per_part.select(
        F.col("source_no").alias("_no"),
        F.col("_part").alias("_of"),
        F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_base"),
    )
    inside = Window.partitionBy("source_no", "_part").orderBy("doc_id", "_mark", "size")
    inside = inside.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_before", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    rows = rows.join(base, (F.col("source_no") == F.col("_no")) & (F.col("_part") == F.col("_of")))
    placed = scratch.table(
        rows.select(
            "doc_id", "source", "size", "source_size", "target", "source_no",
            (F.col("_base") + F.col("_before")).alias("start"),
        )
    )
    shards = max(1, math.ceil(sum(counts) / shard_slots))
    make = functools.partial(slot_blocks, counts=counts, blocks=blocks, slots=shard_slots, seed=seed)
    numbers = spark.range(0, shards if sum(counts) else 0, 1, min(shards, 10_000))
    slots = numbers.mapInArrow(make, "shard long, slot long, source_no int, block long")
    return Mix(placed, slots, block_words)


CUT_BYTES = 1 << 20  # of text that leaves a task at once


def cut_words(batches):
    """Rows of a document for every time that it is taken: the words of the blocks drawn that often."""
    import re

    import pyarrow as pa

    word = re.compile(WORD)
    kinds = {"doc_id": pa.int64(), "text": pa.string(), "lang": pa.string(), "source": pa.string(), "n_chars": pa.int64()}

    def packed(rows):
        columns = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds.values(), strict=True)], names=list(kinds))

    rows, held = [], 0
    for batch in batches:
        for at in range(batch.num_rows):
            doc_id, text, lang, source, spans = (c[at].as_py() for c in batch.columns)
            spans = sorted((s["from_word"], s["words"], s["copies"]) for s in spans)
            places = [m.span() for m in word.finditer(text)]
            for time in range(max(c for _, _, c in spans)):
                runs: list[list[int]] = []
                for first, words, copies in spans:
                    if copies > time:
                        if runs and runs[-1][1] == first:
                            runs[-1][1] += words
                        else:
                            runs.append([first, first + words])
                taken = "\n".join(text[places[a][0] : places[b - 1][1]] for a, b in runs)
                rows.append((doc_id, taken, lang, source, len(taken)))
                held += len(taken)
                if held >= CUT_BYTES:
                    yield packed(rows)
                    rows, held = [], 0
    if rows:
        yield packed(rows)
    pa.default_memory_pool().release_unused()


def mixed_documents(docs: DataFrame, scratch: Scratch, **options) -> DataFrame:
    """doc_id, text, lang, source, n_chars: the words of the mix, as parts of their documents.

    A row whose blocks are drawn up to n times gives n rows with its id; the i-th has the words of
    the blocks drawn at least i times, runs of them joined by a line feed. ``docs`` has those
    columns; every row is a document of its own, also where an id is repeated or null. Rows
    without words, null texts among them, have nothing to be taken.
    """
    bounded_batches(docs.sparkSession)
    # Numbered once and stored, so that both readings agree on the numbers.
    numbered = docs.select("doc_id", "text", "lang", "source").withColumn("_row", F.monotonically_increasing_id())
    numbered = scratch.table(numbered)
    plan = mix_sources(numbered, scratch, id_col="_row", **options)
    span = F.struct("from_word", "words", "copies")
    spans = plan.taken_pieces().groupBy(F.col("doc_id").alias("_of")).agg(F.collect_list(span).alias("spans"))
    rows = numbered.hint("merge").join(spans, F.col("_row") == F.col("_of"))
    kind = "doc_id long, text string, lang string, source string, n_chars long"
    return rows.select("doc_id", "text", "lang", "source", "spans").mapInArrow(cut_words, kind)
