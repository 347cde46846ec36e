"""Repeated passages by a sparse suffix array.

Of the suffixes of a text, in words, only those stay that begin at a minimiser: the run of
``GRAM`` words with the least hash in some window of ``WINDOW`` successive runs. The choice depends
on content alone, so two texts that share ``GRAM + WINDOW - 1`` = 50 words hold the same minimiser
in them. Suffixes whose first run occurs only once are dropped by a bitmap of fixed size. The
others are sorted over the cluster, and neighbours are compared to the right, over the ``WINDOW``
words that hold the next minimiser they share, if they share more. The same in the order of their
reversed left contexts gives the longest match to the left. What the matches of a text cover together is cut where a run of ``GRAM`` words has no
other place, and pieces of at least ``LEAST`` words are the result.

What can be removed is decided run by run: every run of ``GRAM + WINDOW - 1`` words has one
minimiser, and where that occurs elsewhere, the run's hash tells the smallest document that holds
it. There its words stay; in the others they can go, unless a run that must stay has them too.

Contexts hold 32-bit hashes of words, and no text moves.
"""

from __future__ import annotations

import functools

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from veritally.llm.common import (
    Scratch,
    bitmap_of,
    bounded_batches,
    grams_of,
    row_blocks,
    text_buffer,
    with_bit,
    words_of,
)

GRAM = 25
WINDOW = 26
LEAST = 50
KEY_BITS = 1 << 26  # 8 MiB


def window_minimisers(grams: np.ndarray, first: int, last: int, window: int) -> np.ndarray:
    """Place in ``first..last`` of the leftmost least gram of every window, in the order of the windows."""
    if last - first < window:
        return np.zeros(0, np.int64)
    views = np.lib.stride_tricks.sliding_window_view(grams[first:last], window)
    return views.argmin(axis=1) + np.arange(first, last - window + 1)


def minimisers(grams: np.ndarray, first: int, last: int, window: int) -> np.ndarray:
    """Places in ``first..last`` of the leftmost least gram of every window."""
    return np.unique(window_minimisers(grams, first, last, window))


def sparse_suffixes(batches, gram: int, window: int, keys_only: bool):
    """Retained suffixes: key, and with ``keys_only`` unset doc_id, place, left and right contexts."""
    import pyarrow as pa

    names = ["key"] if keys_only else ["key", "doc_id", "place", "before", "after"]
    for batch in batches:
        data, bounds = text_buffer(batch.column(1))
        ids = batch.column(0).to_pylist()
        for first, last in row_blocks(bounds):
            words, word_bounds, _, _ = words_of(data, bounds, first, last)
            grams = grams_of(words, gram)
            small = (words >> np.uint64(32)).astype(">u4")
            out = ([], [], [], [], [])
            for k in range(last - first):
                a, b = int(word_bounds[k]), int(word_bounds[k + 1])
                places = minimisers(grams, a, b - gram + 1, window)
                if not len(places):
                    continue
                out[0].append(grams[places].view(np.int64))
                if keys_only:
                    continue
                out[1].extend([ids[first + k]] * len(places))
                out[2].append(places - a)
                for place in places.tolist():
                    out[3].append(small[max(a, place - window) : place][::-1].tobytes())  # nearest word first
                    out[4].append(small[place + gram : min(b, place + gram + window)].tobytes())
            if not out[0]:
                continue
            columns = [pa.array(np.concatenate(out[0]))]
            if not keys_only:
                columns += [pa.array(out[1], pa.int64()), pa.array(np.concatenate(out[2]))]
                columns += [pa.array(out[3], pa.binary()), pa.array(out[4], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=names)


SUFFIX = "key long, doc_id long, place long, before binary, after binary"


def common_words(x: bytes, y: bytes) -> int:
    n = min(len(x), len(y)) // 4
    if x[: 4 * n] == y[: 4 * n]:
        return n
    a, b = np.frombuffer(x, np.uint32, n), np.frombuffer(y, np.uint32, n)
    return int((a != b).argmax())


def match(x, y, gram: int, side: str):
    """Both ends of the match of two suffixes with one key: (doc_id, start, end, other)."""
    more = common_words(x[3], y[3])
    left, right = (more, gram) if side == "before" else (0, gram + more)
    return (x[1], x[2] - left, x[2] + right, y[1]), (y[1], y[2] - left, y[2] + right, x[1])


FIELDS = ("key", "doc_id", "place", "context")


def compare_neighbours(batches, gram: int, side: str):
    """Matches of neighbours within a partition; its first and last suffix, for the stitching, as edges."""
    import pyarrow as pa
    from pyspark import TaskContext

    part, previous, first = TaskContext.get().partitionId(), None, None
    suffix = pa.struct(list(zip(FIELDS, [pa.int64()] * 3 + [pa.binary()], strict=True)))
    kinds = [pa.int64()] * 4 + [pa.int32(), suffix]
    names = ["doc_id", "start", "end", "other", "edge", "suffix"]

    def rows(found):
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*found, strict=True), kinds, strict=True)], names=names
        )

    for batch in batches:
        found = []
        for current in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if previous is not None and previous[0] == current[0]:
                found += [(*m, None, None) for m in match(previous, current, gram, side)]
            first = first or current
            previous = current
        if found:
            yield rows(found)
    if first:
        yield rows([(None,) * 4 + (2 * part + k, dict(zip(FIELDS, x, strict=True))) for k, x in enumerate((first, previous))])


MATCH = "doc_id long, start long, end long, other long, edge int, suffix struct<key:long,doc_id:long,place:long,context:binary>"


def neighbour_matches(suffixes: DataFrame, side: str, gram: int, scratch: Scratch) -> DataFrame:
    """Matches of neighbours in the order of the contexts on one side; a key may fill any number of partitions."""
    rows = suffixes.select("key", "doc_id", "place", F.col(side).alias("context"))
    order = ["key", "context", "doc_id", "place"]
    sorted_ = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    found = scratch.table(sorted_.mapInArrow(functools.partial(compare_neighbours, gram=gram, side=side), MATCH))
    # Two rows for each partition meet on the driver.
    edges = sorted(found.filter("edge is not null").select("edge", "suffix").collect(), key=lambda r: r["edge"])
    between = []
    for x, y in zip(edges[1::2], edges[2::2], strict=False):
        if x["suffix"]["key"] == y["suffix"]["key"]:
            between += match(tuple(x["suffix"]), tuple(y["suffix"]), gram, side)
    matches = found.filter("edge is null").select("doc_id", "start", "end", "other")
    spark = suffixes.sparkSession
    return matches.unionByName(spark.createDataFrame(between, "doc_id long, start long, end long, other long"))


# ---- what can be removed ----


def whole_runs(batches, gram: int, window: int):
    """Per retained suffix: key, doc_id, start and hashes of the successive runs whose minimiser it is."""
    import pyarrow as pa

    for batch in batches:
        data, bounds = text_buffer(batch.column(1))
        ids = batch.column(0).to_pylist()
        for first, last in row_blocks(bounds):
            words, word_bounds, _, _ = words_of(data, bounds, first, last)
            grams, runs = grams_of(words, gram), grams_of(words, gram + window - 1).view(np.int64)
            keys, docs, starts, lengths, hashes = [], [], [], [], []
            for k in range(last - first):
                a, b = int(word_bounds[k]), int(word_bounds[k + 1])
                places = window_minimisers(grams, a, b - gram + 1, window)
                if not len(places):
                    continue
                # The minimiser never moves back, so the runs of one are successive.
                cuts = np.flatnonzero(np.concatenate([[True], places[1:] != places[:-1]]))
                keys.append(grams[places[cuts]].view(np.int64))
                docs.extend([ids[first + k]] * len(cuts))
                starts.append(cuts)
                lengths.append(np.diff(np.append(cuts, len(places))))
                hashes.append(runs[a : a + len(places)])
            if not keys:
                continue
            ends = np.concatenate([[0], np.cumsum(np.concatenate(lengths))]).astype(np.int32)
            listed = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(hashes)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(keys)), pa.array(docs, pa.int64()), pa.array(np.concatenate(starts)), listed],
                names=["key", "doc_id", "start", "runs"],
            )


RUNS = "key long, doc_id long, start long, runs array<long>"


def removable_stretches(doc: np.ndarray, start: np.ndarray, holder: np.ndarray, run: int, least: int):
    """(doc, start, end, least holder) of the words in runs with a smaller holder and in no other run.

    Rows are sorted by document and start, and documents are whole.
    """
    ids, number = np.unique(doc, return_inverse=True)
    wide = int(start.max(initial=0)) + run + 1
    at = number * wide + start
    goes = holder < doc
    points = np.unique(np.concatenate([at, at + run]))
    # Runs that begin in the last ``run`` words before a point cover the words from there to the next.
    inside = []
    for some in (at[goes], at[~goes]):
        inside.append(np.searchsorted(some, points, side="right") - np.searchsorted(some, points - run, side="right"))
    free = (inside[0] > 0) & (inside[1] == 0)
    change = np.diff(np.concatenate([[False], free, [False]]).astype(np.int8))
    begins, ends = points[np.flatnonzero(change == 1)], points[np.flatnonzero(change == -1)]
    some = ends - begins >= least
    begins, ends = begins[some], ends[some]
    low = np.searchsorted(at[goes], begins - run, side="right")
    high = np.searchsorted(at[goes], ends)
    least_holder = [int(holder[goes][x:y].min()) for x, y in zip(low, high, strict=True)]
    return ids[begins // wide], begins % wide, (ends - 1) % wide + 1, np.array(least_holder, np.int64)


def cut_stretches(batches, run: int, least: int):
    """``removable_stretches`` of a partition sorted by document and start; no document is cut by a batch."""
    import pyarrow as pa

    def rows(parts):
        made = removable_stretches(*(np.concatenate(p) for p in zip(*parts, strict=True)), run, least)
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in made], names=["doc_id", "start_word", "_end", "other"])

    held = []
    for batch in batches:
        columns = [c.to_numpy() for c in batch.columns]
        if not batch.num_rows:
            continue
        last = int(np.searchsorted(columns[0], columns[0][-1]))  # of the last document, more may follow
        if last or (held and held[-1][0][-1] != columns[0][0]):
            yield rows(held + [tuple(c[:last] for c in columns)])
            held = []
        held.append(tuple(c[last:] for c in columns))
    if held:
        yield rows(held)


def removable_parts(rows: DataFrame, several: DataFrame, gram: int, window: int, least: int, scratch: Scratch) -> DataFrame:
    """doc_id, start_word, _end, other: stretches whose removal leaves every repeated run in its smallest document."""
    made = rows.mapInArrow(functools.partial(whole_runs, gram=gram, window=window), RUNS)
    kept = with_bit(made, F.col("key"), several, KEY_BITS, "_in").filter("_in")
    runs = scratch.table(kept.select("doc_id", "start", F.posexplode("runs").alias("k", "run")).selectExpr("run", "doc_id", "start + k as start"))
    first = runs.groupBy("run").agg(F.min("doc_id").alias("holder"), F.count("*").alias("c")).filter("c > 1")
    first = scratch.table(first.select(F.col("run").alias("_run"), "holder"))
    met = runs.join(first.hint("merge"), F.col("run") == F.col("_run")).select("doc_id", "start", "holder")
    sorted_ = met.repartition("doc_id").sortWithinPartitions("doc_id", "start")
    make = functools.partial(cut_stretches, run=gram + window - 1, least=least)
    return sorted_.mapInArrow(make, "doc_id long, start_word long, _end long, other long")


def repeated_passages(
    docs: DataFrame,
    scratch: Scratch,
    id_col: str = "doc_id",
    text_col: str = "text",
    gram: int = GRAM,
    window: int = WINDOW,
    least: int = LEAST,
) -> DataFrame:
    """doc_id, start_word, n_words, other_doc_id, removable: the repeated passages of every document.

    A passage is a longest run of at least ``least`` words all of whose runs of ``gram`` words stand
    elsewhere too, in another document or at another place of its own; every run of
    ``gram + window - 1`` words that occurs twice is in one. Words are separated by ASCII white space
    and compared with A-Z lower-cased; start_word counts from 0. other_doc_id is the smallest
    document that a match was found with, its own only if there is no other. ``removable`` tells
    that all its words stand in runs of ``gram + window - 1`` words that smaller documents hold, and in
    none that this document is the first to hold: when all such passages are removed, every repeated
    run of that length is still whole in the smallest document that held it. A passage that cannot
    go as a whole has one more row for each part of at least ``least`` words that can. Null, empty and short texts give no rows, nor do rows without doc_id; repeated
    rows of one document are a repetition in itself. Other columns are not looked at.
    """
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.filter("doc_id is not null and text is not null")
    make = functools.partial(sparse_suffixes, gram=gram, window=window)
    keys = rows.mapInArrow(functools.partial(make, keys_only=True), "key long")
    several = scratch.table(bitmap_of(keys.groupBy("key").count().filter("count > 1"), "key", KEY_BITS))
    every = rows.mapInArrow(functools.partial(make, keys_only=False), SUFFIX)
    suffixes = scratch.table(with_bit(every, F.col("key"), several, KEY_BITS, "_in").filter("_in").drop("_in"))
    matches = neighbour_matches(suffixes, "after", gram, scratch)
    matches = matches.unionByName(neighbour_matches(suffixes, "before", gram, scratch))
    # Islands: a match begins a new one unless it shares a run of gram - 1 words with those before.
    spans = matches.groupBy("doc_id", "start", "end").agg(
        F.min(F.when(F.col("other") != F.col("doc_id"), F.col("other"))).alias("other")
    )
    order = Window.partitionBy("doc_id").orderBy("start", "end")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.when(F.col("start") > reach - (gram - 1), 1).otherwise(0)
    islands = spans.withColumn("_begins", begins).withColumn("_island", F.sum("_begins").over(order))
    found = islands.groupBy("doc_id", "_island").agg(
        F.min("start").alias("start_word"), F.max("end").alias("_end"), F.min("other").alias("other")
    )
    parts = removable_parts(rows, several, gram, window, least, scratch)
    found = found.withColumn("removable", F.lit(False)).select("doc_id", "start_word", "_end", "other", "removable")
    found = found.unionByName(parts.withColumn("removable", F.lit(True))).groupBy("doc_id", "start_word", "_end")
    found = found.agg(F.min("other").alias("other"), F.max("removable").alias("removable"))
    length = F.col("_end") - F.col("start_word")
    return found.filter(length >= least).select(
        "doc_id",
        "start_word",
        length.alias("n_words"),
        F.coalesce("other", "doc_id").alias("other_doc_id"),
        "removable",
    )
