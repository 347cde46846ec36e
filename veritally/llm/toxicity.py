"""Toxicity by a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

Features are hashed n-grams of 3 to 6 bytes of the text with A-Z in lower case and runs of ASCII
characters that are no letter or digit as one space, so that n-grams see where words begin and end. A feature
counts once in a text. Executors count the texts of each class that hold a feature; the logarithm
of the ratio of the two smoothed shares scales the feature. Features whose ratio is nearer to zero
than ``LEAST_RATIO`` or ``LEAST_Z`` standard errors are left out. A logistic regression over the scaled features
is fitted on the driver, from the feature numbers of a bounded sample of labelled texts. Scoring
reads every whole text once, without a shuffle.
"""

from __future__ import annotations

import functools

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veritally.llm.common import Scratch, bounded_batches, row_blocks, text_buffer

ORDERS = (3, 4, 5, 6)
BUCKET_BITS = 20
SLICE_BITS = 16  # counts travel in slices of 65,536 buckets
SAMPLE_ROWS = 8192  # labelled texts of each class to learn from, about, at most; chosen by a hash of the id
LEAST_Z = 3.0
LEAST_RATIO = 1.0
PENALTY = 1e-4
STEPS = 400
RATE = 0.05
THRESHOLD = 0.3

_FOLD = np.arange(256, dtype=np.uint8)
for _byte in range(128):
    if not chr(_byte).isalnum():
        _FOLD[_byte] = 32
_FOLD[65:91] += 32


def held_out(id_col: str) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


# ---- features ----


def folded(data: np.ndarray, bounds: np.ndarray, first: int, last: int) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row bounds of some texts, each between two spaces and with runs of spaces as one."""
    sizes = np.diff(bounds[first : last + 1]).astype(np.int64)
    edges = np.concatenate([[0], np.cumsum(sizes + 2)])
    out = np.full(edges[-1], 32, np.uint8)
    inside = np.ones(edges[-1], bool)
    inside[edges[:-1]] = False
    inside[edges[1:] - 1] = False
    out[inside] = _FOLD[data[bounds[first] : bounds[last]]]
    keep = out != 32
    keep[1:] |= out[:-1] != 32
    keep[edges[:-1]] = True
    return out[keep], np.concatenate([[0], np.cumsum(keep)])[edges]


def ngrams(text: np.ndarray):
    """(order, bucket of the n-gram at every byte) for each order, also of n-grams that cross texts."""
    rolling = text.astype(np.uint32)
    for order in range(2, max(ORDERS) + 1):
        if len(text) < order:
            return
        rolling = rolling[:-1] * np.uint32(0x01000193) + text[order - 1 :]
        if order in ORDERS:
            mixed = (rolling ^ (rolling >> np.uint32(15))) + np.uint32(order * 0x85EBCA6B & 0xFFFFFFFF)
            yield order, (mixed * np.uint32(0x9E3779B1)) >> np.uint32(32 - BUCKET_BITS)


def present(text: np.ndarray, edges: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of every wanted feature in every text of a block, each once."""
    found = []
    for order, bucket in ngrams(text):
        at = np.flatnonzero(wanted[bucket])
        row = np.searchsorted(edges, at, side="right") - 1
        whole = at + order <= edges[row + 1]
        found.append((row[whole].astype(np.int64) << BUCKET_BITS) | bucket[at[whole]])
    both = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
    return both >> BUCKET_BITS, both & ((1 << BUCKET_BITS) - 1)


# ---- learning ----


def count_classes(batches):
    """Texts of both classes that hold each bucket, as rows of (slice, counts)."""
    import pyarrow as pa

    counts = np.zeros((2, 1 << BUCKET_BITS), np.int32)
    everything = np.ones(1 << BUCKET_BITS, bool)
    for batch in batches:
        data, bounds = text_buffer(batch.column(1))
        toxic = batch.column(0).to_numpy(zero_copy_only=False)
        for first, last in row_blocks(bounds, 1 << 18):
            row, bucket = present(*folded(data, bounds, first, last), everything)
            for kind in (0, 1):
                counts[kind] += np.bincount(bucket[toxic[first:last][row] == kind], minlength=1 << BUCKET_BITS).astype(np.int32)
    if counts.any():
        parts = counts.reshape(2, -1, 1 << SLICE_BITS).transpose(1, 0, 2)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(parts)), pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary())],
            names=["slice", "counts"],
        )


def summed(key, table):
    import pyarrow as pa

    total = np.zeros(2 << SLICE_BITS, np.int64)
    for piece in table.column("counts"):
        total += np.frombuffer(piece.as_buffer(), np.int32)
    return pa.table({"slice": pa.array([key[0].as_py()], pa.int32()), "counts": pa.array([total.tobytes()], pa.binary())})


def wanted_features(batches, chosen: np.ndarray):
    """(id, toxic, places in ``chosen`` of the features a text holds) of every text."""
    import pyarrow as pa

    wanted = np.zeros(1 << BUCKET_BITS, bool)
    wanted[chosen] = True
    for batch in batches:
        data, bounds = text_buffer(batch.column(1))
        lists = []
        for first, last in row_blocks(bounds):
            row, bucket = present(*folded(data, bounds, first, last), wanted)
            lists += np.split(np.searchsorted(chosen, bucket).astype(np.int32), np.searchsorted(row, range(1, last - first)))
        yield pa.RecordBatch.from_arrays(
            [batch.column(2), batch.column(0), pa.array(lists, pa.list_(pa.int32()))], names=["_id", "toxic", "features"]
        )


def log_count_ratios(counts: np.ndarray, totals: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(buckets whose ratio is clear, their log-count ratios) from the texts of class 0 and 1 that hold a bucket."""
    clean, toxic = counts + 1.0
    ratio = np.log(toxic / (totals[1] + 2.0)) - np.log(clean / (totals[0] + 2.0))
    least = np.maximum(LEAST_RATIO, LEAST_Z * np.sqrt(1 / toxic + 1 / clean))
    chosen = np.flatnonzero(np.abs(ratio) >= least)
    return chosen, ratio[chosen]


def logistic(rows: np.ndarray, places: np.ndarray, truth: np.ndarray, ratio: np.ndarray, weight: np.ndarray):
    """(weight of every feature, bias) of the penalised logistic regression over scaled features, by Adam."""
    scaled = ratio[places]
    theta = np.concatenate([np.zeros(len(ratio)), [np.log((weight @ truth + 1) / (weight @ (1 - truth) + 1))]])
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    share = weight / weight.sum()
    for step in range(1, STEPS + 1):
        z = np.bincount(rows, scaled * theta[places], len(truth)) + theta[-1]
        error = share * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - truth)
        grad = np.append(np.bincount(places, scaled * error[rows], len(ratio)) + PENALTY * theta[:-1], error.sum())
        first += 0.1 * (grad - first)
        second += 0.01 * (grad * grad - second)
        rate = RATE * (1 - step / (STEPS + 1))
        theta -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return theta[:-1] * ratio, float(theta[-1])


class ToxicityModel:
    """Buckets, the weight of each, and the bias."""

    def __init__(self, buckets: np.ndarray, weights: np.ndarray, bias: float):
        self.buckets, self.weights, self.bias = buckets, weights, bias


def sampled_rows(docs: DataFrame, labels: DataFrame, scratch: Scratch, id_col, text_col, label_col, sample_rows):
    """(stored toxic and text of the sample, labels of both classes before sampling)."""
    marks = (
        labels.select(F.col(id_col).cast("long").alias("_id"), F.col(label_col).cast("int").alias("toxic"))
        .filter("_id is not null and toxic in (0, 1)")
        .groupBy("_id")
        .agg(F.max("toxic").alias("toxic"))
        .filter(~held_out("_id"))
    )
    found = {r["toxic"]: r["count"] for r in marks.groupBy("toxic").count().collect()}
    totals = np.array([found.get(0, 0), found.get(1, 0)])
    rate = F.element_at(F.array(*[F.lit(min(1.0, sample_rows / max(1, n))) for n in totals.tolist()]), F.col("toxic") + 1)
    # At most about 2 x sample_rows ids and flags: bounded, so safe to broadcast.
    some = F.broadcast(marks.filter(F.pmod(F.xxhash64("_id"), F.lit(1 << 20)) < rate * (1 << 20)))
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("text"))
    one = rows.filter("text is not null").join(some, "_id").groupBy("_id", "toxic").agg(F.min("text").alias("text"))
    return scratch.table(one.select("toxic", "text", "_id")), totals


def fit(
    docs: DataFrame,
    labels: DataFrame,
    scratch: Scratch,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    sample_rows: int = SAMPLE_ROWS,
) -> ToxicityModel:
    """A classifier learnt from the labels of rows that are not held out.

    At most about ``sample_rows`` texts of each class are used, whole, chosen by a hash of the id;
    classes weigh as they do among all labels. An id labelled both ways counts as toxic; of texts
    that share an id the least is used. Labels other than 0 and 1 and labels without a document
    are left out. With one class or none every text gets the same score.
    """
    bounded_batches(docs.sparkSession)
    sample, totals = sampled_rows(docs, labels, scratch, id_col, text_col, label_col, sample_rows)
    parts = sample.mapInArrow(count_classes, "slice int, counts binary")
    slices = parts.groupBy("slice").applyInArrow(summed, "slice int, counts binary").collect()
    counts = np.zeros((2, 1 << BUCKET_BITS), np.int64)
    for part in slices:
        at = part["slice"] << SLICE_BITS
        counts[:, at : at + (1 << SLICE_BITS)] = np.frombuffer(part["counts"], np.int64).reshape(2, -1)
    have = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    used = np.array([have.get(0, 0), have.get(1, 0)])
    base = float(np.log((totals[1] + 1) / (totals[0] + 1)))
    none = ToxicityModel(np.zeros(0, np.int64), np.zeros(0), base)
    if not used.all():
        return none
    chosen, ratio = log_count_ratios(counts, used)
    if not len(chosen):
        return none
    take = functools.partial(wanted_features, chosen=chosen)
    held = sample.mapInArrow(take, "_id long, toxic int, features array<int>").toArrow().sort_by("_id")
    lists = held.column("features").combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy())
    truth = held.column("toxic").to_numpy().astype(float)
    places = lists.flatten().to_numpy()
    rows = np.repeat(np.arange(len(truth)), sizes)
    weights, bias = logistic(rows, places, truth, ratio, (totals / used)[truth.astype(int)])
    return ToxicityModel(chosen, weights, bias)


# ---- scoring ----


def score_batches(batches, model: ToxicityModel, threshold: float):
    import pyarrow as pa

    wanted = np.zeros(1 << BUCKET_BITS, bool)
    wanted[model.buckets] = True
    for batch in batches:
        data, bounds = text_buffer(batch.column(1))
        z = np.full(batch.num_rows, model.bias)
        for first, last in row_blocks(bounds):
            row, bucket = present(*folded(data, bounds, first, last), wanted)
            z[first:last] += np.bincount(row, model.weights[np.searchsorted(model.buckets, bucket)], last - first)
        score = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), pa.array(score), pa.array((score >= threshold).astype(np.int32))],
            names=["doc_id", "held_out", "score", "predicted"],
        )


def score(
    docs: DataFrame,
    model: ToxicityModel,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted.

    Only the text is an input of the score, the whole of it. Null and empty texts hold no feature
    and get the score of the bias. Repeated rows give repeated rows; a null doc_id stays null and
    counts as not held out; an empty table gives an empty result. Other columns are not looked at.
    """
    bounded_batches(docs.sparkSession)
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(text_col).cast("string").alias("text"),
        held_out(id_col).alias("held_out"),
    )
    make = functools.partial(score_batches, model=model, threshold=threshold)
    return rows.mapInArrow(make, "doc_id long, held_out boolean, score double, predicted int")
