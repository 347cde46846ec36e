"""Language identification with a bidirectional gated recurrent network over bytes.

The network is trained in numpy by backpropagation through time, on the driver, on windows of a
bounded sample of labelled texts. To predict, every text is cut into windows of ``WINDOW`` bytes;
both directions run over all windows of a block of texts at once, every byte gets a distribution
over languages, and a document has the mean of its bytes'. States start from zero in each window,
and windows overlap by ``CONTEXT`` bytes on either side that are read but not counted, so that no
position is judged from its window's edge alone.
"""

from __future__ import annotations

import functools
import json

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veritally.llm.common import bounded_batches, row_blocks, text_buffer

WINDOW = 120
CONTEXT = 4
HIDDEN = 8
SAMPLE_DOCS = 600  # per language, about, at most; chosen by a hash of id and text
SAMPLE_TOTAL = 38_400  # of all languages; with many, each has fewer
LEAST_SAMPLE = 32  # per language, whatever their number
SAMPLE_WINDOWS = 4  # per document, at most
UNITS_FOR = 16  # languages that HIDDEN units and STEPS steps suffice for
MORE_UNITS, MORE_STEPS, MOST_UNITS = 4, 40, 64  # for each further UNITS_FOR languages
STEPS = 200
BATCH = 160
RATE = 0.02
SEED = 11
UNKNOWN = "und"
PAD = 256  # symbol before the first and after the last byte of a text


def held_out(id_col: str) -> Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1


# ---- the network: columns are windows, rows are units ----


def initial(languages: int, hidden: int, seed: int) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    make = {}
    for side in "fb":
        make["e" + side] = rng.normal(0, 0.3, (PAD + 1, 3 * hidden))  # byte to gate inputs
        make["u" + side] = rng.normal(0, 0.3, (3 * hidden, hidden))
        make["c" + side] = np.zeros((hidden, 1))
    make["w"] = rng.normal(0, 0.3, (languages, 2 * hidden))
    make["o"] = np.zeros((languages, 1))
    return {k: v.astype(np.float32) for k, v in make.items()}


def run(weights, side: str, symbols: np.ndarray, keep: bool = False):
    """States after every position, (time, hidden, windows); with ``keep`` also the gates.

    Gates are linear between 0 and 1, new states x / (1 + |x|): both are several times cheaper
    than their smooth kin and as accurate here.
    """
    steps, count = symbols.shape
    hidden = weights["u" + side].shape[1]
    table, u, c = weights["e" + side], weights["u" + side], weights["c" + side]
    # Gate inputs come scaled, so that a gate is a clipped sum.
    scale = np.repeat(np.float32([0.25, 1.0]), [2 * hidden, hidden])[:, None]
    shift = np.repeat(np.float32([0.5, 0.0]), [2 * hidden, hidden])[:, None]
    columns = np.ascontiguousarray(table.T * scale + shift)
    gate_u, new_u = np.ascontiguousarray(u[: 2 * hidden] * scale[0]), np.ascontiguousarray(u[2 * hidden :])
    states = np.empty((steps, hidden, count), np.float32)
    x, a = np.empty((3 * hidden, count), np.float32), np.empty((hidden, count), np.float32)
    gates, news, inner = [], [], []
    h = np.zeros((hidden, count), np.float32)
    for t in range(steps) if side == "f" else range(steps - 1, -1, -1):
        columns.take(symbols[t], axis=1, out=x, mode="clip")
        g = gate_u @ h
        g += x[: 2 * hidden]
        np.clip(g, 0.0, 1.0, out=g)
        if keep:
            a = np.empty_like(a)
        np.matmul(new_u, h, out=a)
        a += c
        n = g[hidden:] * a
        n += x[2 * hidden :]
        size = np.abs(n)
        size += 1.0
        n /= size
        if keep:
            gates.append((t, h, g))
            inner.append(a)
            news.append(n)
        new = states[t]
        np.subtract(h, n, out=new)
        new *= g[:hidden]
        new += n
        h = new
    return states, (gates, inner, news)


def logits(weights, forward: np.ndarray, backward: np.ndarray) -> np.ndarray:
    hidden = forward.shape[1]
    return weights["w"][:, :hidden] @ forward + weights["w"][:, hidden:] @ backward + weights["o"]


def softmax(z: np.ndarray) -> np.ndarray:
    z = z - z.max(axis=1, keepdims=True)
    np.exp(z, out=z)
    z /= z.sum(axis=1, keepdims=True)
    return z


def gradients(weights, symbols: np.ndarray, truth: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Mean loss over positions that are no padding, and its gradient through time."""
    real = (symbols != PAD)[:, None, :]
    total = max(1, int(real.sum()))
    kept = {side: run(weights, side, symbols, True) for side in "fb"}
    forward, backward = kept["f"][0], kept["b"][0]
    p = softmax(logits(weights, forward, backward))
    hidden = forward.shape[1]
    rows = np.arange(len(truth))
    loss = -float((np.log(p[:, truth, rows] + 1e-9) * real[:, 0]).sum()) / total
    d = p
    d[:, truth, rows] -= 1
    d *= real / total
    out = {"o": d.sum(axis=(0, 2))[:, None]}
    both = np.concatenate([forward, backward], axis=1)
    out["w"] = np.einsum("tlb,thb->lh", d, both, optimize=True)
    back = np.matmul(weights["w"].T, d)
    for side, part in (("f", back[:, :hidden]), ("b", back[:, hidden:])):
        u = weights["u" + side]
        du, dc = np.zeros_like(u), np.zeros((hidden, 1), np.float32)
        steps, count = symbols.shape
        at_input = np.empty((3 * hidden, steps, count), np.float32)
        dh = np.zeros((hidden, symbols.shape[1]), np.float32)
        gates, inner, news = kept[side][1]
        for (t, h, g), a, n in zip(reversed(gates), reversed(inner), reversed(news), strict=True):
            dh = dh + part[t]
            z, r = g[:hidden], g[hidden:]
            dn = dh * (1 - z) * (1 - np.abs(n)) ** 2
            dz = dh * (h - n) * (0.25 * ((z > 0) & (z < 1)))
            dr = dn * a * (0.25 * ((r > 0) & (r < 1)))
            da = dn * r
            full = np.concatenate([dz, dr, dn])
            at_input[:, t] = full
            du += np.concatenate([dz, dr, da]) @ h.T
            dc += da.sum(axis=1, keepdims=True)
            dh = dh * z + u[: 2 * hidden].T @ full[: 2 * hidden] + u[2 * hidden :].T @ da
        at = symbols.ravel()
        de = np.stack([np.bincount(at, row.ravel(), PAD + 1) for row in at_input], axis=1)
        out["u" + side], out["c" + side], out["e" + side] = du, dc, de
    return loss, out


def train(symbols: np.ndarray, truth: np.ndarray, languages: int, hidden: int = HIDDEN, steps: int = STEPS, seed: int = SEED):
    """Weights fitted with Adam; ``symbols`` is (windows, time), ``truth`` the language number of each."""
    weights = initial(languages, hidden, seed)
    rng = np.random.default_rng(seed)
    first = {k: np.zeros_like(v) for k, v in weights.items()}
    second = {k: np.zeros_like(v) for k, v in weights.items()}
    for step in range(1, steps + 1):
        rows = rng.integers(0, len(truth), min(BATCH, len(truth)))
        _, grads = gradients(weights, np.ascontiguousarray(symbols[rows].T), truth[rows])
        rate = RATE * min(1.0, 2 * (1 - step / (steps + 1)))
        for k, g in grads.items():
            g = np.clip(g, -1, 1)
            first[k] += 0.1 * (g - first[k])
            second[k] += 0.01 * (g * g - second[k])
            move = rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-6)
            weights[k] = (weights[k] - move).astype(np.float32)
    return weights


# ---- windows of whole texts ----


def window_symbols(data: np.ndarray, bounds: np.ndarray, first: int, last: int, window: int, context: int):
    """(symbols of every window with its context, text number of each, counted positions of each)."""
    sizes = np.diff(bounds[first : last + 1])
    per = -(-sizes // window)
    owner = np.repeat(np.arange(last - first), per)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(per) - per, per)
    begin = number * window
    at = begin[:, None] + np.arange(-context, window + context)
    size = sizes[owner][:, None]
    inside = (at >= 0) & (at < size)
    symbols = np.full(at.shape, PAD, np.int16)
    symbols[inside] = data[(bounds[first:last][owner][:, None] + at)[inside]]
    return symbols, owner, np.minimum(window, sizes[owner] - begin)


def pooled(weights, data, bounds, first, last, window: int = WINDOW, context: int = CONTEXT) -> np.ndarray:
    """Mean distribution over the bytes of every text of the block."""
    languages = len(weights["o"])
    sums = np.zeros((last - first, languages))
    symbols, owner, counted = window_symbols(data, bounds, first, last, window, context)
    for at in range(0, len(owner), 2048):
        part = slice(at, at + 2048)
        some = np.ascontiguousarray(symbols[part].T, dtype=np.intp)
        forward, _ = run(weights, "f", some)
        backward, _ = run(weights, "b", some)
        p = softmax(logits(weights, forward[context:-context], backward[context:-context]))
        p *= (np.arange(window)[:, None] < counted[part])[:, None, :]
        per_window = p.sum(axis=0)
        for k in range(languages):
            sums[:, k] += np.bincount(owner[part], per_window[k], last - first)
    total = np.maximum(sums.sum(axis=1, keepdims=True), 1e-9)
    return sums / total


def predict_batches(batches, weights, names):
    import pyarrow as pa

    for batch in batches:
        data, bounds = text_buffer(batch.column(1))
        best, score = [], []
        for first, last in row_blocks(bounds):
            p = pooled(weights, data, bounds, first, last)
            best.append(p.argmax(axis=1))
            score.append(p.max(axis=1))
        which = np.concatenate(best) if best else np.zeros(0, int)
        letters = batch.column(2).to_pylist()
        label = [names[k] if has else UNKNOWN for k, has in zip(which, letters, strict=True)]
        value = np.where(letters, np.concatenate(score) if score else [], 0.0)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(3), pa.array(label, pa.string()), pa.array(value, pa.float64())]
            + batch.columns[4:],
            names=["doc_id", "held_out", "lang_pred", "score", *batch.schema.names[4:]],
        )


def sample_windows(batches, window: int, context: int, most: int):
    """Up to ``most`` windows of every text, spread evenly over it."""
    import pyarrow as pa

    for batch in batches:
        data, bounds = text_buffer(batch.column(1))
        ids, names = batch.column(0).to_pylist(), batch.column(2).to_pylist()
        out, kept_ids, kept_names = [], [], []
        for first, last in row_blocks(bounds):
            symbols, owner, _ = window_symbols(data, bounds, first, last, window, context)
            for k in range(last - first):
                rows = np.flatnonzero(owner == k)
                rows = rows[np.unique(np.linspace(0, len(rows) - 1, min(most, len(rows))).astype(int))] if len(rows) else rows
                out += [symbols[r].tobytes() for r in rows]
                kept_ids += [ids[first + k]] * len(rows)
                kept_names += [names[first + k]] * len(rows)
        yield pa.RecordBatch.from_arrays(
            [pa.array(kept_ids, pa.int64()), pa.array(kept_names, pa.string()), pa.array(out, pa.binary())],
            names=["doc_id", "lang", "symbols"],
        )


class LanguageModel:
    def __init__(self, names: list[str], weights):
        self.names, self.weights = names, weights


def fit(
    labelled: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    sample_docs: int = SAMPLE_DOCS,
    sample_windows_per_doc: int = SAMPLE_WINDOWS,
) -> LanguageModel | None:
    """A network for the languages of ``labelled``; None if no row has a language and a text.

    Every language is learnt, from at most about ``sample_docs`` texts each, fewer where there are
    more than 64 languages, taken by a hash of id and text; a repeated row counts once. Units and
    steps grow with the number of languages. The same rows give the same network.
    """
    spark = labelled.sparkSession
    bounded_batches(spark)
    rows = labelled.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(text_col).cast("string").alias("text"),
        F.col(lang_col).cast("string").alias("lang"),
    ).filter("lang is not null and text is not null and text != '' and doc_id is not null")
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    each = min(sample_docs, max(LEAST_SAMPLE, SAMPLE_TOTAL // max(1, len(counts))))
    # The shares travel as one literal: a join on so few keys would send all texts to few tasks.
    shares = F.from_json(F.lit(json.dumps({lang: min(1.0, each / n) for lang, n in counts.items()})), "map<string,double>")
    share = F.element_at(shares, F.col("lang"))
    some = rows.filter(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 20)) < share * (1 << 20))
    some = some.select("doc_id", "text", "lang").dropDuplicates()
    take = functools.partial(sample_windows, window=WINDOW, context=CONTEXT, most=sample_windows_per_doc)
    found = some.mapInArrow(take, "doc_id long, lang string, symbols binary").toPandas()
    if found.empty:
        return None
    found = found.sort_values(["lang", "doc_id", "symbols"], kind="stable")
    names = sorted(found["lang"].unique())
    symbols = np.frombuffer(b"".join(found["symbols"]), np.int16).reshape(len(found), -1)
    truth = np.searchsorted(names, found["lang"].to_numpy())
    # Languages weigh the same: each is repeated to the size of the largest.
    per = np.bincount(truth)
    rows_of = [np.resize(np.flatnonzero(truth == k), per.max()) for k in range(len(names))]
    order = np.concatenate(rows_of)
    more = (len(names) - 1) // UNITS_FOR
    hidden, steps = min(MOST_UNITS, HIDDEN + MORE_UNITS * more), STEPS + MORE_STEPS * more
    return LanguageModel(names, train(symbols[order], truth[order], len(names), hidden, steps))


def identify(
    docs: DataFrame,
    model: LanguageModel | None,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, lang_pred, score.

    With ``carry``, also a struct of that name with these columns as they are.

    ``und`` with score 0 if the text is null or has no letter, or if there is no model. Only the
    text is an input of the prediction, the whole of it. Repeated rows give repeated rows; other
    columns, whatever their names, are not looked at; an empty table gives an empty result.
    """
    bounded_batches(docs.sparkSession)
    text = F.col(text_col).cast("string")
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        text.alias("text"),
        F.coalesce(text.rlike(r"\p{L}"), F.lit(False)).alias("letters"),
        F.coalesce(held_out(id_col), F.lit(False)).alias("held_out"),
        *([F.struct(*carry).alias("carry")] if carry else []),
    )
    unknown = ["doc_id", "held_out", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score")]
    empty = rows.select(*unknown, *(["carry"] if carry else []))
    if model is None:
        return empty
    make = functools.partial(predict_batches, weights=model.weights, names=model.names)
    return rows.mapInArrow(make, empty.schema)


def train_and_identify(docs: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """``identify`` with a network trained on the rows that are not held out."""
    learn = docs.filter(~F.coalesce(held_out("doc_id"), F.lit(True)))
    return identify(docs, fit(learn), carry=carry)
