"""N-gram Jaccard join by grouped prefixes.

1. Documents with the same shingle set are one class; its smallest id stands for it.
2. Shingles have one global order: rare before frequent, by a counting sketch of fixed size over
   all texts, then by hash. The first ``n - ceil(t * n) + 1`` shingles of a set are its prefix; two
   sets that reach the threshold share a shingle of their prefixes.
3. Representatives that share a minimum under one of a few permutations are compared with two
   leaders: the one with the fewest rare shingles, which in a large group of copies is close to
   the original, and any one. This links nearly all of such a group at a cost linear in its size.
4. The join proper: representatives with equal prefix, size and component are one group. Groups
   that share a prefix shingle, differ in component and pass the length and position filters are
   sifted where they meet by parity signatures, which bound the difference of two sets from below;
   a group of several has no signature there, as its sets differ. Those left are expanded to their members, sifted by longer signatures, and verified on whole sets.

Step 3 loses nothing: step 4 considers every pair of different components. All components follow
from the links of both. Hashes of 58 bits stand for shingles.
"""

from __future__ import annotations

import functools
import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritally.llm.common import (
    BUCKET_BITS,
    Scratch,
    bitmap_of,
    bounded_batches,
    grams_of,
    mixed,
    row_blocks,
    text_buffer,
    with_bit,
    words_of,
)
from veritally.llm.components import components

SHINGLE = 5
PERCENT = 75
CELL_BITS = 21  # of the counting sketch: 2**21 counters
CHUNKS = 16
STARS = 6
BUCKET_POSTINGS = 1_000_000
SIGN_BYTES = 32  # of a signature in a bucket
PART = 1 << 18  # pairs looked at together
LONG_RUN = 64
HOT = 1 << 14  # postings of one shingle on each side of a comparison in one task, about
HOT_BITS = 1 << 24  # of the bitmap of hot shingles
ID_BITS = 1 << 24


# ---- shingles ----


def gram_bounds(words: np.ndarray, bounds: np.ndarray, size: int):
    """(hash of the run of ``size`` words at every word, first and last gram of every text)."""
    grams = grams_of(words, size)
    return grams, bounds[:-1], np.maximum(bounds[1:] - size + 1, bounds[:-1])


def short_text(words: np.ndarray) -> np.ndarray:
    """The one shingle of a text with fewer words than a shingle has."""
    return mixed(grams_of(words, len(words)) + np.uint64(len(words)))


def shingle_sets(data, bounds, first, last, levels, size):
    """Sorted keys of the distinct shingles of every text: level above the upper 58 bits of the hash."""
    words, word_bounds, _, _ = words_of(data, bounds, first, last)
    grams, begins, ends = gram_bounds(words, word_bounds, size)
    keys = order_keys(grams, levels)
    for k in range(last - first):
        a, b = begins[k], ends[k]
        if b > a:
            some = np.sort(keys[a:b])
            yield some[np.concatenate([[True], some[1:] != some[:-1]])]
        elif word_bounds[k + 1] > word_bounds[k]:
            yield order_keys(short_text(words[word_bounds[k] : word_bounds[k + 1]]), levels)
        else:
            yield np.zeros(0, np.uint64)


def order_keys(hashes: np.ndarray, levels: np.ndarray) -> np.ndarray:
    level = levels[(hashes >> np.uint64(64 - CELL_BITS)).astype(np.int64)].astype(np.uint64)
    return (level << np.uint64(58)) | (hashes >> np.uint64(6))


def least_overlap(a, b, percent: int):
    """Smallest overlap of sets of these sizes that reaches the threshold."""
    return -(-percent * (a + b) // (100 + percent))


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1 if n else 0


def reach(sizes, places, percent: int):
    """Size of the largest set that a set can link to if the first shingle they share has this place in it.

    Below its own size, it links to smaller sets only, and their reach must be up to it.
    """
    return (100 + percent) * (sizes - places) // percent - sizes


# ---- the counting sketch ----


def count_cells(batches, size: int):
    import pyarrow as pa

    cells = np.zeros(1 << CELL_BITS, np.int64)
    for batch in batches:
        data, bounds = text_buffer(batch.column(0))
        for first, last in row_blocks(bounds):
            words, word_bounds, _, _ = words_of(data, bounds, first, last)
            grams, begins, ends = gram_bounds(words, word_bounds, size)
            change = np.zeros(len(grams) + 1, np.int32)
            some = ends > begins
            np.add.at(change, begins[some], 1)
            np.add.at(change, ends[some], -1)
            inside = np.cumsum(change[:-1]) > 0
            at = (grams[inside] >> np.uint64(64 - CELL_BITS)).astype(np.int64)
            cells += np.bincount(at, minlength=len(cells))
    if cells.any():
        parts = np.split(cells.astype(np.uint32), CHUNKS)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(CHUNKS), pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary())],
            names=["chunk", "cells"],
        )


def sum_cells(batches):
    import pyarrow as pa

    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for chunk, cells in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            some = np.frombuffer(cells, np.uint32).astype(np.int64)
            sums[chunk] = sums[chunk] + some if chunk in sums else some
    # Saturated sums stay comparable: what is that frequent has the last level anyway.
    out = [np.minimum(s, 0xFFFFFFFF).astype(np.uint32).tobytes() for s in sums.values()]
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(sums), pa.int32()), pa.array(out, pa.binary())], names=["chunk", "cells"]
    )


def shingle_sketch(texts: DataFrame, size: int) -> np.ndarray:
    """Counts of all shingles of all texts in 2**21 cells, whatever the size of the input: the driver holds 16 MiB."""
    kind = "chunk int, cells binary"
    parts = texts.select("text").mapInArrow(functools.partial(count_cells, size=size), kind)
    found = parts.repartition(CHUNKS, "chunk").mapInArrow(sum_cells, kind).collect()
    cells = np.zeros((CHUNKS, (1 << CELL_BITS) // CHUNKS))
    for row in found:
        cells[row["chunk"]] = np.frombuffer(row["cells"], np.uint32)
    return cells.ravel()


def least_level_one(cells: np.ndarray) -> float:
    return 2 * cells.mean() + 16


def levels_of(cells: np.ndarray) -> np.ndarray:
    """Level of every cell: 0 up to twice the mean count, then one more for every doubling.

    Only the order of shingles depends on it, never which pairs link.
    """
    levels = np.floor(np.log2(np.maximum(cells, 1) / least_level_one(cells))) + 1
    return np.maximum(0, levels).astype(np.uint8)


def frequency_levels(texts: DataFrame, size: int) -> np.ndarray:
    return levels_of(shingle_sketch(texts, size))


def first_hot_level(cells: np.ndarray) -> int:
    """The lowest level whose shingles can occur more than ``HOT`` times; those of level k stand in cells below 2**k times the first bound."""
    return max(0, math.ceil(math.log2(HOT / least_level_one(cells))))


# ---- profiles ----


def star_keys(flat: np.ndarray, starts: np.ndarray) -> list[np.ndarray]:
    rng = np.random.default_rng(5)
    out = []
    for _ in range(STARS):
        salt, odd = rng.integers(0, 1 << 63, 2, dtype=np.uint64)
        x = (flat ^ salt) * (odd | np.uint64(1))
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xD6E8FEB86659FD93)
        out.append(np.minimum.reduceat(x, starts).view(np.int64))
    return out


def parity(keys: np.ndarray) -> bytes:
    """Bit i tells whether an odd number of shingles fall on it; about two bits for a shingle."""
    bits = 1 << min(16, max(6, (2 * len(keys) - 1).bit_length()))
    at = (mixed(keys) & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=bits) & 1).astype(np.uint8), bitorder="little").tobytes()


def least_difference(x: np.ndarray, y: np.ndarray) -> int:
    """Shingles in one set only, at least: differing bits, the longer signature folded to the shorter."""
    if len(x) > len(y):
        x, y = y, x
    if len(y) > len(x):
        y = np.bitwise_xor.reduce(y.reshape(-1, len(x)), axis=0)
    return int(np.bitwise_count(x ^ y).sum())


def folded(sign: bytes, width: int) -> bytes:
    """A signature at ``width`` bytes, a power of two no longer than it."""
    return np.bitwise_xor.reduce(np.frombuffer(sign, np.uint8).reshape(-1, width), axis=0).tobytes()


def least_differences(words: np.ndarray, starts: np.ndarray, wide: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """``least_difference`` of many pairs of signatures that lie end to end in ``words``."""
    out = np.zeros(len(i), np.int64)
    both = wide[i] * (int(wide.max(initial=0)) + 1) + wide[j]
    for kind in np.unique(both):
        rows = np.flatnonzero(both == kind)
        narrow = min(wide[i[rows[0]]], wide[j[rows[0]]])
        if not narrow:  # without a signature nothing is known
            continue
        sides = []
        for end in (i[rows], j[rows]):
            some = words[starts[end][:, None] + np.arange(wide[end[0]])]
            sides.append(np.bitwise_xor.reduce(some.reshape(len(rows), -1, narrow), axis=1))
        out[rows] = np.bitwise_count(sides[0] ^ sides[1]).sum(axis=1)
    return out


def profiles(batches, levels, size: int, percent: int):
    """Per text: size of its set, rare shingles, hashes of the set and of its prefix, minima, prefix, signature."""
    import pyarrow as pa

    for batch in batches:
        data, bounds = text_buffer(batch.column(1))
        n, rare, prefix, parts, signs = [], [], [], [], []
        for first, last in row_blocks(bounds):
            for keys in shingle_sets(data, bounds, first, last, levels.value, size):
                n.append(len(keys))
                rare.append(int(np.searchsorted(keys, np.uint64(1 << 58))))
                prefix.append(keys[: prefix_length(len(keys), percent)].tobytes())
                parts.append(keys)
                signs.append(parity(keys))
        n = np.array(n, np.int64)
        full = n > 0
        columns = [np.zeros(len(n), np.int64) for _ in range(3 + STARS)]
        if full.any():
            flat = np.concatenate(parts)
            starts = (np.cumsum(n) - n)[full]
            sizes = mixed(n[full].astype(np.uint64))
            columns[0][full] = (np.add.reduceat(mixed(flat), starts) + sizes).view(np.int64)
            columns[1][full] = np.add.reduceat(mixed(flat ^ np.uint64(0x5851F42D4C957F2D)), starts).view(np.int64)
            wide = np.array([len(p) // 8 for p in prefix], np.int64)[full]
            head = mixed(np.frombuffer(b"".join(prefix), np.uint64))
            columns[2][full] = np.add.reduceat(head, np.cumsum(wide) - wide).view(np.int64)
            for k, column in enumerate(star_keys(flat, starts)):
                columns[3 + k][full] = column
        stars = np.stack(columns[3:], axis=1).ravel()
        listed = pa.ListArray.from_arrays(
            pa.array(np.arange(len(n) + 1, dtype=np.int32) * STARS), pa.array(stars)
        )
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n), pa.array(rare, pa.int64()), *(pa.array(c) for c in columns[:3]), listed]
            + [pa.array(prefix, pa.binary()), pa.array(signs, pa.binary())],
            names=["doc_id", "n", "rare", "set_a", "set_b", "prefix_hash", "stars", "prefix", "signature"],
        )


PROFILE = (
    "doc_id long, n long, rare long, set_a long, set_b long, prefix_hash long, "
    "stars array<long>, prefix binary, signature binary"
)


# ---- verification ----


def sift_pairs(batches, percent: int):
    import pyarrow as pa

    for batch in batches:
        sizes = batch.column(2).to_numpy() + batch.column(3).to_numpy()
        room = sizes - 2 * least_overlap(batch.column(2).to_numpy(), batch.column(3).to_numpy(), percent)
        keep = []
        for k in range(batch.num_rows):
            x = np.frombuffer(batch.column(4)[k].as_buffer(), np.uint8)
            y = np.frombuffer(batch.column(5)[k].as_buffer(), np.uint8)
            keep.append(least_difference(x, y) <= room[k])
        yield pa.RecordBatch.from_arrays([c.filter(pa.array(keep, pa.bool_())) for c in batch.columns[:2]], names=["a", "b"])


def sifted(profile: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """The (a, b) of ``pairs`` whose signatures do not rule a link out."""
    sides = [
        profile.select(F.col("doc_id").alias(f"_{s}"), F.col("n").alias(f"n{s}"), F.col("signature").alias(f"s{s}"))
        for s in "ab"
    ]
    both = pairs.join(sides[0].hint("merge"), F.col("a") == F.col("_a"))
    both = both.join(sides[1].hint("merge"), F.col("b") == F.col("_b"))
    make = functools.partial(sift_pairs, percent=percent)
    return both.select("a", "b", "na", "nb", "sa", "sb").mapInArrow(make, "a long, b long").distinct()


def whole_sets(batches, levels, size: int):
    import pyarrow as pa

    for batch in batches:
        data, bounds = text_buffer(batch.column(1))
        sets = []
        for first, last in row_blocks(bounds):
            sets += [s.tobytes() for s in shingle_sets(data, bounds, first, last, levels.value, size)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], names=["doc_id", "keys"])


def check_pairs(batches, percent: int):
    import pyarrow as pa

    for batch in batches:
        a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        keep = []
        for k in range(batch.num_rows):
            x = np.frombuffer(batch.column(2)[k].as_buffer(), np.uint64)
            y = np.frombuffer(batch.column(3)[k].as_buffer(), np.uint64)
            keep.append(len(np.intersect1d(x, y, assume_unique=True)) >= least_overlap(len(x), len(y), percent))
        rows = np.flatnonzero(keep)
        yield pa.RecordBatch.from_arrays(
            [pa.array([a[i] for i in rows], pa.int64()), pa.array([b[i] for i in rows], pa.int64())], names=["a", "b"]
        )


def verified(texts: DataFrame, pairs: DataFrame, levels, size: int, percent: int, scratch: Scratch) -> DataFrame:
    """The (a, b) of ``pairs`` (stored) whose whole sets reach the threshold.

    Sets are made again from the texts at the scan, and move only for documents that a bitmap of
    fixed size marks as part of a pair.
    """
    ends = pairs.select(F.col("a").alias("_id")).unionByName(pairs.select(F.col("b").alias("_id")))
    marked = with_bit(texts, F.col("doc_id"), bitmap_of(ends, "_id", ID_BITS), ID_BITS, "_in").filter("_in")
    make = functools.partial(whole_sets, levels=levels, size=size)
    sets = marked.select("doc_id", "text").mapInArrow(make, "doc_id long, keys binary")
    sets = scratch.table(sets.join(ends.distinct(), F.col("doc_id") == F.col("_id"), "left_semi"))
    one = sets.select(F.col("doc_id").alias("_a"), F.col("keys").alias("x"))
    two = sets.select(F.col("doc_id").alias("_b"), F.col("keys").alias("y"))
    both = pairs.join(one.hint("merge"), F.col("b") == F.col("_a")).join(two.hint("merge"), F.col("a") == F.col("_b"))
    found = both.select("a", "b", "x", "y").mapInArrow(functools.partial(check_pairs, percent=percent), "a long, b long")
    return scratch.table(found.distinct())


# ---- candidates ----


def star_pairs(reps: DataFrame, percent: int) -> DataFrame:
    """Pairs of a representative with the leader of a minimum it shares: at most two for each minimum."""
    rows = reps.select("doc_id", "n", "rare", F.posexplode("stars").alias("k", "key"))
    any_one, own = F.xxhash64("doc_id", "k"), (F.col("doc_id").alias("a"), F.col("n").alias("na"))
    leads = [F.min(F.struct(*by, any_one.alias("r"), *own)).alias(f"lead{i}") for i, by in enumerate(([], ["rare"]))]
    heads = rows.groupBy("k", "key").agg(*leads, F.count("*").alias("c")).filter("c > 1")
    both = F.array_distinct(F.array(*(F.struct(f"lead{i}.a", f"lead{i}.na") for i in (0, 1))))
    heads = heads.select(F.col("k").alias("_k"), F.col("key").alias("_key"), F.inline(both).alias("a", "na"))
    met = rows.join(heads, F.col("key") == F.col("_key")).filter("k = _k and a != doc_id")
    near = met.filter(F.least("n", "na") * 100 >= F.greatest("n", "na") * percent)
    return near.select(F.least("a", "doc_id").alias("a"), F.greatest("a", "doc_id").alias("b")).distinct()


def flat_prefixes(column):
    """(shingles of all prefixes of the column end to end, row of each, place of each in its prefix)."""
    tokens = [np.frombuffer(x.as_buffer(), np.uint64) for x in column]
    length = np.array([len(t) for t in tokens], np.int64)
    flat = np.concatenate([np.zeros(0, np.uint64), *tokens])
    place = np.arange(len(flat)) - np.repeat(np.cumsum(length) - length, length)
    return flat, np.repeat(np.arange(len(length)), length), place


def count_frequent(batches, percent: int, level: int):
    """Per batch and shingle from ``level`` up: its postings, and those that reach their own size."""
    import pyarrow as pa

    for batch in batches:
        flat, owner, place = flat_prefixes(batch.column(1))
        some = np.flatnonzero(flat >= np.uint64(level << 58))
        sizes = batch.column(0).to_numpy()[owner[some]]
        values, inverse = np.unique(flat[some], return_inverse=True)
        early = np.bincount(inverse, reach(sizes, place[some], percent) >= sizes, len(values)).astype(np.int64)
        counts = np.bincount(inverse, minlength=len(values))
        yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(counts), pa.array(early)], names=["token", "c", "early"])


def hot_grids(profile: DataFrame, percent: int, level: int) -> DataFrame:
    """Shingles of more than ``HOT`` postings: (token, rows and columns of its grid of buckets).

    Of two sets that link, the smaller reaches its own size, so that only those rows need comparing
    with all others: they are dealt over the rows of the grid, and all over its columns. A shingle
    without such rows has no bucket. All documents are counted, of which the groups are a part, and
    all shingles from ``level`` up.
    """
    count = functools.partial(count_frequent, percent=percent, level=level)
    made = profile.select("n", "prefix").mapInArrow(count, "token long, c long, early long")
    found = made.groupBy("token").agg(F.sum("c").alias("c"), F.sum("early").alias("early")).filter(F.col("c") > HOT)
    high, wide = (F.ceil(F.col(c) / HOT).cast("long") for c in ("early", "c"))
    return found.select("token", high.alias("high"), wide.alias("wide"))


def hot_bits(grids: DataFrame) -> np.ndarray:
    """A bit for every shingle with a grid, by its last bits: 2 MiB at most, whatever their number.

    Buckets of Spark's bitmaps begin with 1, 32769, and so on; 0 is in a bucket of its own, and here the last bit.
    """
    bits = np.zeros(HOT_BITS >> 3, np.uint8)
    for bucket, held in bitmap_of(grids, "token", HOT_BITS).collect():
        some = np.frombuffer(held, np.uint8)
        at = (bucket - 1) * (BUCKET_BITS >> 3)
        if bucket:
            bits[at : at + len(some)] |= some
        else:
            bits[-1] |= 128
    return bits


def has_bit(flat: np.ndarray, bits: np.ndarray | None) -> np.ndarray:
    if bits is None:
        return np.zeros(len(flat), bool)
    at = ((flat - np.uint64(1)) & np.uint64((len(bits) << 3) - 1)).astype(np.int64)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def plain_bucket(flat: np.ndarray, buckets: int) -> np.ndarray:
    return (mixed(flat) % np.uint64(buckets)).astype(np.int64)


def packed_postings(bucket, at, flat, owner, place, ids, comps, sizes, signs):
    """A batch of ``POSTINGS``: the postings ``at`` of a batch, each in its ``bucket``. ``owner`` is the row of a posting."""
    import pyarrow as pa

    order = np.argsort(bucket, kind="stable")
    bucket, at = bucket[order], at[order]
    cuts = np.append(np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])), len(at))
    wide = np.array([len(s) // 8 for s in signs], np.uint32)
    rows = []
    for begin, end in zip(cuts[:-1], cuts[1:], strict=True):
        some = at[begin:end]
        docs, index = np.unique(owner[some], return_inverse=True)
        made = (ids[docs], comps[docs], sizes[docs], flat[some], index.astype(np.uint32), place[some].astype(np.uint32))
        signed = b"".join([signs[d] for d in docs])
        rows.append((int(bucket[begin]), *(m.tobytes() for m in made), wide[docs].tobytes(), signed))
    names = ["bucket", "ids", "comps", "sizes", "tokens", "owners", "places", "wide", "signs"]
    kinds = [pa.int64()] + [pa.binary()] * 8
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names
    )


def short_signs(column) -> list[bytes]:
    """Signatures in ``SIGN_BYTES`` at most; null gives none."""
    return [folded(s, max(8, min(len(s) // 2, SIGN_BYTES))) if s else b"" for s in column.to_pylist()]


def postings(batches, buckets: int, bits):
    """Prefix shingles of every batch of groups without a bit, packed by bucket, with the group's short signature."""
    for batch in batches:
        flat, owner, place = flat_prefixes(batch.column(3))
        at = np.flatnonzero(~has_bit(flat, bits))
        if len(at):
            columns = [batch.column(i).to_numpy() for i in range(3)]
            bucket = plain_bucket(flat[at], buckets)
            yield packed_postings(bucket, at, flat, owner, place, *columns, short_signs(batch.column(4)))


MARKED = "token long, gid long, comp long, n long, place long, early boolean, sign binary"


def marked_postings(batches, percent: int, bits):
    """Prefix shingles of every batch of groups with a bit, a row each: those with a grid, and a few others."""
    import pyarrow as pa

    for batch in batches:
        flat, owner, place = flat_prefixes(batch.column(3))
        signs = short_signs(batch.column(4))
        some = np.flatnonzero(has_bit(flat, bits))
        for low in range(0, len(some), PART):
            at = some[low : low + PART]
            who = owner[at]
            ids, comps, sizes = (batch.column(i).to_numpy()[who] for i in range(3))
            made = [pa.array(flat[at].view(np.int64)), pa.array(ids), pa.array(comps), pa.array(sizes), pa.array(place[at])]
            made += [pa.array(reach(sizes, place[at], percent) >= sizes), pa.array([signs[w] for w in who], pa.binary())]
            yield pa.RecordBatch.from_arrays(made, names=[c.split()[0] for c in MARKED.split(", ")])


def grid_cells(token, early, salt, high, wide):
    """(posting, cell) of every posting in each cell of its shingle's grid that it belongs to.

    A posting is in all cells of one column, and if ``early`` also in all of one row.
    """
    row = (salt % np.maximum(high, 1).astype(np.uint64)).astype(np.int64)
    column = (mixed(salt ^ np.uint64(0x5851F42D4C957F2D)) % np.maximum(wide, 1).astype(np.uint64)).astype(np.int64)
    who, cells = [], []
    for times, along in ((high, False), (np.where(early & (high > 0), wide, 0), True)):
        some = np.repeat(np.arange(len(token)), times)
        step = np.arange(len(some)) - np.repeat(np.cumsum(times) - times, times)
        if along:
            new = step != column[some]  # there it is already
            some, step = some[new], step[new]
        who.append(some)
        cells.append(row[some] * wide[some] + step if along else step * wide[some] + column[some])
    return np.concatenate(who), np.concatenate(cells)


def dealt_postings(batches, buckets: int):
    """``marked_postings`` with the grid of their shingle, packed by bucket: a cell's is above all plain ones.

    Two cells may get one bucket, which then has pairs of both. A shingle without a grid is in its plain bucket.
    """
    for batch in batches:
        token, ids, comps, sizes, place = (batch.column(i).to_numpy() for i in range(5))
        if not len(token):
            continue
        flat, early = token.view(np.uint64), batch.column(5).to_numpy(zero_copy_only=False)
        signs = batch.column(6).to_pylist()
        hot = batch.column(7).is_valid().to_numpy(zero_copy_only=False)
        high, wide = (batch.column(i).fill_null(0).to_numpy() for i in (7, 8))
        # A hot posting has many buckets: a slice of postings at a time.
        step = max(1, PART // max(1, int((high + wide).max())))
        salt = mixed(ids.astype(np.uint64))
        for low in range(0, len(token), step):
            part = slice(low, low + step)
            who, cell = grid_cells(flat[part], early[part], salt[part], high[part], wide[part])
            key = mixed(flat[part][who] + mixed(cell.astype(np.uint64)))
            plain = np.flatnonzero(~hot[part])
            bucket = np.concatenate([plain_bucket(flat[part][plain], buckets), buckets + (key >> np.uint64(4)).astype(np.int64)])
            at = np.concatenate([plain, who]) + low
            if len(at):
                yield packed_postings(bucket, at, flat, np.arange(len(flat)), place, ids, comps, sizes, signs)


POSTINGS = (
    "bucket long, ids binary, comps binary, sizes binary, tokens binary, owners binary, places binary, "
    "wide binary, signs binary"
)


def run_pairs(comp, starts, lengths, sizes=None, most=None):
    """Index pairs of the same token and different components, at most ``PART`` at a time.

    Rows of a run are sorted by ``sizes``; a row of a long run meets those after it whose size is at most its ``most``.
    """
    sizes, most = (np.zeros(len(comp), np.int64) if x is None else x for x in (sizes, most))
    short = lengths <= LONG_RUN
    for step in range(1, int(lengths[short].max(initial=0))):
        runs = short & (lengths > step)
        first, inner = starts[runs], lengths[runs] - step
        ends = np.cumsum(inner)
        for low in range(0, int(ends[-1]), PART):
            at = np.arange(low, min(low + PART, int(ends[-1])))
            run = np.searchsorted(ends, at, side="right")
            at = first[run] + at - (ends[run] - inner[run])
            yield at, at + step
    for start, length in zip(starts[~short], lengths[~short], strict=True):
        # The rows of the largest component need no comparing with each other.
        rows = np.arange(start, start + length)
        past = start + np.searchsorted(sizes[rows], most[rows], side="right")
        values, inverse, counts = np.unique(comp[rows], return_inverse=True, return_counts=True)
        large = inverse == counts.argmax()
        for some, others in ((~large, rows), (large, rows[~large])):
            first = np.searchsorted(others, rows[some], side="right")
            inner = np.maximum(np.searchsorted(others, past[some]) - first, 0)
            ends = np.cumsum(inner)
            for low in range(0, int(ends[-1]) if len(ends) else 0, PART):
                at = np.arange(low, min(low + PART, int(ends[-1])))
                run = np.searchsorted(ends, at, side="right")
                yield rows[some][run], others[first[run] + at - (ends[run] - inner[run])]


def token_pairs(table, percent: int):
    """Candidate pairs of groups of one bucket that their signatures do not rule out, each once."""
    import pyarrow as pa

    parts, tables, signs, wide, docs = [[], [], []], [[], [], []], [], [], 0
    for row in range(table.num_rows):
        ids, comps, sizes, tokens, owners, places, widths, signed = (
            table.column(i + 1)[row].as_buffer() for i in range(8)
        )
        wide.append(np.frombuffer(widths, np.uint32))
        signs.append(np.frombuffer(signed, np.uint64))
        parts[0].append(np.frombuffer(tokens, np.uint64))
        parts[1].append(np.frombuffer(owners, np.uint32) + np.uint32(docs))
        parts[2].append(np.frombuffer(places, np.uint32))
        for t, raw in zip(tables, (ids, comps, sizes), strict=True):
            t.append(np.frombuffer(raw, np.int64))
        docs += len(tables[0][-1])
    ids, comps, sizes = (np.concatenate(t) for t in tables)
    words, wide = np.concatenate(signs), np.concatenate(wide).astype(np.int64)
    begins = np.cumsum(wide) - wide
    token = np.concatenate(parts[0])
    order = np.lexsort((sizes[np.concatenate(parts[1])], token))
    token = token[order]
    starts = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
    lengths = np.diff(np.append(starts, len(token)))
    own, place = np.concatenate(parts[1])[order], np.concatenate(parts[2])[order].astype(np.int64)
    del parts, order, token
    comp = comps[own]
    mixed_runs = np.minimum.reduceat(comp, starts) != np.maximum.reduceat(comp, starts)
    starts, lengths = starts[mixed_runs], lengths[mixed_runs]
    found, waiting = np.zeros(0, np.int64), []

    def sift():
        new, passed = np.unique(np.concatenate(waiting)), [found]
        for low in range(0, len(new), PART):
            i, j = np.divmod(new[low : low + PART], docs)
            room = sizes[i] + sizes[j] - 2 * least_overlap(sizes[i], sizes[j], percent)
            passed.append(new[low : low + PART][least_differences(words, begins, wide, i, j) <= room])
        return np.unique(np.concatenate(passed))

    for i, j in run_pairs(comp, starts, lengths, sizes[own], reach(sizes[own], place, percent)):
        some = comp[i] != comp[j]
        i, j = i[some], j[some]
        one, two = sizes[own[i]], sizes[own[j]]
        most = np.minimum(one - place[i], two - place[j])  # if this is the first shingle they share
        near = np.minimum(one, two) * 100 >= np.maximum(one, two) * percent
        keep = near & (most >= least_overlap(one, two, percent))
        if keep.any():
            a, b = own[i[keep]].astype(np.int64), own[j[keep]].astype(np.int64)
            waiting.append(np.minimum(a, b) * docs + np.maximum(a, b))
            if sum(map(len, waiting)) > 1_000_000:
                found, waiting = sift(), []
    found = sift() if waiting else found
    a, b = ids[found // max(docs, 1)], ids[found % max(docs, 1)]
    return pa.table({"a": pa.array(np.minimum(a, b)), "b": pa.array(np.maximum(a, b))})


def group_postings(profile: DataFrame, groups: DataFrame, percent: int, scratch: Scratch, level: int = 0) -> DataFrame:
    """The ``POSTINGS`` of the groups and the partition of each bucket, one for a plain bucket.

    Those of a hot shingle are in a grid of buckets, so that no bucket grows with it. The grids are
    a table, which is joined to the postings of shingles that share some bits with a hot one.
    ``groups`` has (gid, comp, c); the prefix of a group is that of the document ``gid``. Only of a
    group of one (c) is the signature of ``gid`` that of every member.
    """
    total = profile.agg(F.sum(F.octet_length("prefix"))).first()[0] or 0
    buckets = max(1, math.ceil(total / 8 / BUCKET_POSTINGS))
    heads = profile.select("doc_id", "n", "prefix", "signature").join(groups.hint("merge"), F.col("doc_id") == F.col("gid"))
    signature = F.when(F.col("c") == 1, F.col("signature")).alias("signature")
    heads = heads.select("gid", "comp", "n", "prefix", signature)
    grids = scratch.table(hot_grids(profile, percent, level))
    cells = grids.agg(F.sum(F.col("high") * F.col("wide"))).first()[0]
    bits = None if cells is None else profile.sparkSession.sparkContext.broadcast(hot_bits(grids))

    def plain(batches):
        return postings(batches, buckets, bits and bits.value)

    def marked(batches):
        return marked_postings(batches, percent, bits.value)

    packed = heads.mapInArrow(plain, POSTINGS)
    if bits:
        met = heads.mapInArrow(marked, MARKED).join(grids.withColumnRenamed("token", "_token"), F.col("token") == F.col("_token"), "left")
        dealt = met.drop("_token").mapInArrow(functools.partial(dealt_postings, buckets=buckets), POSTINGS)
        packed = packed.unionByName(dealt)
    spread = math.ceil((cells or 0) * 2 * HOT / BUCKET_POSTINGS)
    part = F.when(F.col("bucket") < buckets, F.col("bucket")).otherwise(buckets + F.col("bucket") % max(1, spread))
    return packed.withColumn("part", part.cast("int")).repartitionById(buckets + spread, F.col("part"))


def group_pairs(profile: DataFrame, groups: DataFrame, percent: int, scratch: Scratch, level: int = 0) -> DataFrame:
    """Pairs of groups in different components that share a prefix shingle and pass the filters."""

    def join(table):
        return token_pairs(table, percent)

    packed = group_postings(profile, groups, percent, scratch, level)
    return scratch.table(packed.groupBy("bucket", "part").applyInArrow(join, "a long, b long").distinct())


def jaccard_components(
    docs: DataFrame,
    scratch: Scratch,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = SHINGLE,
    percent: int = PERCENT,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id.

    A document's set are its distinct runs of ``size`` words, A-Z lower-cased; with fewer words,
    its whole sequence. Documents link if ``100 * overlap >= percent * union``. component_id is the
    smallest doc_id reachable by links. A null, empty or blank text has 0 shingles and stays
    alone; so does a row without doc_id, whose component is null. Repeated rows of a doc_id are
    one document, and get the same component. Other columns are not looked at; an empty table
    gives an empty result.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    cells = shingle_sketch(texts, size)
    levels = spark.sparkContext.broadcast(levels_of(cells))
    make = functools.partial(profiles, levels=levels, size=size, percent=percent)
    profile = scratch.table(texts.mapInArrow(make, PROFILE))

    full = profile.filter("n > 0 and doc_id is not null")
    classes = full.groupBy("set_a", "set_b", "n", "prefix_hash").agg(
        F.min("doc_id").alias("rep"), F.count("*").alias("members")
    )
    classes = scratch.table(classes)
    chosen = classes.select(F.col("rep").alias("_rep"))
    reps = full.select("doc_id", "n", "rare", "stars").join(chosen, F.col("doc_id") == F.col("_rep"), "left_semi")
    pairs = scratch.table(sifted(profile, star_pairs(reps, percent), percent))
    first = components(verified(texts, pairs, levels, size, percent, scratch), scratch)

    placed = classes.select("rep", "n", "prefix_hash").join(first, F.col("rep") == F.col("node"), "left")
    placed = placed.select("rep", "n", "prefix_hash", F.coalesce("root", "rep").alias("comp"))
    placed = scratch.table(placed)
    grouped = placed.groupBy("n", "prefix_hash", "comp").agg(F.min("rep").alias("gid"), F.count("*").alias("c"))
    grouped = scratch.table(grouped)
    met = group_pairs(profile, grouped.select("gid", "comp", "c"), percent, scratch, first_hot_level(cells))

    # Groups to members; a group of one is its own member and takes no part in these joins.
    several = grouped.filter("c > 1").select("n", F.col("prefix_hash").alias("_hash"), F.col("comp").alias("_comp"), "gid")
    members = placed.join(several, ["n"]).filter("prefix_hash = _hash and comp = _comp").select("gid", "rep")
    members = scratch.table(members)
    one = members.select(F.col("gid").alias("_g"), F.col("rep").alias("_x"))
    two = members.select(F.col("gid").alias("_h"), F.col("rep").alias("_y"))
    wide = met.join(one, F.col("a") == F.col("_g"), "left").select(F.coalesce("_x", "a").alias("a"), "b")
    wide = wide.join(two, F.col("b") == F.col("_h"), "left").select("a", F.coalesce("_y", "b").alias("b"))
    wide = wide.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    rest = scratch.table(sifted(profile, wide, percent))
    links = verified(texts, rest, levels, size, percent, scratch)

    # Links between documents, as links between the components found so far.
    roots = first.select(F.col("node").alias("_node"), "root")
    for end in ("a", "b"):
        links = links.join(roots, F.col(end) == F.col("_node"), "left")
        links = links.withColumn(end, F.coalesce("root", end)).drop("_node", "root")
    second = components(links, scratch).select(F.col("node").alias("_comp"), F.col("root").alias("_root"))
    final = placed.join(second, F.col("comp") == F.col("_comp"), "left")
    final = final.select(F.col("rep").alias("_r"), F.coalesce("_root", "comp").alias("component_id"))
    known = classes.join(final, F.col("rep") == F.col("_r")).filter("members > 1 or rep != component_id")
    known = known.select(F.col("set_a").alias("_a"), F.col("set_b").alias("_b"), "component_id")
    rows = profile.select("doc_id", F.col("n").alias("n_shingles"), "set_a", "set_b")
    met = (F.col("set_a") == F.col("_a")) & (F.col("set_b") == F.col("_b")) & F.col("doc_id").isNotNull()
    out = rows.join(known.hint("merge"), met & (F.col("n_shingles") > 0), "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def drop_near_duplicates(docs: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose document has the smallest id of its component."""
    found = jaccard_components(docs, scratch, id_col, text_col)
    gone = found.filter("doc_id != component_id").select(F.col("doc_id").alias("_gone"))
    return docs.join(gone, F.col(id_col) == F.col("_gone"), "left_anti")
