"""Exact top-k by inner product over an impact-ordered index, score at a time.

Components are quantised to integers, the impacts. A block of rows keeps its posting segments by
descending magnitude of impact, one segment for every halving. A search adds segment after
segment to the scores of its queries. What is left of a row then adds at most the length of the
query times the length of the row's remaining impacts. A query stops in a block as soon as that
proves that few of its rows can still be among the k best; these are rescored exactly and the
other segments are skipped for it. Without proof all segments are processed, and the scores are
exact already.

Blocks are searched in rounds of 1, 1, 2, 4, 8 ... blocks. A query takes the k-th score of the
rounds before along as its floor, so that a round gives about as many rows as a query keeps,
however many blocks it has.
"""

from __future__ import annotations

import functools
import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from veritally.llm.common import Scratch, bounded_batches

SCALE = 64
K = 20
QUERY_STEP = 20
BLOCK_ROWS = 4096
QUERY_ROWS = 1024  # in a block of queries
TILES = 64  # of blocks and blocks of queries, at least, if there are as many pairs
TILE_SIDE = 8
SEGMENTS = 6
PROVEN = 4  # rescore once at most PROVEN * k rows of a query are possible


def quantised(batches, scale: int):
    """Rows whose vector has only finite components, as packed integers."""
    import pyarrow as pa

    for batch in batches:
        ids, out = [], []
        for key, vector in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            values = vector.values if vector.is_valid else None
            if key is None or values is None or values.null_count:
                continue
            x = values.to_numpy(zero_copy_only=False).astype(np.float64)
            if np.isfinite(x).all():
                x = np.floor(scale * x)
                if len(x) and np.abs(x).max() ** 2 * len(x) >= 2**53:
                    raise ValueError(f"the scores of vector {key} may exceed 2**53")
                ids.append(key)
                out.append(x.astype("<i8").tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(out, pa.binary())], names=["vec_id", "impacts"])


def matrix(packed) -> np.ndarray:
    """Vectors as rows; a shorter one ends in zeros."""
    rows = [np.frombuffer(x.as_buffer(), "<i8") for x in packed]
    out = np.zeros((len(rows), max(map(len, rows), default=0)))
    for row, x in zip(out, rows, strict=True):
        row[: len(x)] = x
    return out


def block_index(table, block: int = 0):
    """Posting segments of a block, (cells, impacts, rest) each, by descending impact."""
    import pyarrow as pa

    rows = matrix(table.column("impacts"))
    ids = table.column("vec_id").to_numpy()
    size, rest = np.abs(rows), rows**2
    top = max(1.0, size.max(initial=0))
    out = []
    for k in range(SEGMENTS):
        low = top / 2 ** (k + 1) if k < SEGMENTS - 1 else 0
        cells = np.flatnonzero((size > low) & (size <= top / 2**k))
        rest.ravel()[cells] = 0
        left = np.sqrt(rest.sum(axis=1))
        out.append((cells.astype("<i4").tobytes(), rows.ravel()[cells].astype("<i8").tobytes(), left.astype("<f8").tobytes()))
    kind = pa.list_(pa.struct([("cells", pa.binary()), ("impacts", pa.binary()), ("rest", pa.binary())]))
    segments = [dict(zip(("cells", "impacts", "rest"), s, strict=True)) for s in out]
    return pa.table(
        {
            "block": pa.array([block], pa.int64()),
            "ids": pa.array([ids.astype("<i8").tobytes()], pa.binary()),
            "width": pa.array([rows.shape[1]], pa.int32()),
            "segments": pa.array([segments], kind),
        }
    )


INDEX = "block long, ids binary, width int, segments array<struct<cells:binary,impacts:binary,rest:binary>>"
QUERIES = "part long, query_ids binary, floors binary, query_width int, queries binary"
FOUND = "query_id long, vec_id long, score long"


def query_block(table, part: int):
    """A block of queries as one row; a null floor is minus infinity."""
    import pyarrow as pa

    rows = matrix(table.column("impacts"))
    floors = table.column("floor").cast(pa.float64()).fill_null(-math.inf).to_numpy()
    packed = [table.column("vec_id").to_numpy().astype("<i8"), floors.astype("<f8"), rows.astype("<f8")]
    ids, floors, queries = (pa.array([x.tobytes()], pa.binary()) for x in packed)
    return pa.table(
        {
            "part": pa.array([part], pa.int64()),
            "query_ids": ids,
            "floors": floors,
            "query_width": pa.array([rows.shape[1]], pa.int32()),
            "queries": queries,
        }
    )


def best_of_block(query, query_ids, floors, ids, segments, k: int):
    """(query row, row, score, segments processed by each query) of the rows of a block that may be
    among the ``k`` best of a query and reach its floor."""
    count, width = len(ids), query.shape[1]
    parts = np.zeros((len(segments), count, width))
    for part, (cells, impacts, _) in zip(parts, segments, strict=True):
        part.ravel()[cells] = impacts
    whole = parts.sum(axis=0)
    length = np.sqrt((query**2).sum(axis=1))[:, None] * (1 + 1e-9)
    active, partial = np.arange(len(query)), np.zeros((len(query), count))
    processed, found = np.zeros(len(query), np.int64), []
    for number, (_, _, rest) in enumerate(segments):
        partial += query[active] @ parts[number].T
        processed[active] += 1
        last = number == len(segments) - 1
        slack = 0.0 if last else length[active] * rest[None, :]
        own = query_ids[active][:, None] == ids[None, :]
        floor, free = floors[active].copy(), np.isneginf(floors[active])
        if free.any() and count > k:
            lower = np.where(own, -np.inf, partial - slack)[free]
            floor[free] = np.partition(lower, count - k, axis=1)[:, count - k]
        possible = (partial + slack >= floor[:, None]) & ~own
        done = last | (possible.sum(axis=1) <= PROVEN * k)
        at, row = np.nonzero(possible & np.reshape(done, (-1, 1)))
        found.append((active[at], row))
        if last or done.all():
            break
        active, partial = active[~done], partial[~done]
    at, row = (np.concatenate([f[i] for f in found]) for i in range(2)) if found else np.zeros((2, 0), np.int64)
    return at, row, np.einsum("ij,ij->i", query[at], whole[row]).astype(np.int64), processed


def search_blocks(batches, k: int):
    """The rows of each pair of a block and a block of queries that may be among the k best."""
    import pyarrow as pa

    for batch in batches:
        for r in range(batch.num_rows):
            ids, query_ids, floors, query = (
                np.frombuffer(batch.column(c)[r].as_buffer(), kind)
                for c, kind in (("ids", "<i8"), ("query_ids", "<i8"), ("floors", "<f8"), ("queries", "<f8"))
            )
            width, query_width = (batch.column(c)[r].as_py() for c in ("width", "query_width"))
            both = max(width, query_width)
            some = np.zeros((len(query_ids), both))
            some[:, :query_width] = query.reshape(len(query_ids), query_width)
            segments = []
            for s in batch.column("segments")[r].values.to_pylist():
                cells = np.frombuffer(s["cells"], "<i4").astype(np.int64)
                cells = cells // max(width, 1) * both + cells % max(width, 1)
                segments.append((cells, np.frombuffer(s["impacts"], "<i8"), np.frombuffer(s["rest"], "<f8")))
            at, row, score, _ = best_of_block(some, query_ids, floors, ids, segments, k)
            order = np.lexsort((ids[row], -score, at))
            at, row, score = at[order], row[order], score[order]
            keep = (np.arange(len(at)) - np.searchsorted(at, at) < k) & (score >= floors[at])
            yield pa.RecordBatch.from_arrays(
                [pa.array(query_ids[at[keep]]), pa.array(ids[row[keep]]), pa.array(score[keep])],
                names=["query_id", "vec_id", "score"],
            )


def tiled(index: DataFrame, packs: DataFrame, first: int, last: int, parts: int) -> DataFrame:
    """Blocks ``first`` to ``last`` with every block of queries, joined by tiles of at most
    ``TILE_SIDE`` blocks on a side: a key has a bounded number of rows on both sides."""
    side = max(1, min(TILE_SIDE, math.isqrt((last - first) * parts // TILES)))
    rows, columns = math.ceil((last - first) / side), math.ceil(parts / side)

    some = index.filter(F.col("block").between(first, last - 1))
    own = F.floor((F.col("block") - first) / side).cast("int")
    left = some.select("ids", "width", "segments", own.alias("_i"), F.explode(F.sequence(F.lit(0), F.lit(columns - 1))).alias("_j"))
    asked = packs.select(
        "query_ids", "floors", "query_width", "queries",
        F.floor(F.col("part") / side).cast("int").alias("_p"),
        F.explode(F.sequence(F.lit(0), F.lit(rows - 1))).alias("_b"),
    )
    left = left.repartition(min(rows * columns, 8192), "_i", "_j")
    return left.join(asked, (F.col("_i") == F.col("_b")) & (F.col("_j") == F.col("_p"))).drop("_i", "_j", "_b", "_p")


def top_k(
    vectors: DataFrame,
    scratch: Scratch,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    query_step: int = QUERY_STEP,
    k: int = K,
    scale: int = SCALE,
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` best rows for every id divisible by ``query_step``.

    Ties go to the smaller id. Rows with the query's own id are no candidates. Vectors that are
    null or hold a null or a component that is not finite take no part, nor do rows without id; an
    empty vector scores 0, and shorter vectors count as ending in zeros. Of repeated rows each is a
    candidate, and the query is asked once, with the smallest of its vectors. An empty table gives
    no rows. Other columns are not looked at.
    """
    spark = vectors.sparkSession
    bounded_batches(spark)
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("vector"))
    make = functools.partial(quantised, scale=scale)
    valid = scratch.table(rows.mapInArrow(make, "vec_id long, impacts binary"))
    count = valid.count()
    blocks = max(1, math.ceil(count / BLOCK_ROWS))
    # By a row number, as an id may repeat in many rows.
    placed = valid.withColumn("block", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(blocks)))

    def index_block(key, table):
        return block_index(table, key[0].as_py())

    def pack(key, table):
        return query_block(table, key[0].as_py())

    index = scratch.table(placed.groupBy("block").applyInArrow(index_block, INDEX))
    asked = valid.filter(F.col("vec_id") % query_step == 0)
    asked = scratch.table(asked.groupBy("vec_id").agg(F.min("impacts").alias("impacts")))
    parts = max(1, math.ceil(asked.count() / QUERY_ROWS))
    asked = asked.withColumn("part", F.pmod(F.xxhash64(F.col("vec_id"), F.lit(1)), F.lit(parts)))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best, first = spark.createDataFrame([], FOUND), 0
    while first < blocks:
        last = min(blocks, max(1, 2 * first))
        floors = best.groupBy("query_id").agg(F.count("*").alias("_n"), F.min("score").alias("floor"))
        floors = floors.filter(F.col("_n") == k).select("query_id", "floor")
        waiting = asked.join(floors, F.col("vec_id") == F.col("query_id"), "left").select("part", "vec_id", "impacts", "floor")
        packs = scratch.table(waiting.groupBy("part").applyInArrow(pack, QUERIES))
        found = tiled(index, packs, first, last, parts).mapInArrow(functools.partial(search_blocks, k=k), FOUND)
        ranked = best.unionByName(found).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        best, first = scratch.table(ranked.select("query_id", "vec_id", "score")), last
    return best.withColumn("rank", F.row_number().over(order)).select("query_id", "rank", "vec_id", "score")
