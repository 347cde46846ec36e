"""Merkle manifest of a table: a tree of its rows per source, and a tree of the sources.

Rows are range-sorted once by (source, id), which gives every leaf its place without a window over
a source. 16**3 consecutive leaves are a superblock, reduced to one node in a task; the nodes
are the leaves of the next level of superblocks, until every tree has one. Small trees share a
superblock. On the way back the leaves of a superblock and the siblings outside of it, one short
row, are cogrouped: a task finishes the reduction, joins the proofs and folds them. A source that
holds a third of all rows is a third of the superblocks.
"""

from __future__ import annotations

import functools
import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veritally.llm.common import LOWER, UPPER, Scratch

FAN = 16
HEIGHT = 3  # levels within a superblock
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPER_EVERY = 5
NODE = "tree string, at long, size long, digest string, child string"
PATH = "child string, tree string, subroot string, lefts array<string>, rights array<string>"
RESULT = (
    "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
)


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def encoded(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_rows(docs: DataFrame) -> DataFrame:
    """tree, source, doc_id, leaf, tampered (null unless the row is chosen and changes) of every row."""
    kinds = {"doc_id": "long", "n_chars": "long"}
    rows = docs.select(*[F.col(c).cast(kinds.get(c, "string")).alias(c) for c in FIELDS])

    def leaf(text: Column) -> Column:
        return F.sha2(F.concat(*[encoded(F.col(c)) for c in FIELDS[:-1]], encoded(text)), 256)

    changed = F.translate("text", UPPER, LOWER)
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPER_EVERY == 0
    return rows.select(
        encoded(F.col("source")).alias("tree"),
        "source",
        "doc_id",
        leaf(F.col("text")).alias("digest"),
        F.when(chosen & (changed != F.col("text")), leaf(changed)).alias("tampered"),
    )


# ---- places ----


def placed(rows: DataFrame, order: list[str], scratch: Scratch, height: int) -> DataFrame:
    """``rows`` with ``at`` (place in the tree by ``order``), ``size`` (of the tree) and ``block`` (superblock).

    A range sort with the row number as last key splits every hot tree and every repeated row over
    many partitions; a partition's part of a tree is one row of a small table that is summed up.
    """
    numbered = rows.withColumn("_row", F.monotonically_increasing_id())
    by = ["tree", *order, "_row"]
    sorted_rows = numbered.repartitionByRange(*by).sortWithinPartitions(*by).drop("_row")
    stored = scratch.table(
        sorted_rows.withColumn("_part", F.spark_partition_id()).withColumn("_id", F.monotonically_increasing_id())
    )
    runs = stored.groupBy("_part", "tree").agg(F.min("_id").alias("_first"), F.count("*").alias("_n"))
    sums = runs.groupBy("tree").agg(F.sum("_n").alias("size"), F.count("*").alias("_parts"))
    runs = runs.join(sums, "tree")
    split = runs.filter("_parts > 1").selectExpr(
        "*", "sum(_n) over (partition by tree order by _part rows unbounded preceding) - _n as _before"
    )
    runs = split.unionByName(runs.filter("_parts = 1").withColumn("_before", F.lit(0).cast("long")))
    start = F.col("_first") - F.shiftleft(F.col("_part").cast("long"), 33)
    shared = F.concat_ws(".", F.lit("s"), "_part", F.floor(start / FAN**height))
    with_place = stored.join(runs.withColumn("_shared", shared), ["_part", "tree"])
    at = F.col("_id") - F.col("_first") + F.col("_before")
    with_place = with_place.withColumn("at", at)
    small = (F.col("_parts") == 1) & (F.col("size") <= FAN**height)
    block = F.when(small, F.col("_shared")).otherwise(own_block(height))
    return scratch.table(with_place.select(*rows.columns, "at", "size", block.alias("block")))


def own_block(height: int) -> Column:
    return F.concat_ws(".", F.lit("b"), F.floor(F.col("at") / FAN**height), "tree")


# ---- up ----


def levels_of(digests: list[str], size: int, height: int) -> list[list[str]]:
    """The digests and their reductions: to one node for a whole tree, ``height`` times for a part of one."""
    levels = [digests]
    while len(levels[-1]) > 1 if size <= FAN**height else len(levels) <= height:
        below = levels[-1]
        levels.append([digest("".join(below[i : i + FAN])) for i in range(0, len(below), FAN)])
    return levels


def trees_of(frame):
    """(tree, size, rows in order) of every tree of a superblock."""
    frame = frame.sort_values(["tree", "at"], kind="stable")
    for tree, rows in frame.groupby("tree", sort=False):
        yield tree, int(rows["size"].iloc[0]), rows


def reduce_block(frame, height: int):
    """One node for every tree of a superblock."""
    import pandas as pd

    out = []
    for tree, size, rows in trees_of(frame):
        top = levels_of(rows["digest"].tolist(), size, height)[-1][0]
        spot = int(rows["at"].iloc[0]) // FAN**height
        out.append((tree, spot, -(-size // FAN**height), top, rows["block"].iloc[0]))
    return pd.DataFrame(out, columns=["tree", "at", "size", "digest", "child"])


def climb(leaves: DataFrame, scratch: Scratch, height: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """(levels with more than one node a tree, for each the trees that end above it)."""
    levels, ended = [], []
    while True:
        levels.append(leaves)
        blocks = leaves.select("tree", "at", "size", "digest", "block").groupBy("block")
        nodes = scratch.table(blocks.applyInPandas(lambda frame: reduce_block(frame, height), NODE))
        ended.append(nodes.filter("size = 1"))
        rest = nodes.filter("size > 1").withColumn("block", own_block(height))
        if rest.isEmpty():
            return levels, ended
        leaves = rest


# ---- down ----


def paths_in(frame, outer, height: int):
    """(row, siblings to the left and right level by level up to the root) of every node of a superblock."""
    above = {r.tree: r for r in outer.itertuples(index=False)}
    for tree, size, rows in trees_of(frame):
        top = above[tree]
        levels = levels_of(rows["digest"].tolist(), size, height)
        for place, row in enumerate(rows.itertuples(index=False)):
            lefts, rights = [], []
            for level in levels[:-1]:
                run = place - place % FAN
                lefts.append("".join(level[run:place]))
                rights.append("".join(level[place + 1 : run + FAN]))
                place //= FAN
            yield row, top.subroot, [*lefts, *top.lefts], [*rights, *top.rights]


def pass_down(frame, outer, height: int):
    """The way from every node of a superblock to the root, addressed to the node's own superblock below."""
    import pandas as pd

    out = [(r.child, r.tree, subroot, lefts, rights) for r, subroot, lefts, rights in paths_in(frame, outer, height)]
    return pd.DataFrame(out, columns=["child", "tree", "subroot", "lefts", "rights"])


def prove(frame, outer, root: str, height: int):
    """The final row of every leaf of a superblock."""
    import pandas as pd

    out = []
    for row, subroot, lefts, rights in paths_in(frame, outer, height):
        folded = row.tampered if isinstance(row.tampered, str) else row.digest
        proof = hashlib.sha256()
        for left, right in zip(lefts, rights, strict=True):
            proof.update((left + right).encode())
            folded = digest(left + folded + right)
        out.append((row.doc_id, row.digest, subroot, root, proof.hexdigest(), folded, folded == root))
    made = pd.DataFrame(out, columns=["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])
    made["doc_id"] = pd.array([int(x) if x else None for x in made["doc_id"]], "Int64")
    return made


def cogrouped(nodes: DataFrame, outer: DataFrame, finish, schema: str) -> DataFrame:
    """``finish`` over the nodes of every superblock and the ways from its trees to the root."""
    outer = outer.withColumnRenamed("child", "block")
    return nodes.groupBy("block").cogroup(outer.groupBy("block")).applyInPandas(lambda a, b: finish(a, b), schema)


def descend(levels: list[DataFrame], ended: list[DataFrame], tops: DataFrame, scratch: Scratch, height: int) -> DataFrame:
    """For the superblocks of the lowest level the way from each tree in them to the root.

    ``tops`` has it for each tree as a whole: (tree, subroot, lefts, rights).
    """
    down = functools.partial(pass_down, height=height)
    outer = None
    for level in range(len(levels) - 1, -1, -1):
        here = ended[level].select("tree", "child").join(tops, "tree").select("child", "tree", "subroot", "lefts", "rights")
        here = scratch.table(here if outer is None else here.unionByName(outer))
        if level:
            outer = cogrouped(levels[level], here, down, PATH)
    return here


def merkle_manifest(docs: DataFrame, scratch: Scratch, height: int = HEIGHT) -> DataFrame:
    """One row per row of ``docs``: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    A leaf is the hash of the row's ``FIELDS``; columns beyond these are not looked at. Leaves
    stand by doc_id, null first, rows of one id by their hash; a null source is a source of its
    own, before all others. Each row of a repeated id is tampered with if its id is chosen; a null
    id is not, and a text without A-Z stays as it is and is verified. Empty texts are texts. An
    empty table gives no rows and no root; the proof of a lone leaf is the hash of nothing.
    ``height`` only sets how many levels a superblock has, the result is the same.
    """
    leaves = placed(scratch.table(leaf_rows(docs)), ["doc_id", "digest"], scratch, height)
    levels, ended = climb(leaves, scratch, height)
    subroots = functools.reduce(DataFrame.unionByName, ended).select("tree", F.col("digest").alias("subroot"))
    # The sources are the leaves of one more tree; ``sources`` names each source's own tree.
    sources = subroots.join(leaves.select("tree", "source").distinct(), "tree")
    top_rows = sources.select(F.lit("").alias("tree"), "source", F.col("subroot").alias("digest"), F.col("tree").alias("child"))
    top = placed(top_rows, ["source"], scratch, height)
    top_levels, top_ended = climb(top, scratch, height)
    found = top_ended[-1].select("digest").head()
    root = found[0] if found else ""
    nothing = F.array().cast("array<string>")
    above = top_ended[-1].select("tree", F.col("digest").alias("subroot"), nothing.alias("lefts"), nothing.alias("rights"))
    outer = descend(top_levels, top_ended, above, scratch, height)
    ways = cogrouped(top, outer, functools.partial(pass_down, height=height), PATH)
    tops = scratch.table(ways.select(F.col("child").alias("tree"), "lefts", "rights")).join(subroots, "tree")
    outer = descend(levels, ended, tops, scratch, height)
    # Pandas holds whole numbers with gaps as floats, which lose digits: ids travel as text.
    text_id = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    rows = leaves.select("block", "tree", "at", "size", "digest", "tampered", text_id.alias("doc_id"))
    return cogrouped(rows, outer, functools.partial(prove, root=root, height=height), RESULT)
