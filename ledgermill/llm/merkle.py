"""Merkle tree over the rows of a dataset, of which only every few levels are stored.

Each group (here a language) has a tree over its leaves in order; the roots of these trees, in order of their
groups, are the leaves of a last tree, whose root stands for the dataset. Every ARITY consecutive nodes of a level
become their hash, until one node remains.

`manifest` stores the leaves and every STEP-th level above. A proof needs the siblings of all levels: an aligned
subtree of ARITY**STEP stored nodes is put together in one task, its missing interior nodes are computed again,
their siblings go out, and the nodes are forgotten. What lies above a subtree is the same for all its leaves: it is
joined to the subtree, not to the leaves. So work and shuffles are those of the stored nodes, and no task holds more
than one subtree.

Leaves get their place from a range partitioning by (group, key, leaf): a group with a third of all rows spreads over
many tasks. Counts of the ranges, one row for each range and group, are summed up to the first place of each.

Defined results: null is a group of its own and comes first, as null keys do; rows with the same key are ordered by
their leaf, and equal leaves are interchangeable; an empty table has no leaves and no root; columns other than
doc_id, source, lang, n_chars and text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgermill.llm.shared import dropped, stored

ARITY, STEP = 8, 3
#: Leaves that one range holds on average.
RANGE_ROWS = 100_000
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
A_TO_Z = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lower_ascii(text: Column) -> Column:
    return F.translate(text, A_TO_Z, A_TO_Z.lower())


def leaf(values: list[Column]) -> Column:
    """Hash of a row: each value as its number of bytes, a colon and the value, or a dash for null."""
    texts = [v.cast("string") for v in values]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*parts), 256)


def digest(proof: Column) -> Column:
    """One hash over all siblings of a proof, from the leaf up and from left to right."""
    return F.sha2(F.array_join(F.transform(proof, lambda level: F.concat(level.left, level.right)), ""), 256)


def folded(leaf_: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    return F.aggregate(proof, leaf_, lambda node, level: F.sha2(F.concat(level.left, node, level.right), 256))


@dataclass
class Manifest:
    """Stored levels of the trees of all groups and of the tree over their roots, lowest first.

    A level's table is (tree, place, size, node): `size` is the number of leaves of the tree. The lowest level has
    more columns: doc_id and those kept of the rows, or the tree that a root belongs to.
    """

    levels: list[DataFrame]
    top_levels: list[DataFrame]


def placed(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """Rows with `place`, counted from 0 within the group in the given order, and `size`, the rows of the group."""
    n = rows.count()
    ranges = max(1, -(-n // RANGE_ROWS), int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")) if n > RANGE_ROWS else 1)
    keys = [F.col(c).asc_nulls_first() for c in (group, *order)]
    dealt = rows.repartitionByRange(ranges, *keys).sortWithinPartitions(*keys).withColumn("part", F.spark_partition_id())
    names = dealt.columns

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, n = (), 0
        for batch in batches:
            ranks = []
            for key in batch.column(group).to_pylist():
                n = n + 1 if last == (key,) else 0
                last = (key,)
                ranks.append(n)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ranks, pa.int64())], [*names, "rank"])

    schema = ", ".join(f"{c} {t}" for c, t in dealt.dtypes) + ", rank bigint"
    dealt = stored(dealt.mapInArrow(number, schema))
    # One row for each range and each group in it.
    counts = dealt.groupBy(group, "part").agg(F.count("*").alias("n"))
    own = Window.partitionBy(group)
    before = F.coalesce(F.sum("n").over(own.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = counts.select(F.col(group).alias("_group"), F.col("part").alias("_part"), before.alias("first"), F.sum("n").over(own).alias("size"))
    same = F.col(group).eqNullSafe(F.col("_group")) & (F.col("part") == F.col("_part"))
    out = stored(dealt.join(counts, same).select(*[c for c in names if c != "part"], (F.col("first") + F.col("rank")).alias("place"), "size"))
    dropped(dealt)
    return out


def _width(size: int, level: int) -> int:
    """Nodes of a level of a tree with so many leaves."""
    return -(-size // ARITY**level)


def _hash(texts: list[str]) -> str:
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def _levels_of(nodes: list[str], level: int, size: int) -> list[list[str]]:
    """The nodes of an aligned subtree from a stored level up to the next one, or to the root of its tree."""
    out = [nodes]
    while len(out) <= STEP and _width(size, level + len(out) - 1) > 1:
        below = out[-1]
        out.append([_hash(below[i : i + ARITY]) for i in range(0, len(below), ARITY)])
    return out


def _upper(level: int) -> Callable[[pa.Table], pa.Table]:
    def run(subtree: pa.Table) -> pa.Table:
        subtree = subtree.sort_by("place")
        size = subtree.column("size")[0].as_py()
        top = _levels_of(subtree.column("node").to_pylist(), level, size)[-1]
        return pa.table({"tree": subtree.column("tree")[:1], "place": subtree.column("block")[:1], "size": pa.array([size], pa.int64()), "node": pa.array(top)})

    return run


NODES = "tree string, place bigint, size bigint, node string"


def _blocks(level: DataFrame) -> DataFrame:
    return level.withColumn("block", F.expr(f"place div {ARITY**STEP}"))


def _stored_levels(lowest: DataFrame) -> list[DataFrame]:
    """The lowest level and every STEP-th one above, up to the one that holds roots alone.

    A tree that ends between two stored levels has its root in the next one.
    """
    levels, height = [lowest], 0
    most = int(lowest.agg(F.max("size")).first()[0] or 0)
    while _width(most, height) > 1:
        level = _blocks(levels[-1]).where(F.col("size") > ARITY**height)  # trees with more than one node here
        levels.append(stored(level.groupBy("tree", "block").applyInArrow(_upper(height), NODES)))
        height += STEP
    return levels


def _roots(levels: list[DataFrame]) -> DataFrame:
    """(tree, node) of each tree: the node of the stored level where only one is left."""
    ended = [F.col("size") <= ARITY ** (STEP * i) for i in range(len(levels))]
    found = [x.where(ended[i] if not i else ended[i] & ~ended[i - 1]) for i, x in enumerate(levels)]
    out = found[0].select("tree", "node")
    for x in found[1:]:
        out = out.unionByName(x.select("tree", "node"))
    return out


def manifest(docs: DataFrame, keep: tuple[str, ...] = ()) -> Manifest:
    """Store the leaves of docs (doc_id, source, lang, n_chars, text) and every STEP-th level of their trees.

    Columns to keep stand beside the leaves. A null group is the tree "-"; a group's name as a tree is "=" and the name.
    """
    tree = F.coalesce(F.concat(F.lit("="), docs["lang"]), F.lit("-"))  # sorts null first, then by the name's bytes
    rows = docs.select(
        tree.alias("tree"), leaf([docs[name] for name in FIELDS]).alias("node"), docs["doc_id"].alias("doc_id"),
        *[docs[c].alias(c) for c in keep], F.monotonically_increasing_id().alias("_row"),
    )
    # The row's number spreads rows that are equal in all else; it decides nothing.
    levels = _stored_levels(placed(rows, "tree", ["doc_id", "node", "_row"]).drop("_row"))
    roots = _roots(levels).select(F.lit("").alias("tree"), F.col("tree").alias("of"), "node")
    return Manifest(levels, _stored_levels(placed(roots, "tree", ["of"])))


PROOF = "array<struct<left:string,right:string>>"


def _proven(level: int, own: list[str], ends: list[str]) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Siblings of the stored nodes of a subtree on the way to the next stored level, then what lies above it."""

    def run(subtree: pa.Table, above: pa.Table) -> pa.Table:
        subtree = subtree.sort_by("place")
        size = subtree.column("size")[0].as_py()
        levels = _levels_of(subtree.column("node").to_pylist(), level, size)
        runs, place = [], list(range(len(levels[0])))
        for below in levels[:-1]:
            siblings = []
            for i in place:
                first = i - i % ARITY
                siblings.append({"left": "".join(below[first:i]), "right": "".join(below[i + 1 : first + ARITY])})
            runs.append(siblings)
            place = [i // ARITY for i in place]
        rest = above.column("proof")[0].as_py()
        proofs = [[siblings[i] for siblings in runs] + rest for i in range(len(levels[0]))]
        kind = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))
        out = subtree.select(["tree", "place", *own])
        for c in ends:
            out = out.append_column(c, pa.array(above.column(c).to_pylist() * len(subtree), pa.string()))
        return out.append_column("proof", pa.array(proofs, kind))

    return run


def _proofs_down(levels: list[DataFrame], ends: DataFrame, own: list[str]) -> DataFrame:
    """(tree, place, own..., columns of the ends, proof) of the lowest stored level, from the roots down.

    `ends` (tree, proof, ...) goes on from the root of each tree; its other columns are handed down.
    """
    more = [c for c in ends.columns if c not in ("tree", "proof")]
    ends = levels[0].where("place = 0").select("tree", "size").join(ends, "tree")
    above = None
    for i in reversed(range(len(levels))):
        taller, ended = F.col("size") > (ARITY ** (STEP * i) if i else 0), F.col("size") <= ARITY ** (STEP * (i + 1))
        top = ends.where(taller & ended).select(F.col("tree").alias("tree"), F.lit(0).cast("bigint").alias("block"), "proof", *more)
        above = top if above is None else above.unionByName(top)
        blocks, kept = _blocks(levels[i].where(taller)), [] if i else own
        schema = ["tree string", "place bigint", *(f"{c} {t}" for c, t in levels[i].dtypes if c in kept), *(f"{c} string" for c in more), f"proof {PROOF}"]
        pairs = blocks.groupBy("tree", "block").cogroup(above.groupBy("tree", "block"))
        found = pairs.applyInArrow(_proven(STEP * i, [c for c in levels[i].columns if c in kept], more), ", ".join(schema))
        if i:
            above = stored(found.select("tree", F.col("place").alias("block"), "proof", *more))
    return found


def proofs(manifest_: Manifest) -> DataFrame:
    """(place, doc_id, kept columns, leaf, subroot, root, proof) of every row.

    `proof` has for each level the concatenated siblings left and right of the path, from the leaf to the subroot and
    on to the root.
    """
    root = _roots(manifest_.top_levels).select("tree", F.col("node").alias("root"), F.array().cast(PROOF).alias("proof"))
    ends = _proofs_down(manifest_.top_levels, root, ["of", "node"])
    ends = stored(ends.select(F.col("of").alias("tree"), F.col("node").alias("subroot"), "root", "proof"))
    kept = [c for c in manifest_.levels[0].columns if c not in ("tree", "place", "size", "_row")]
    found = _proofs_down(manifest_.levels, ends, kept)
    return found.withColumnRenamed("node", "leaf").drop("tree")
