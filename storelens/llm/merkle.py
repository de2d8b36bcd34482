"""Merkle manifest of a dataset: a forest of hash trees, few stored levels, proofs by recomputing what lies between them.

Rows of a group are leaves in key order, and every ``ARITY`` consecutive nodes become one until one remains; the groups' roots
are the leaves of one more tree. Only every ``EVERY``-th level is stored, cut into aligned subtrees of ARITY ** EVERY nodes, one row each.
The levels inside a subtree are computed from that row when they are needed, first to find its root and again to emit
siblings, and are never written. All of it is column expressions; a row of a stored level is the largest thing a task holds.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from storelens.llm.tables import stored

BITS = 3
ARITY = 1 << BITS
#: Levels from one stored level to the next: a stored row is a subtree of 64 nodes.
EVERY = 2
SPAN = ARITY**EVERY
#: Bits of a row number within its partition, in monotonically_increasing_id.
_ROW_BITS = 33
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(text: Column) -> Column:
    """Lowercase hex sha256 of a string's UTF-8 bytes."""
    return F.sha2(text, 256)


def leaf(values: list[Column]) -> Column:
    """Digest of a row: each value as its byte count, a colon and itself, ``-`` for null, so that no two rows run together alike."""
    written = [v.cast("string") for v in values]
    return digest(F.concat(*[F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in written]))


def _placed(nodes: DataFrame, order: list[str]) -> DataFrame:
    """``pos`` (from 0, in ``order``) and ``m`` (rows) within each group ``g``; a group may lie over many partitions.

    Rows are sorted by ranges and stored once; what is joined back is a row per group and partition.
    """
    by = ["g", *order]
    ranged = nodes.repartitionByRange(*by).sortWithinPartitions(*by)
    rows = stored(ranged.withColumn("_at", F.monotonically_increasing_id())).withColumn("_slot", F.shiftright("_at", _ROW_BITS))
    cells = rows.groupBy("g", "_slot").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    earlier = W.partitionBy("g").orderBy("_slot").rowsBetween(W.unboundedPreceding, -1)
    cells = cells.select("g", "_slot", "_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"), F.sum("_n").over(W.partitionBy("g")).alias("m"))
    return rows.join(cells, ["g", "_slot"]).withColumn("pos", F.col("_before") + F.col("_at") - F.col("_first")).drop("_at", "_slot", "_first", "_before")


def _blocks(placed: DataFrame, extra: list[str]) -> DataFrame:
    """One row per aligned subtree: (g, block, m, nodes); a node has digest and the ``extra`` columns."""
    node = F.struct("pos", "digest", *extra)
    return placed.groupBy("g", F.expr(f"pos div {SPAN}").alias("block")).agg(F.max("m").alias("m"), F.array_sort(F.collect_list(node)).alias("nodes"))


def _parents(digests: Column) -> Column:
    """The next level of a run of digests."""
    runs = F.sequence(F.lit(0), F.shiftright(F.size(digests) - 1, BITS))
    return F.transform(runs, lambda r: digest(F.array_join(F.slice(digests, r * ARITY + 1, ARITY), "")))


def _levels(blocks: DataFrame) -> DataFrame:
    """Add the levels of each subtree, l0 (its stored nodes) to l<EVERY>; levels above a group's root repeat the root."""
    out = blocks.withColumn("l0", F.col("nodes.digest"))
    for k in range(EVERY):
        alone = F.col("m") <= ARITY**k
        out = out.withColumn(f"l{k + 1}", F.when(alone, F.col(f"l{k}")).otherwise(_parents(F.col(f"l{k}"))))
    return out


def _up(blocks: DataFrame) -> DataFrame:
    """Root of every subtree as a node of the next stored level; m is 1 at the root of a group."""
    m = F.greatest(F.lit(1), F.ceil(F.col("m") / F.lit(SPAN)))
    return _levels(blocks).select("g", F.col("block").alias("pos"), m.cast("long").alias("m"), F.col(f"l{EVERY}")[0].alias("digest"))


def _path(i: Column) -> Column:
    """Siblings of node ``i`` of a subtree, level by level: what stands before and after it in its run."""
    steps = []
    for k in range(EVERY):
        at = F.shiftright(i, BITS * k)
        start = F.shiftright(at, BITS) * ARITY
        level = F.col(f"l{k}")
        step = F.struct(
            F.array_join(F.slice(level, start + 1, at - start), "").alias("before"),
            F.array_join(F.slice(level, at + 2, start + ARITY - 1 - at), "").alias("after"),
        )
        steps.append(F.when(F.col("m") > ARITY**k, step))
    return F.filter(F.array(*steps), lambda s: s.isNotNull())


def _with_path(names: list[str]) -> Callable[[Column, Column], Column]:
    return lambda x, i: F.struct(*[x[c].alias(c) for c in names], F.concat(_path(i), F.col("_above")).alias("path"))


@dataclass
class Forest:
    """Stored levels of all groups from the leaves up, and (g, digest, stage) of their roots; stage: the stored level it was computed from."""

    levels: list[DataFrame]
    roots: DataFrame
    extra: list[str]


def forest(nodes: DataFrame, order: list[str], extra: list[str]) -> Forest:
    """Hash trees over (g, digest, ...) rows, a tree for each g."""
    levels, roots, placed = [], None, _placed(nodes, order)
    while True:
        blocks = stored(_blocks(placed, extra if not levels else []))
        above = _up(blocks)
        done = above.where("m = 1").select("g", "digest", F.lit(len(levels)).alias("stage"))
        roots = done if roots is None else roots.unionByName(done)
        largest = blocks.agg(F.max("m")).first()[0]
        levels.append(blocks)
        if largest is None or largest <= SPAN:
            return Forest(levels, stored(roots), extra)
        placed = above.where("m > 1")


def paths(trees: Forest, tops: DataFrame) -> DataFrame:
    """(g, digest, extra columns, root, path) of every leaf; root: that of its group. ``tops``: (g, path) above each group's root.

    Levels are gone through from the top; subtrees get the path of their root by a join of stored rows and emit a path for each node.
    """
    ends = trees.roots.join(tops, "g").select("g", "stage", F.col("digest").alias("root"), "path")
    found = None
    for k in reversed(range(len(trees.levels))):
        above = ends.where(F.col("stage") == k).select("g", F.lit(0).cast("long").alias("block"), "root", F.col("path").alias("_above"))
        if found is not None:
            above = above.unionByName(found.select("g", F.col("pos").alias("block"), "root", F.col("path").alias("_above")))
        names = ["pos", "digest", *(trees.extra if k == 0 else [])]
        each = _levels(trees.levels[k].join(above, ["g", "block"]))
        found = each.select("g", "root", F.inline(F.transform("nodes", _with_path(names))))
    return found.drop("pos")


def folded(start: Column, path: Column) -> Column:
    """The root that a leaf digest and the siblings of its path lead to."""
    return F.aggregate(path, start, lambda h, s: digest(F.concat(s["before"], h, s["after"])))


def proof_digest(path: Column) -> Column:
    """Digest of all siblings of a path, level by level, left to right."""
    return digest(F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), ""))


@dataclass
class Manifest:
    """Leaves' forest (a tree per group), the tree over the groups' roots, and the root of all (null without rows)."""

    groups: Forest
    top: Forest
    root: str | None

    def proofs(self) -> DataFrame:
        """Every row's key and carried columns, leaf, subroot, and ``path`` from leaf to root as (before, after) siblings."""
        start = self.top.roots.select("g", F.array().cast("array<struct<before:string,after:string>>").alias("path"))
        tops = stored(paths(self.top, start).select(F.col("member").alias("g"), "path"))
        kept = [c for c in self.groups.extra if c != "_salt"]
        return paths(self.groups, tops).select(*kept, F.col("digest").alias("leaf"), F.col("root").alias("subroot"), "path")


def manifest(docs: DataFrame, fields: list[str], key: str = "doc_id", group: str | None = "lang", carry: dict[str, Column] | None = None) -> Manifest:
    """Merkle trees over the rows of ``docs``: one per value of ``group``, in order of ``key``, and one over their roots.

    ``fields`` are hashed, in this order, into a leaf. ``carry`` are expressions kept beside each leaf for ``proofs``. Nulls: a
    null field is hashed as ``-``, null groups come first, null keys come first in their group. Rows with equal keys stand in the order of
    their leaves; rows that are repeated altogether are leaves of their own. Other columns may have any name. An empty table has a null
    root and no proofs. Texts are read once, and only their digests are shuffled.
    """
    named = F.lit(None).cast("string") if group is None else F.col(f"`{group}`").cast("string")
    g = F.when(named.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), named))
    carried = {"_salt": F.monotonically_increasing_id(), "key": F.col(f"`{key}`"), **(carry or {})}
    nodes = docs.select(g.alias("g"), leaf([F.col(f"`{c}`") for c in fields]).alias("digest"), *[v.alias(c) for c, v in carried.items()])
    groups = forest(stored(nodes), ["key", "digest", "_salt"], list(carried))
    top = forest(groups.roots.select(F.lit("").alias("g"), "digest", F.col("g").alias("member")), ["member"], ["member"])
    found = top.roots.select("digest").first()  # one row
    return Manifest(groups, top, found[0] if found else None)


def tampered(text: Column) -> Column:
    """A-Z in lower case, other letters as they are."""
    return F.translate(text, UPPER, LOWER)
