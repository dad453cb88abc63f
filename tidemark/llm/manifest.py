"""Merkle manifest of a table: a hash tree per group of rows and one over the groups.

Each level of a tree is a table of nodes (grp, i, n, h): the i-th of n nodes of
a group, hash h. Every ``FANOUT`` consecutive nodes are a run. Windows over
the runs give each node its siblings by lag and lead at fixed offsets; the
first node of a run hashes the run into its parent. Going down again, a node's
path is its own siblings and then its parent's path, by a join on the run.

Nothing gathers a group: positions come from a range sort that is stored once,
so that the largest group is spread like any other, and a window holds one run.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from tidemark.llm.store import parallelism, stored

FANOUT = 16
_PATH = "array<struct<left: string, right: string>>"


def encoded(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, ``:`` and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, upper, upper.lower())


def leaf_hash(fields: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[encoded(c) for c in fields]), 256)


def numbered(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """``rows`` with i (place in its ``grp`` by ``order``, from 0) and n (rows of the group).

    The rows are range-sorted by group and order and stored with Spark's
    increasing row numbers; a group's place in each partition follows from one
    small row per group and partition. ``order`` should tell all rows apart,
    else equal ones share a partition.
    """
    keys = ["grp", *order]
    ranged = rows.repartitionByRange(parallelism(rows), *keys).sortWithinPartitions(*keys)
    ranged = stored(ranged.withColumn("at", F.monotonically_increasing_id()), "manifest-sorted").withColumn("piece", F.shiftright("at", 33))
    pieces = ranged.groupBy("grp", "piece").agg(F.count("*").alias("rows"), F.min("at").alias("low"))
    group = W.Window.partitionBy("grp")
    shifts = pieces.select("grp", "piece", F.sum("rows").over(group).alias("n"),
                           (F.sum("rows").over(group.orderBy("piece")) - F.col("rows") - F.col("low")).alias("shift"))
    out = ranged.join(shifts, ["grp", "piece"]).withColumn("i", F.col("at") + F.col("shift"))
    return stored(out.drop("at", "piece", "shift"), "manifest-nodes")


def with_siblings(nodes: DataFrame) -> DataFrame:
    """Nodes of runs (n > 1) with run, slot, left and right: the joined hashes of the siblings before and after."""
    run, slot = F.expr(f"i div {FANOUT}"), (F.col("i") % FANOUT).cast("int")
    width = F.least(F.lit(FANOUT), F.col("n") - F.lit(FANOUT) * F.col("run")).cast("int")
    rows = nodes.where("n > 1").withColumn("run", run).withColumn("slot", slot).withColumn("width", width)
    w = W.Window.partitionBy("grp", "run").orderBy("i")
    before = [F.when(F.col("slot") >= d, F.lag("h", d).over(w)).otherwise("") for d in range(FANOUT - 1, 0, -1)]
    after = [F.when(F.col("slot") + d < F.col("width"), F.lead("h", d).over(w)).otherwise("") for d in range(1, FANOUT)]
    return rows.withColumn("left", F.concat(*before)).withColumn("right", F.concat(*after))


def levels_of(nodes: DataFrame) -> list[DataFrame]:
    """All levels from ``nodes`` (grp, i, n, h) up; a group ends at the level where n is 1."""
    levels, most = [nodes], nodes.agg(F.max("n")).first()[0] or 0
    while most > 1:
        first = with_siblings(levels[-1]).where("slot = 0")
        parents = first.select("grp", F.col("run").alias("i"), F.ceil(F.col("n") / FANOUT).cast("bigint").alias("n"),
                               F.sha2(F.concat("h", "right"), 256).alias("h"))
        levels.append(stored(parents, f"manifest-level-{len(levels)}"))
        most = -(-most // FANOUT)
    return levels


def tops_of(levels: Sequence[DataFrame]) -> DataFrame:
    """(grp, h): the node that remains of each group."""
    out = levels[0].where("n = 1").select("grp", "h")
    for nodes in levels[1:]:
        out = out.unionByName(nodes.where("n = 1").select("grp", "h"))
    return out


def paths_of(levels: Sequence[DataFrame], above: DataFrame) -> DataFrame:
    """The nodes of the lowest level with top (their group's) and path, up to and on through ``above``.

    ``above`` has grp and path, what lies over the group's top, and more
    columns that come along.
    """
    more = [c for c in above.columns if c not in ("grp", "path")]
    out = None
    for nodes in reversed(levels):
        last = nodes.where("n = 1").join(above, "grp").select(*nodes.columns, *more, F.col("h").alias("top"), "path")
        if out is not None:
            parent = out.select("grp", F.col("i").alias("run"), *more, "top", F.col("path").alias("up"))
            inner = with_siblings(nodes).join(parent, ["grp", "run"])
            last = last.unionByName(inner.select(*nodes.columns, *more, "top", F.concat(F.array(F.struct("left", "right")), "up").alias("path")))
        out = last
    return out


def manifest(rows: DataFrame, fields: Sequence[str], group: str, order: str,
             altered: Mapping[str, Column] | None = None, alter: Column | None = None) -> DataFrame:
    """(<order>, leaf, subroot, root, path, altered): every row's leaf and its way to the root.

    A leaf hashes ``fields``; per ``group`` the leaves ascend by ``order`` and
    make a tree whose top is the subroot; the subroots, ordered by group (null
    first, bytewise), make the tree of the root. ``path`` has the siblings
    before and after the row's node on each level. ``altered`` gives other
    values for some fields of the rows where ``alter`` is true; the column
    ``altered`` is the leaf hash with them, and the leaf itself elsewhere.

    Defined cases: nulls hash as ``-``; null ``order`` values come first, rows
    of equal ``order`` by leaf, and repeated rows have a leaf each; a single
    row is its own subroot and a single subroot the root; an empty table gives
    no rows. Values are hashed whole. Only the named columns are read, whatever
    else the table holds.
    """
    own, changed = (leaf_hash([x.get(c, F.col(c)) for c in fields]) for x in ({}, altered or {}))
    name = F.col(group).cast("string")
    # one text per group that sorts as asked and is never null
    leaves = rows.select(F.coalesce(F.concat(F.lit("="), name), F.lit("")).alias("grp"), F.col(order).alias("key"),
                         own.alias("h"), F.when(F.lit(False) if alter is None else alter, changed).alias("altered"),
                         F.monotonically_increasing_id().alias("row"))
    trees = levels_of(numbered(stored(leaves, "manifest-leaves"), ["key", "h", "row"]))
    subroots = tops_of(trees).select(F.lit("").alias("grp"), F.col("grp").alias("key"), "h")
    upper = levels_of(numbered(subroots, ["key"]))
    start = tops_of(upper).select("grp", F.lit(None).cast(_PATH).alias("path")).withColumn("path", F.array().cast(_PATH))
    above = paths_of(upper, start).select(F.col("key").alias("grp"), F.col("top").alias("root"), "path")
    return paths_of(trees, stored(above, "manifest-upper")).select(
        F.col("key").alias(order), F.col("h").alias("leaf"), F.col("top").alias("subroot"), "root", "path",
        F.coalesce("altered", "h").alias("altered"))


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf hash and its siblings lead to."""
    return F.aggregate(path, leaf, lambda h, p: F.sha2(F.concat(p.left, h, p.right), 256))


def proof_hash(path: Column) -> Column:
    """One hash over all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda p: F.concat(p.left, p.right)), ""), 256)
