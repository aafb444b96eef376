"""Merkle dataset manifest as a persistent tree whose versions copy paths.

Leaves are digests of rows.  Per group they ascend by id, and every 16 consecutive nodes of
a level become their digest until one node, the subroot, remains; the subroots in the order
of their groups become the root in the same way.

The tree is stored in aligned blocks: a row holds up to 256 consecutive nodes and the level
above them, and the block's own digest is a node of the next table of blocks, so a group of
any size is never in one task.  A tampered leaf makes a version of the tree.  It copies only
the leaf's ancestors and shares every other node: inside the leaf's block its path is cut
from the block's arrays, above that it goes on through the paths of the upper blocks, which
come down table by table and are joined once a block, not once a version.

Every node is the lowercase hex SHA-256 of its inputs, concatenated as text.

Cases: a null value is the text ``-``, an empty one ``0:``; a null group comes first; null ids
come first in their group and are never tampered in the registered query; rows with equal ids
keep their rows, in the order of their leaves, and equal rows are equal leaves beside each
other; a lone leaf is its group's subroot and a lone subroot the root; an empty table gives an
empty result.  Columns that are not named are ignored, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vantage.llm.common import materialize
from vantage.llm.numbering import numbered

#: children of a node; nodes of a block (two levels)
RUN, BLOCK = 16, 256
_PATH = "array<struct<before:string,after:string>>"


def _digest(c: Column) -> Column:
    return F.sha2(c, 256)


def _field(c: Column) -> Column:
    value = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf_digest(values: list[Column]) -> Column:
    """Digest of a row: each value as its length in UTF-8 bytes, ``:`` and itself."""
    return _digest(F.concat(*map(_field, values)))


def _joined(nodes: Column, start, size) -> Column:
    return F.array_join(F.slice(nodes, start, size), "")


def _blocks(nodes: DataFrame, name: str) -> DataFrame:
    """A table of blocks from nodes (g, pos, total, node struct with ``digest``)."""
    rows = (nodes.groupBy("g", F.expr(f"pos div {BLOCK}").alias("b"))
            .agg(F.max("total").alias("total"),  # at most BLOCK nodes in a list
                 F.array_sort(F.collect_list(F.struct("pos", "node"))).alias("at")))
    rows = rows.select("g", "b", "total", F.col("at.node").alias("nodes"), F.col("at.node.digest").alias("low"))
    runs = F.sequence(F.lit(0), F.expr(f"cast(ceil(size(low) / {RUN}) as int) - 1"))
    rows = rows.withColumn("high", F.transform(runs, lambda i: _digest(_joined(F.col("low"), i * RUN + 1, F.lit(RUN)))))
    depth = F.when(F.col("total") <= 1, 0).when(F.col("total") <= RUN, 1).otherwise(2)
    rows = rows.withColumn("depth", depth)
    top = (F.when(F.col("depth") == 0, F.col("low")[0]).when(F.col("depth") == 1, F.col("high")[0])
           .otherwise(_digest(F.array_join("high", ""))))
    return materialize(rows.withColumn("digest", top), name)


def _grow(nodes: DataFrame, most: int, name: str) -> list[DataFrame]:
    """Tables of blocks from the lowest to the one whose blocks are their groups' roots."""
    tables = []
    while True:
        tables.append(_blocks(nodes, f"{name}{len(tables)}"))
        most = -(-most // BLOCK)
        if most <= 1:
            return tables
        nodes = tables[-1].select("g", F.col("b").alias("pos"), F.expr(f"cast(ceil(total / {BLOCK}) as bigint)").alias("total"),
                                  F.struct("digest").alias("node"))


def _paths(blocks: DataFrame) -> DataFrame:
    """One row a node of the blocks (with ``up``, the path above the block): its place, the
    node, and its path, the siblings left and right of it on each level."""
    j = F.col("j")
    run = F.expr(f"cast(j div {RUN} as int)")
    own = F.array(
        F.struct(_joined(F.col("low"), run * RUN + 1, j % RUN).alias("before"),
                 _joined(F.col("low"), j + 2, F.lit(RUN - 1) - j % RUN).alias("after")),
        F.struct(_joined(F.col("high"), F.lit(1), run).alias("before"),
                 _joined(F.col("high"), run + 2, F.lit(RUN)).alias("after")))
    return (blocks.select("*", F.posexplode("nodes").alias("j", "node"))
            .select(*(c for c in blocks.columns if c not in ("nodes", "low", "high", "depth", "digest", "up", "total")), "j", "node",
                    F.concat(F.slice(own, F.lit(1), F.col("depth")), F.col("up")).cast(_PATH).alias("path")))


def _descend(tables: list[DataFrame], top: DataFrame) -> DataFrame:
    """The lowest table of blocks with ``up`` and the columns that ``top`` has for each g."""
    more = [c for c in top.columns if c not in ("g", "up")]
    for k, blocks in enumerate(reversed(tables)):
        below = blocks.join(top, ["g"] if not k else ["g", "b"])
        if k == len(tables) - 1:
            return below
        top = _paths(below).select("g", F.expr(f"b * {BLOCK} + j").alias("b"), F.col("path").alias("up"), *more)


def merkle_manifest(df: DataFrame, columns: list[str], id_col: str = "doc_id", group_col: str = "source",
                    tampered: Column | None = None, tamper: Callable[[str, Column], Column] | None = None) -> DataFrame:
    """One row per row of ``df``: the id, ``leaf``, ``subroot`` of its group, ``root``,
    ``path`` (siblings ``before`` and ``after`` of each level, leaf to root), ``altered`` (the
    tampered leaf, else null), ``copied`` (the version's own nodes, from its leaf to its root;
    of an untampered leaf, the nodes recomputed).

    ``tampered`` says which rows are; ``tamper(name, value)`` gives a column's tampered value."""
    row = [F.col(c) for c in columns]
    other = leaf_digest([tamper(c, F.col(c)) for c in columns]) if tamper else F.lit(None).cast("string")
    group = F.coalesce(F.concat(F.lit("="), F.col(group_col).cast("string")), F.lit(""))  # a null sorts first
    leaves = materialize(df.select(group.alias("g"), F.col(id_col).alias("id"), leaf_digest(row).alias("digest"),
                                   F.when(tampered if tampered is not None else F.lit(False), other).alias("altered")), "leaves")
    placed = numbered(leaves, ["id", "digest"], ["g"])
    most = leaves.groupBy("g").count().agg(F.max("count")).first()[0] or 0
    low = _grow(placed.select("g", "pos", "total", F.struct("digest", "id", "altered").alias("node")), most, "block")

    subroots = low[-1].select(F.col("g").alias("own"), "digest")
    groups = numbered(materialize(subroots, "subroots"), ["own"])
    high = _grow(groups.select(F.lit("").alias("g"), "pos", "total", F.struct("digest", "own").alias("node")),
                 subroots.count(), "upper")
    last = high[-1].select("digest").first()  # one row
    nothing = F.array().cast(_PATH)
    above = high[-1].select("g", nothing.alias("up"))
    tops = _paths(_descend(high, above)).select(F.col("node.own").alias("g"), F.col("node.digest").alias("subroot"),
                                                F.col("path").alias("up"))
    leaf = _paths(_descend(low, tops))
    start = F.array(F.coalesce("node.altered", "node.digest"))
    copied = F.aggregate("path", start, lambda acc, s: F.array_append(
        acc, _digest(F.concat(s["before"], F.element_at(acc, -1), s["after"]))))
    return leaf.select(F.col("node.id").alias(id_col), F.col("node.digest").alias("leaf"), "subroot",
                       F.lit(last[0] if last else None).cast("string").alias("root"), "path",
                       F.col("node.altered").alias("altered"), copied.alias("copied"))


def proof_digest(path: Column) -> Column:
    """Digest of all siblings of a path, level by level, left to right."""
    return _digest(F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), ""))
