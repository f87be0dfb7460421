"""Merkle manifest of a table, with a proof per row.

A row's *leaf* is the SHA-256 (lower-case hex) of its fields, each ``-`` if
null and otherwise its UTF-8 byte count, ``:`` and its text.  The leaves of a
group ascend by id; while several nodes remain, every ``fanout`` consecutive
ones (the last run may be shorter) become the hash of their hex texts.  What
remains is the group's *subroot*.  The subroots, ordered by group (null first,
bytewise), give the *root* likewise.  A *proof* holds, level by level from the
leaf to the root, the siblings left and right of the path.

Plan:

1. *Leaves* are hashed in the scan; only ids, groups and digests travel.
2. *Positions*: leaves are dealt by ranges of (group, id, digest, row number), so a
   hot group or id spreads over many tasks; a leaf's position is its number in
   its task's range plus the group's leaves in earlier ranges (counts per task
   and group).
3. *Up*: a *superblock* is ``fanout ** height`` consecutive nodes of a group.
   ``applyInPandas`` reduces each to one node; the nodes of all superblocks are
   the next table, ``fanout ** height`` times shorter, until every group has
   one node.  Subroots form one more group, reduced in the same way.
4. *Subtree exchange*, from the root down: the nodes of a table and the outer
   part of their superblock's proof (one row per superblock) are cogrouped by
   superblock in ``applyInPandas``.  There the local reduction is finished, its
   siblings are joined with the outer ones to the proof of every node, and (for
   leaves) the claimed leaf is folded along it to a root.  The proofs of a
   table are the outer parts for the table below.

No task holds more than a superblock or one range of short rows, and each
table is written once, so lost executors cost their own tasks only.

Defined results: ids that repeat, or are null (first), are ordered by leaf;
rows equal in all fields have equal leaves and either order gives the same
tree (their proofs go out in some order); a group of one leaf has it as subroot
and a single group's subroot is the root; an empty table gives an empty result;
columns that are neither fields nor id nor group are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopsignals.llm.common import materialize

FANOUT = 2
#: levels of a superblock: 2 ** 10 nodes
HEIGHT = 10
#: a table of offsets with more rows than this is joined by shuffle
OFFSET_ROWS = 100_000


def field_text(value: Column) -> Column:
    """``-`` for null, else byte count, ``:``, value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(fields: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[field_text(f) for f in fields]), 256)


def digest(parts: Sequence[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def reduce_levels(nodes: list[str], fanout: int, levels: int | None = None) -> list[list[str]]:
    """The nodes of every level, lowest first; ``levels`` hashings, or as many as leave one node."""
    out = [nodes]
    while (len(out[-1]) > 1) if levels is None else (len(out) <= levels):
        last = out[-1]
        out.append([digest(last[i : i + fanout]) for i in range(0, len(last), fanout)])
    return out


def siblings(levels: list[list[str]], at: int, fanout: int) -> tuple[list[str], list[str]]:
    """Per level below the top: the joined siblings left and right of the path from node ``at``."""
    left, right = [], []
    for nodes in levels[:-1]:
        first = at - at % fanout
        left.append("".join(nodes[first:at]))
        right.append("".join(nodes[at + 1 : first + fanout]))
        at //= fanout
    return left, right


def fold(leaf: str, left: Sequence[str], right: Sequence[str]) -> str:
    """The root that a leaf reaches along a proof."""
    sha = hashlib.sha256
    for a, b in zip(left, right):
        leaf = sha((a + leaf + b).encode()).hexdigest()
    return leaf


# ---------------------------------------------------------------- positions


def _small(df: DataFrame, rows: int = OFFSET_ROWS) -> DataFrame:
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def numbered(df: DataFrame, group: str | None, order: Sequence[str]) -> DataFrame:
    """``df`` with ``tree`` (rank of the group, from 0, null first) and ``pos`` (rank in the group, from 0)."""
    keys = ([group] if group else []) + list(order)
    # the row number only spreads equal rows; either order of theirs is right
    dealt = df.withColumn("_m_tie", F.monotonically_increasing_id())
    dealt = dealt.repartitionByRange(*[F.col(k).asc_nulls_first() for k in (*keys, "_m_tie")]).sortWithinPartitions(*[F.col(k).asc_nulls_first() for k in (*keys, "_m_tie")])
    row = F.monotonically_increasing_id()
    placed = materialize(dealt.drop("_m_tie").withColumn("_m_row", row).withColumns({"_m_part": F.shiftright("_m_row", 33), "_m_at": F.col("_m_row") % (1 << 33)}).drop("_m_row"))
    by = ["_m_part"] + ([group] if group else [])
    counts = materialize(placed.groupBy(*by).agg(F.min("_m_at").alias("first"), F.count(F.lit(1)).alias("m")))
    # one row per task and group: at most the number of tasks in each window
    earlier = Window.partitionBy(group) if group else Window.partitionBy(F.lit(0))
    before = F.sum("m").over(earlier.orderBy("_m_part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.withColumn("offset", F.coalesce(before, F.lit(0)) - F.col("first"))
    if group:
        names = counts.select(group).distinct()
        ranked = numbered(names, None, [group]).select(F.col(group).alias("_m_group"), F.col("pos").alias("tree"))
        offsets = offsets.join(ranked, F.col(group).eqNullSafe(F.col("_m_group"))).select(F.col("_m_part").alias("_m_p"), "_m_group", "offset", "tree")
        on = (F.col("_m_part") == F.col("_m_p")) & F.col(group).eqNullSafe(F.col("_m_group"))
    else:
        offsets = offsets.select(F.col("_m_part").alias("_m_p"), "offset", F.lit(0).cast("long").alias("tree"))
        on = F.col("_m_part") == F.col("_m_p")
    return placed.join(_small(materialize(offsets)), on).select(*df.columns, "tree", (F.col("_m_at") + F.col("offset")).alias("pos"))


# ---------------------------------------------------------------- up


def _sized(nodes: DataFrame, block: int) -> DataFrame:
    """Adds ``block`` (superblock number) and ``alone`` (the group has only this one) to ``tree, pos, ...``."""
    trees = _small(materialize(nodes.groupBy("tree").agg((F.max("pos") < block).alias("alone"))))
    return nodes.join(trees, "tree").withColumn("block", F.floor(F.col("pos") / block))


def raised(nodes: DataFrame, fanout: int, height: int) -> DataFrame:
    """``tree, pos, node``: one node per superblock of ``tree, pos, node, block, alone``.

    The only superblock of a tree is hashed down to one node, others ``height`` times.
    """

    def reduce(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("pos")
        top = reduce_levels(rows["node"].tolist(), fanout, None if rows["alone"].iat[0] else height)
        return pd.DataFrame({"tree": [key[0]], "pos": [key[1]], "node": [top[-1][0]]})

    return materialize(nodes.select("tree", "block", "pos", "node", "alone").groupBy("tree", "block").applyInPandas(reduce, "tree long, pos long, node string"))


# ---------------------------------------------------------------- down: the subtree exchange

PATH = "left array<string>, right array<string>, subroot string, root string"


def exchanged(nodes: DataFrame, outer: DataFrame, fanout: int, height: int) -> DataFrame:
    """Proofs of ``tree, pos, node, block, alone``; ``outer``: the proof of each superblock's node.

    ``outer``: tree, block, left, right, subroot, root.  Returns tree, pos, left,
    right, subroot, root per node.
    """

    def join(key: tuple, rows: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("pos")
        levels = reduce_levels(rows["node"].tolist(), fanout, None if rows["alone"].iat[0] else height)
        left, right = list(above["left"].iat[0]), list(above["right"].iat[0])
        paths = [siblings(levels, i, fanout) for i in range(len(rows))]
        return pd.DataFrame({
            "tree": key[0], "pos": rows["pos"], "left": [a + left for a, _ in paths], "right": [b + right for _, b in paths],
            "subroot": above["subroot"].iat[0], "root": above["root"].iat[0],
        })

    a = nodes.select("tree", "block", "pos", "node", "alone").groupBy("tree", "block")
    return a.cogroup(outer.groupBy("tree", "block")).applyInPandas(join, f"tree long, pos long, {PATH}")


def exchanged_leaves(leaves: DataFrame, outer: DataFrame, fanout: int, height: int) -> DataFrame:
    """As ``exchanged``, for leaves: folds the claimed leaf (``claim``, or the leaf itself) along each proof.

    Ids travel as text: pandas has no null in its integers.
    """

    def join(key: tuple, rows: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("pos")
        nodes = rows["node"].tolist()
        levels = reduce_levels(nodes, fanout, None if rows["alone"].iat[0] else height)
        left, right = list(above["left"].iat[0]), list(above["right"].iat[0])
        lefts, rights, folded = [], [], []
        for i, (node, claim) in enumerate(zip(nodes, rows["claim"])):
            a, b = siblings(levels, i, fanout)
            lefts.append(a + left)
            rights.append(b + right)
            folded.append(fold(claim if isinstance(claim, str) else node, lefts[-1], rights[-1]))
        return pd.DataFrame({
            "id": rows["id"], "leaf": nodes, "left": lefts, "right": rights, "subroot": above["subroot"].iat[0], "root": above["root"].iat[0], "folded_root": folded,
        })

    a = leaves.select("tree", "block", "pos", "id", "node", "claim", "alone").groupBy("tree", "block")
    return a.cogroup(outer.groupBy("tree", "block")).applyInPandas(join, f"id string, leaf string, {PATH}, folded_root string").withColumn("id", F.col("id").cast("long"))


def _forest(nodes: DataFrame, fanout: int, height: int) -> tuple[list[DataFrame], DataFrame]:
    """(tables from the nodes up, each with block and alone; the last node of each tree)."""
    tables = [_sized(nodes, fanout**height)]
    while True:
        top = raised(tables[-1], fanout, height)
        if not top.where("pos > 0").limit(1).count():
            return tables, top
        tables.append(_sized(top, fanout**height))


def proofs(rows: DataFrame, fields: Sequence[str], id_col: str, group_col: str, claims: dict[str, Column] | None = None, claimed: Column | None = None, fanout: int = FANOUT, height: int = HEIGHT) -> DataFrame:
    """``id, leaf, left, right, subroot, root, folded_root`` per row.

    ``claims`` replaces fields of the rows where ``claimed`` holds: their
    altered leaf is folded along the proof of the original one.
    """
    column = lambda c: F.col(f"`{c}`")
    changed = claims or {}
    other = F.when(F.coalesce(claimed, F.lit(False)), leaf_hash([changed.get(f, column(f)) for f in fields])) if changed else F.lit(None).cast("string")
    # written first: dealing by ranges reads its input twice, and texts should be hashed once
    leaves = materialize(rows.select(column(id_col).cast("long").alias("id"), column(group_col).alias("grp"), leaf_hash([column(f) for f in fields]).alias("node"), other.alias("claim")))
    placed = materialize(numbered(leaves, "grp", ["id", "node"]).select("tree", "pos", F.col("id").cast("string").alias("id"), "node", "claim"))
    tables, subroots = _forest(placed, fanout, height)
    # subroots are the nodes of one more tree
    tops, root = _forest(subroots.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("pos"), "node"), fanout, height)
    nothing = F.array().cast("array<string>")
    outer = root.select("tree", F.col("pos").alias("block"), nothing.alias("left"), nothing.alias("right"), F.lit(None).cast("string").alias("subroot"), F.col("node").alias("root"))
    for table in reversed(tops):
        found = materialize(exchanged(table, outer, fanout, height))
        outer = found.withColumnRenamed("pos", "block")
    # a tree's last node is its superblock 0 in the table above
    outer = found.select(F.col("pos").alias("tree"), F.lit(0).cast("long").alias("block"), "left", "right", "root")
    outer = outer.join(subroots.select("tree", F.col("node").alias("subroot")), "tree").select("tree", "block", "left", "right", "subroot", "root")
    for table in reversed(tables[1:]):
        outer = materialize(exchanged(table, outer, fanout, height)).withColumnRenamed("pos", "block")
    return exchanged_leaves(tables[0], outer, fanout, height)


#: what a document's leaf covers, in this order
DOCUMENT_FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def document_manifest(docs: DataFrame, modulus: int = 7) -> DataFrame:
    """Manifest of documents by language, checked against a copy in which ``n_chars`` of some rows is one higher."""
    tampered = F.crc32(F.col("doc_id").cast("long").cast("string")) % modulus == 0
    found = proofs(docs, DOCUMENT_FIELDS, "doc_id", "lang", {"n_chars": F.try_add("n_chars", F.lit(1))}, tampered)
    path = F.array_join(F.zip_with("left", "right", lambda a, b: F.concat(a, b)), "")
    return found.select(
        F.col("id").alias("doc_id"), "leaf", "subroot", "root", F.sha2(path, 256).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"),
    )
