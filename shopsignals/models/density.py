"""Density clusters of points, with noise, from the tree of mutual reachability.

The hierarchy: the *core distance* of a point is the distance to its
``min_samples``-th nearest other point; the *reachability* of two points is the
largest of their core distances and their own distance.  Lowering a threshold on
the edges of the minimum spanning tree of reachability splits the points; parts
of fewer than ``min_cluster_size`` points fall out, and a split into two larger
parts makes two new clusters.  Of nested clusters those with the greatest excess
of mass are chosen; points that fell out of them before are noise (-1).  How
much noise there is depends on the data, not on a parameter.

Everything is exact:

1. Points lie in boxes of about ``BLOCK`` points: a k-d tree of at most
   ``LEAVES`` leaves, cut on the driver from a sample of ``SAMPLE`` points (it
   only decides how even and compact the boxes are).
2. Core distances: each box with itself gives an upper bound for its points;
   only pairs of boxes nearer than that are compared further.  A task compares
   two groups of up to ``GROUP`` boxes, a pair of boxes at a time, so a point is
   sent once per group of boxes near its own.
3. The spanning tree grows by Borůvka rounds: in each, every part takes its
   smallest outgoing edge (ties by the ids of its ends, so no cycle arises).  The
   best edge inside the boxes bounds which pairs of boxes are compared.  Parts
   halve at least; pointers to the part joined are followed by joins.
4. Edges are merged in order of weight, in runs of ``RUN`` edges: a run is one
   group of bounded size, whatever the number of points; parts and their sizes
   go from run to run as tables.  Points learn at which weight they became part
   of a cluster, clusters at which weight they merged.
5. The tree of clusters (at most twice the points by ``min_cluster_size``) is
   valued on the driver from sums per cluster.

Work grows with the pairs of boxes that are near each other; no task holds more
than two groups of boxes or one run.

Defined results: ids must be unique; points with a null or non-finite entry are
noise and not compared; fewer than two points, or no split into two clusters,
give noise only; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopsignals.session import materialize

BLOCK = 1024
LEAVES = 2048
#: boxes of a group at most, and groups aimed at while there are fewer boxes than that many groups hold
GROUP = 16
GROUPS = 32
SAMPLE = 20_000
RUN = 500_000
#: reachability below this counts as this: copies of a point have distance 0
LEAST = 1e-12


# ---------------------------------------------------------------- boxes


def split_tree(sample: np.ndarray, depth: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per level: dimension and cut of every node (widest dimension at its median)."""
    levels, parts = [], [sample]
    for _ in range(depth):
        dims = np.array([int(np.argmax(np.ptp(p, axis=0))) if len(p) else 0 for p in parts])
        cuts = np.array([float(np.median(p[:, d])) if len(p) else 0.0 for p, d in zip(parts, dims)])
        parts = [q for p, d, c in zip(parts, dims, cuts) for q in (p[p[:, d] <= c], p[p[:, d] > c])]
        levels.append((dims, cuts))
    return levels


def leaf_of(x: np.ndarray, levels) -> np.ndarray:
    at = np.zeros(len(x), np.int64)
    for dims, cuts in levels:
        at = 2 * at + (x[np.arange(len(x)), dims[at]] > cuts[at])
    return at


def _points(column: pd.Series) -> np.ndarray:
    return np.array(column.tolist(), float)


def in_boxes(points: DataFrame, n: int) -> DataFrame:
    """``id, x, block``."""
    sample = np.array([r["x"] for r in points.orderBy(F.xxhash64("id")).limit(SAMPLE).select("x").collect()], float)
    depth = max(0, int(np.ceil(np.log2(min(LEAVES, max(1, n / BLOCK))))))
    levels = split_tree(sample, depth)

    def place(frames):
        for f in frames:
            yield f.assign(block=leaf_of(_points(f["x"]), levels) if len(f) else pd.Series(dtype="int64"))

    return materialize(points.select("id", "x").mapInPandas(place, "id long, x array<double>, block long"))


def box_distances(points: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(block numbers, smallest possible distance between the boxes of any two)."""
    long = points.select("block", F.posexplode("x").alias("d", "v")).groupBy("block", "d").agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    rows = long.toPandas().sort_values(["block", "d"])
    blocks = np.sort(rows["block"].unique())
    lo, hi = (rows[c].to_numpy().reshape(len(blocks), -1) for c in ("lo", "hi"))
    total = np.zeros((len(blocks), len(blocks)))
    for d in range(lo.shape[1]):
        gap = np.maximum(0.0, np.maximum(lo[:, None, d] - hi[None, :, d], lo[None, :, d] - hi[:, None, d]))
        total += gap**2
    return blocks, np.sqrt(total)


def _units(points: DataFrame, pairs: list[tuple[int, int]], columns: list[str]) -> tuple[DataFrame, dict[tuple[int, int], list[tuple[int, int]]]]:
    """(rows ``a, b, block`` and columns: the points of every unit, pairs of boxes per unit).

    A unit compares two groups of boxes that follow each other in the tree, and
    holds each point of the boxes that it needs once, whatever number of pairs
    they are in: a point travels to one unit per group near it, not per box.
    """
    size = max(1, min(GROUP, -(-(1 + max(map(max, pairs), default=0)) // GROUPS)))
    within: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for a, b in pairs:
        within.setdefault((min(a, b) // size, max(a, b) // size), []).append((a, b))
    needed = sorted({(box, *unit) for unit, own in within.items() for pair in own for box in pair})
    # at most two groups of boxes per unit
    table = F.broadcast(points.sparkSession.createDataFrame(needed or [(-1, -1, -1)], "block long, a long, b long"))
    return points.select("block", *columns).join(table, "block"), within


def _boxes(rows: pd.DataFrame) -> dict[int, pd.DataFrame]:
    """The boxes of a unit, ascending by id."""
    return {int(box): own for box, own in rows.sort_values("id").groupby("block")}


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    # one coordinate at a time: exact for near points, unlike the expanded product
    return np.sqrt(sum((x[:, [d]] - y[:, d]) ** 2 for d in range(x.shape[1])))


# ---------------------------------------------------------------- core distances


def _nearest(points: DataFrame, pairs: list[tuple[int, int]], k: int) -> DataFrame:
    """``id, near``: the ``k`` smallest distances of the points of box ``a`` to others in box ``b``."""

    units, within = _units(points, pairs, ["id", "x"])

    def near(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        boxes = {box: (own["id"].to_numpy(), _points(own["x"])) for box, own in _boxes(rows).items()}
        found: dict[int, np.ndarray] = {}
        for a, b in within[key[0], key[1]]:
            if a not in boxes or b not in boxes:
                continue
            d = _distances(boxes[a][1], boxes[b][1])
            if a == b:
                np.fill_diagonal(d, np.inf)
            d = np.partition(d, min(k, d.shape[1]) - 1, axis=1)[:, :k]
            found[a] = np.sort(np.hstack([found[a], d]) if a in found else d, axis=1)[:, :k]
        ids = np.concatenate([boxes[a][0] for a in found]) if found else np.zeros(0, np.int64)
        return pd.DataFrame({"id": ids, "near": [r[np.isfinite(r)].tolist() for d in found.values() for r in d]})

    return units.groupBy("a", "b").applyInPandas(near, "id long, near array<double>")


def with_core_distance(points: DataFrame, k: int) -> tuple[DataFrame, np.ndarray, np.ndarray]:
    """(``id, x, block, core``, block numbers, box distances)."""
    blocks, apart = box_distances(points)
    own = materialize(_nearest(points, [(int(b), int(b)) for b in blocks], k))
    bound = points.select("id", "block").join(own, "id").groupBy("block").agg(F.max(F.when(F.size("near") >= k, F.element_at("near", k)).otherwise(float("inf"))).alias("u"))
    u = {r["block"]: r["u"] for r in bound.collect()}
    pairs = [(int(a), int(b)) for i, a in enumerate(blocks) for j, b in enumerate(blocks) if i != j and apart[i, j] <= u[a]]
    every = own.unionByName(_nearest(points, pairs, k)) if pairs else own
    merged = every.groupBy("id").agg(F.sort_array(F.flatten(F.collect_list("near"))).alias("near"))
    core = merged.select("id", F.when(F.size("near") >= k, F.get("near", F.lit(k - 1))).otherwise(F.array_max("near")).alias("core"))
    return materialize(points.join(core, "id").select("id", "x", "block", F.coalesce("core", F.lit(0.0)).alias("core"))), blocks, apart


# ---------------------------------------------------------------- spanning tree


def _outgoing(points: DataFrame, pairs: list[tuple[int, int]]) -> DataFrame:
    """``part, w, lo, hi, other``: per unit the smallest edge that leaves each part."""

    units, within = _units(points, pairs, ["id", "x", "core", "part"])

    def best(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        boxes = {box: (own["id"].to_numpy(), own["part"].to_numpy(), own["core"].to_numpy(), _points(own["x"])) for box, own in _boxes(rows).items()}
        found = [pd.DataFrame({c: pd.Series(dtype=t) for c, t in (("part", "int64"), ("w", float), ("lo", "int64"), ("hi", "int64"), ("other", "int64"))})]
        for a, b in within[key[0], key[1]]:
            if a not in boxes or b not in boxes:
                continue
            own, other = boxes[a], boxes[b]
            w = np.maximum(_distances(own[3], other[3]), np.maximum(own[2][:, None], other[2][None, :]))
            w[own[1][:, None] == other[1][None, :]] = np.inf
            for (p_ids, p_parts, *_), (q_ids, q_parts, *_), m in ((own, other, w), (other, own, w.T)):
                # both sides ascend by id: the first smallest weight is the edge of the smallest ids
                at = np.argmin(m, axis=1)
                weight, ends = m[np.arange(len(p_ids)), at], q_ids[at]
                leaves = np.isfinite(weight)
                edge = {"part": p_parts, "w": weight, "lo": np.minimum(p_ids, ends), "hi": np.maximum(p_ids, ends), "other": q_parts[at]}
                found.append(pd.DataFrame({c: v[leaves] for c, v in edge.items()}))
        out = pd.concat(found[1:] or found).sort_values(["part", "w", "lo", "hi"])
        return out.groupby("part", as_index=False).first()

    return units.groupBy("a", "b").applyInPandas(best, "part long, w double, lo long, hi long, other long")


def _least(edges: DataFrame) -> DataFrame:
    return edges.groupBy("part").agg(F.min(F.struct("w", "lo", "hi", "other")).alias("e")).select("part", "e.*")


def _roots(chosen: DataFrame) -> DataFrame:
    """``part, root``: what following the chosen edges ends in."""
    back = chosen.select(F.col("part").alias("other"), F.col("other").alias("back"))
    step = chosen.join(back, "other", "left")
    # two parts that choose each other: the smaller is the root
    root = materialize(step.select("part", F.when((F.col("back") == F.col("part")) & (F.col("part") < F.col("other")), F.col("part")).otherwise(F.col("other")).alias("root")))
    while True:
        ahead = root.select(F.col("part").alias("root"), F.col("root").alias("next"))
        moved = materialize(root.join(ahead, "root", "left").select("part", F.coalesce("next", "root").alias("root"), (F.coalesce("next", "root") != F.col("root")).alias("moved")))
        root = moved.select("part", "root")
        if not moved.where("moved").limit(1).count():
            return root


def spanning_tree(points: DataFrame, blocks: np.ndarray, apart: np.ndarray) -> DataFrame:
    """``w, lo, hi``: the minimum spanning tree of reachability of ``id, x, block, core``."""
    parts, edges = materialize(points.select("id", F.col("id").alias("part"))), []
    own = [(int(b), int(b)) for b in blocks]
    while True:
        now = points.join(parts, "id")
        best = materialize(_least(_outgoing(now, own)))
        # an upper bound of each part's edge tells which pairs of boxes can hold a smaller one
        reach = parts.join(best.select("part", "w"), "part", "left").join(points.select("id", "block"), "id")
        u = {r["block"]: r["u"] for r in reach.groupBy("block").agg(F.max(F.coalesce("w", F.lit(float("inf")))).alias("u")).collect()}
        pairs = [(int(a), int(blocks[j])) for i, a in enumerate(blocks) for j in range(i + 1, len(blocks)) if apart[i, j] <= max(u[a], u[blocks[j]])]
        chosen = materialize(_least(best.unionByName(_outgoing(now, pairs)))) if pairs else best
        if not chosen.limit(1).count():
            break
        edges.append(materialize(chosen.select("w", "lo", "hi").distinct()))
        parts = materialize(parts.join(_roots(chosen), "part", "left").select("id", F.coalesce("root", "part").alias("part")))
    if not edges:
        return points.sparkSession.createDataFrame([], "w double, lo long, hi long")
    out = edges[0]
    for e in edges[1:]:
        out = out.unionByName(e)
    return materialize(out)


# ---------------------------------------------------------------- clusters of the tree


def merge_run(edges: list[tuple[float, int, int]], size: dict[int, int], cluster: dict[int, int], least: int, fresh: int):
    """Merges parts along edges in order.

    ``size`` and ``cluster`` (-1 for none) per part.  Returns (part -> (top part,
    weight at which it became part of a cluster or None, that cluster)), the size
    and cluster of every top part, and births and merges (cluster, left, right, weight).
    """
    up = {p: p for p in size}
    size, cluster, members = dict(size), dict(cluster), {p: [p] for p in size if cluster[p] < 0}
    joined: dict[int, tuple[float, int]] = {}
    made = []

    def find(p):
        while up[p] != p:
            up[p] = up[up[p]]
            p = up[p]
        return p

    for w, a, b in edges:
        a, b = find(a), find(b)
        if a == b:
            continue
        ca, cb = cluster[a], cluster[b]
        total = size[a] + size[b]
        if ca >= 0 and cb >= 0:
            now = fresh + len(made)
            made.append((now, ca, cb, w))
        elif ca >= 0 or cb >= 0:
            now = max(ca, cb)
        elif total >= least:
            now = fresh + len(made)
            made.append((now, -1, -1, w))
        else:
            now = -1
        up[b] = a
        size[a], cluster[a] = total, now
        waiting = members.pop(a, []) + members.pop(b, [])
        if now >= 0:
            joined.update((p, (w, now)) for p in waiting)
        else:
            members[a] = waiting
    tops = {p: find(p) for p in up}
    return tops, joined, {t: (size[t], cluster[t]) for t in set(tops.values())}, made


def _run_group(edges: DataFrame, parts: DataFrame, least: int, fresh: int) -> DataFrame:
    """One run as one bounded group of ``w, a, b, lo, hi`` and ``part, size, cluster``.

    ``kind`` 0: part ``a``, its top ``b``, weight ``w`` and cluster ``c`` that it
    joins; 1: top ``a``, its size ``b`` and cluster ``c``; 2: cluster ``a`` made of
    ``b`` and ``c`` at ``w``.
    """
    zero = F.lit(0).cast("long")
    rows = edges.select(F.lit(0).alias("kind"), "w", "a", "b", "lo", "hi").unionByName(
        parts.select(F.lit(1).alias("kind"), F.lit(0.0).alias("w"), F.col("part").alias("a"), F.col("size").alias("b"), F.col("cluster").alias("lo"), zero.alias("hi"))
    )

    def run(table: pd.DataFrame) -> pd.DataFrame:
        known = table[table["kind"] == 1]
        size, cluster = (dict(zip(known["a"].tolist(), known[c].tolist())) for c in ("b", "lo"))
        e = table[table["kind"] == 0].sort_values(["w", "lo", "hi"])
        tops, joined, after, made = merge_run(list(zip(e["w"].tolist(), e["a"].tolist(), e["b"].tolist())), size, cluster, least, fresh)
        out = [(0, p, t, *joined.get(p, (np.nan, -1))) for p, t in tops.items()]
        out += [(1, t, s, np.nan, c) for t, (s, c) in after.items()]
        out += [(2, c, left, w, right) for c, left, right, w in made]
        return pd.DataFrame(out, columns=["kind", "a", "b", "w", "c"])

    return rows.withColumn("run", F.lit(0)).groupBy("run").applyInPandas(run, "kind int, a long, b long, w double, c long")


@dataclass
class Tree:
    """Clusters of the hierarchy and, per point, the cluster that it first became part of."""

    points: DataFrame  #: id, cluster (-1 for none), w
    clusters: list[tuple[int, int, int, float]]  #: cluster, left, right (-1 at a birth), weight


def cluster_tree(ids: DataFrame, edges: DataFrame, min_cluster_size: int, run: int | None = None) -> Tree:
    run = run or RUN
    edges = materialize(edges.withColumn("w", F.greatest("w", F.lit(LEAST))))
    n, cuts = edges.count(), [-1.0]
    # weights that cut the edges into runs; equal weights stay together
    if n > run:
        shares = [k * run / n for k in range(1, -(-n // run))]
        cuts += sorted(set(edges.approxQuantile("w", shares, 0.25 * run / n)))
    cuts.append(float("inf"))
    points = materialize(ids.select("id", F.col("id").alias("part"), F.lit(-1).cast("long").alias("cluster"), F.lit(None).cast("double").alias("w")))
    parts = materialize(ids.select(F.col("id").alias("part"), F.lit(1).cast("long").alias("size"), F.lit(-1).cast("long").alias("cluster")))
    clusters: list[tuple[int, int, int, float]] = []
    for low, high in zip(cuts[:-1], cuts[1:]):
        own = edges.where((F.col("w") > low) & (F.col("w") <= high))
        at = points.select("id", "part")
        ends = own.join(at.select(F.col("id").alias("lo"), F.col("part").alias("a")), "lo").join(at.select(F.col("id").alias("hi"), F.col("part").alias("b")), "hi")
        ends = materialize(ends.select("w", "a", "b", "lo", "hi"))
        touched = ends.select(F.col("a").alias("part")).union(ends.select("b")).distinct()
        out = materialize(_run_group(ends, parts.join(touched, "part", "left_semi"), min_cluster_size, len(clusters)))
        clusters += [(r["a"], r["b"], r["c"], r["w"]) for r in out.where("kind = 2").orderBy("a").collect()]
        moved = out.where("kind = 0").select(F.col("a").alias("part"), F.col("b").alias("top"), F.col("w").alias("at"), F.col("c").alias("joins"))
        points = points.join(moved, "part", "left").select(
            "id", F.coalesce("top", "part").alias("part"), F.when((F.col("cluster") < 0) & (F.col("joins") >= 0), F.col("joins")).otherwise(F.col("cluster")).alias("cluster"),
            F.when((F.col("cluster") < 0) & (F.col("joins") >= 0), F.col("at")).otherwise(F.col("w")).alias("w"),
        )
        points = materialize(points)
        tops = out.where("kind = 1").select(F.col("a").alias("part"), F.col("b").alias("size"), F.col("c").alias("cluster"))
        parts = materialize(parts.join(touched, "part", "left_anti").unionByName(tops))
    return Tree(points.select("id", "cluster", "w"), clusters)


def selected(clusters: list[tuple[int, int, int, float]], joined: dict[int, tuple[int, float]]) -> dict[int, int]:
    """Label of every cluster: that of the chosen cluster it lies in, or -1.

    ``joined``: per cluster the number of points that became part of it alone, and
    the sum of 1 / weight over them.
    """
    kids = {c: [k for k in (left, right) if k >= 0] for c, left, right, _ in clusters}
    merged = {c: w for c, _, _, w in clusters}
    parent = {k: c for c, ks in kids.items() for k in ks}
    points, worth, chosen = {}, {}, {}
    for c, *_ in clusters:  # children come before their parents
        n, mass = joined.get(c, (0, 0.0))
        born = 1.0 / merged[parent[c]] if c in parent else 0.0
        inside = sum(points[k] for k in kids[c])
        points[c] = n + inside
        own = mass - n * born + (inside * (1.0 / merged[c] - born) if inside else 0.0)
        below = sum(worth[k] for k in kids[c])
        is_root = c not in parent
        chosen[c] = not is_root and not (kids[c] and below > own)
        worth[c] = own if chosen[c] else below
    label, numbers = {}, {}
    for c, *_ in reversed(clusters):
        above = label.get(parent[c], -1) if c in parent else -1
        if above >= 0:
            label[c] = above
        elif chosen[c]:
            label[c] = numbers.setdefault(c, len(numbers))
        else:
            label[c] = -1
    return label


def density_clusters(vectors: DataFrame, min_cluster_size: int, min_samples: int, id_col: str = "id", vector_col: str = "x") -> DataFrame:
    """``id, label``: -1 for noise; labels are numbered from 0."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("x"))
    usable = materialize(rows.where(F.col("x").isNotNull() & F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))))
    n = usable.count()
    if n < 2:
        return rows.select("id", F.lit(-1).alias("label"))
    points, blocks, apart = with_core_distance(in_boxes(usable, n), min_samples)
    tree = cluster_tree(points.select("id"), spanning_tree(points, blocks, apart), min_cluster_size)
    sums = tree.points.where("cluster >= 0").groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.sum(1 / F.col("w")).alias("mass"))
    label = selected(tree.clusters, {r["cluster"]: (r["n"], r["mass"]) for r in sums.collect()})
    # one row per cluster
    names = vectors.sparkSession.createDataFrame(list(label.items()) or [(-1, -1)], "cluster long, label int")
    found = tree.points.join(F.broadcast(names), "cluster", "left").select("id", "label")
    return rows.select("id").join(found, "id", "left").select("id", F.coalesce("label", F.lit(-1)).alias("label"))
