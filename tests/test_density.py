"""Density clusters against a plain hierarchy over all pairs."""

import numpy as np
import pytest

from shopsignals.models import density

DDL = "id long, x array<double>"


def blobs(seed, n):
    rng = np.random.default_rng(seed)
    parts = [rng.normal(c, s, (m, 3)) for c, s, m in ((0, 0.4, n // 4), (3, 0.3, n // 5), (3.9, 0.25, n // 6), (-4, 0.9, n // 8))]
    parts.append(rng.uniform(-8, 8, (n - sum(map(len, parts)), 3)))
    x = np.concatenate(parts)
    x[5] = x[6] = x[7]  # copies
    return x[rng.permutation(n)]


def plain(x, least, k):
    """Top-down condensed tree, excess of mass: (labels, spanning tree edges)."""
    n = len(x)
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    core = np.sort(d + np.diag([np.inf] * n), axis=1)[:, min(k, n - 1) - 1]
    r = np.maximum(np.maximum(d, core[:, None]), core[None, :])
    edges, inside = [], np.zeros(n, bool)
    edge_of = sorted((r[i, j], i, j) for i in range(n) for j in range(i + 1, n))
    group = list(range(n))

    def find(p):
        while group[p] != p:
            p = group[p]
        return p

    for w, i, j in edge_of:  # Kruskal over all pairs
        a, b = find(i), find(j)
        if a != b:
            group[a] = b
            edges.append((max(w, density.LEAST), i, j))
    labels, total = np.full(n, -1), [0]

    def part_of(nodes, own):
        """The two sides of the largest of ``own`` edges."""
        rest = own[:-1]
        near = {v: [] for v in nodes}
        for _, i, j in rest:
            near[i].append(j)
            near[j].append(i)
        seen, todo = {own[-1][1]}, [own[-1][1]]
        while todo:
            for v in near[todo.pop()]:
                if v not in seen:
                    seen.add(v)
                    todo.append(v)
        sides = [seen, set(nodes) - seen]
        return [(s, [e for e in rest if e[1] in s]) for s in sides]

    def grow(nodes, own, born):
        """(worth, labels of the best choice inside, points) of a cluster born at 1 / weight ``born``."""
        worth, start = 0.0, set(nodes)
        while own:
            at = 1 / own[-1][0]
            sides = part_of(nodes, own)
            large = [s for s in sides if len(s[0]) >= least]
            if len(large) == 2:
                worth += len(nodes) * (at - born)
                kids = [grow(*s, at) for s in large]
                below = sum(k[0] for k in kids)
                if below > worth:
                    return below, kids[0][1] + kids[1][1]
                return worth, [start]
            fallen = sum(len(s[0]) for s in sides if len(s[0]) < least)
            worth += fallen * (at - born)
            if not large:
                return worth, [start]
            nodes, own = large[0]
        return worth, [start]

    nodes, own = set(range(n)), edges
    while own:  # the root is no cluster; follow it to its first split
        sides = part_of(nodes, own)
        large = [s for s in sides if len(s[0]) >= least]
        if len(large) == 2:
            for s in large:
                for chosen in grow(*s, 1 / own[-1][0])[1]:
                    labels[list(chosen)] = total[0]
                    total[0] += 1
            break
        if not large:
            break
        nodes, own = large[0]
    return labels, edges


def same(a, b):
    """Equal up to the numbers of the labels."""
    pairs = set(zip(a.tolist(), b.tolist()))
    return len(pairs) == len(set(a.tolist())) == len(set(b.tolist())) and all((x == -1) == (y == -1) for x, y in pairs)


@pytest.mark.parametrize(("seed", "least", "k"), [(1, 20, 5)])
def test_equals_the_plain_hierarchy(spark, monkeypatch, seed, least, k):
    monkeypatch.setattr(density, "BLOCK", 60)
    monkeypatch.setattr(density, "RUN", 130)
    x = blobs(seed, 500)
    want, edges = plain(x, least, k)
    df = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(x)], DDL).repartition(4)
    points, blocks, apart = density.with_core_distance(density.in_boxes(df, len(x)), k)
    assert len(blocks) > 4
    tree = density.spanning_tree(points, blocks, apart)
    assert np.allclose(sorted(r["w"] for r in tree.collect()), sorted(w for w, _, _ in edges), atol=1e-9)
    got = {r["id"]: r["label"] for r in density.density_clusters(df, least, k).collect()}
    got = np.array([got[i] for i in range(len(x))])
    assert same(got, want) and len(set(got.tolist())) >= 4 and 0 < (got == -1).mean() < 0.6


def test_noise_is_no_fixed_share(spark):
    rng = np.random.default_rng(9)
    tight = np.concatenate([rng.normal(c, 0.05, (60, 2)) for c in (0, 5, 9)])
    share = {}
    for name, x in (("tight", tight), ("spread", np.concatenate([tight, rng.uniform(-30, 30, (90, 2))]))):
        got = density.density_clusters(spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(x)], DDL), 20, 5).collect()
        assert {r["label"] for r in got} >= {0, 1, 2}
        share[name] = sum(r["label"] == -1 for r in got) / len(got)
    assert share["tight"] < 0.15 < 0.25 < share["spread"]


def test_missing_entries_and_small_tables(spark):
    rows = [(1, None), (2, [1.0, None]), (3, [float("nan"), 1.0]), (4, [0.0, 0.0])]
    assert {r["id"]: r["label"] for r in density.density_clusters(spark.createDataFrame(rows, DDL), 2, 1).collect()} == {1: -1, 2: -1, 3: -1, 4: -1}
    assert density.density_clusters(spark.createDataFrame([], DDL), 2, 1).count() == 0
    pair = density.density_clusters(spark.createDataFrame([(1, [0.0]), (2, [1.0])], DDL), 2, 1).collect()
    assert [r["label"] for r in pair] == [-1, -1]


def test_a_point_travels_once_per_group_of_boxes(spark):
    """All pairs of 64 boxes: 32 groups of two, so 32 rows a point (it was one row per pair of boxes)."""
    points = spark.range(640).selectExpr("id", "array(cast(id AS double)) AS x", "id % 64 AS block")
    pairs = [(a, b) for a in range(64) for b in range(64) if a != b]
    units, within = density._units(points, pairs, ["id", "x"])
    assert {r["count"] for r in units.groupBy("id").count().collect()} == {32}
    assert sorted(p for own in within.values() for p in own) == pairs
    assert units.groupBy("a", "b", "id").count().where("count > 1").isEmpty()
