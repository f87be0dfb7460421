import random

import numpy as np
import pytest

from shopsignals.llm import components as cc
from shopsignals.llm import near_dup as nd
from tests.llm import helpers as h


def brute(docs, size, threshold=80):
    """Component (smallest id) and set size per document id, from all pairs."""
    sets = {}
    for r in docs:
        sets.setdefault(r["doc_id"], []).append(nd.shingle_set(nd.words_of(r["text"]), size))
    ids = [(i, s) for i, all_sets in sets.items() for s in all_sets]
    group = list(range(len(ids)))

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for a in range(len(ids)):
        for b in range(a):
            x, y = ids[a][1], ids[b][1]
            if x and y and 100 * len(x & y) >= threshold * len(x | y):
                group[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(ids):
        if i is not None:
            root = find(k)
            least[root] = min(i, least.get(root, i))
    return sorted(((i, len(s), least.get(find(k))) for k, (i, s) in enumerate(ids)), key=str)


def corpus(seed=1):
    """Near copies around the threshold, chains, exact copies and a shared passage."""
    rng = random.Random(seed)
    rows, i = [], 100
    passage = h.sentence(rng, 25)
    words = lambda n: [f"w{rng.randrange(5000)}" for _ in range(n)]
    for _ in range(12):
        base = words(rng.choice([6, 30, 80, 200]))
        for _ in range(rng.randrange(1, 7)):
            copy = list(base)
            for _ in range(rng.randrange(0, max(2, len(base) // 25))):
                copy[rng.randrange(len(copy))] = f"x{rng.randrange(5000)}"
            rows.append(h.row(i, " ".join(copy)))
            i += 1
    for _ in range(40):
        rows.append(h.row(i, passage + "\n" + " ".join(words(rng.choice([3, 10, 40])))))
        i += 1
    chain = words(100)
    for _ in range(15):
        rows.append(h.row(i, " ".join(chain)))
        chain[rng.randrange(100)] = f"y{rng.randrange(9000)}"
        i += 1
    rng.shuffle(rows)
    return rows


def check(spark, rows, size):
    df = spark.createDataFrame(rows, h.DOCS_DDL).repartition(5)
    out = nd.near_duplicates(h.clashing(df), size=size).collect()
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in out), key=str) == brute(df.collect(), size)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in out if r["doc_id"] is not None)


def test_matches_all_pairs(spark):
    check(spark, corpus(), 4)


@pytest.mark.parametrize("block", [2, 5])
def test_long_lists_match_all_pairs(spark, monkeypatch, block):
    """Superlists of many blocks, so hubs, contraction and the last units are used."""
    monkeypatch.setattr(nd, "BLOCK", block)
    check(spark, corpus(block), 9 - block)


def star(n, seed=8):
    """Copies of one text with different edits: any similarity from 0.4 to 1, most pairs near the threshold."""
    rng = random.Random(seed)
    base, rows = [f"b{i}" for i in range(120)], []
    for i in range(n):
        copy = list(base)
        for _ in range(rng.choice([0, 1, 2, 3, 5, 8, 12])):
            copy[rng.randrange(120)] = f"e{rng.randrange(40)}"
        rows.append(h.row(1000 + i, " ".join(copy)))
    return rows


def test_one_large_group_of_near_copies(spark):
    """Groups by the product of the whole incidence matrix; the rows that the operator makes grow with members."""
    rows = star(3000)
    sets = [nd.shingle_set(nd.words_of(r[1]), 5) for r in rows]
    column = {v: k for k, v in enumerate({v for s in sets for v in s})}
    m = np.zeros((len(sets), len(column)), np.float32)
    for i, s in enumerate(sets):
        m[i, [column[v] for v in s]] = 1
    size = m.sum(axis=1)
    shared = m @ m.T
    near = 100 * shared >= 80 * (size[:, None] + size[None, :] - shared)
    label = np.arange(len(sets))
    while True:
        now = np.array([label[row].min() for row in near])
        if (now == label).all():
            break
        label = now
    out = {r["doc_id"]: r["component_id"] for r in nd.near_duplicates(spark.createDataFrame(rows, h.DOCS_DDL).repartition(8), size=5).collect()}
    assert [out[r[0]] for r in rows] == [1000 + int(x) for x in label] and 1 < len(set(label.tolist())) < 2500


def test_large_sets_are_compared_completely(monkeypatch):
    """Sets beyond the sketch: estimates choose the pairs, whole sets decide."""
    monkeypatch.setattr(nd, "DEEP", 64)
    monkeypatch.setattr(nd, "COLUMNS", 50)
    rng = np.random.default_rng(5)
    sets = []
    for _ in range(12):
        base = rng.integers(-(2**62), 2**62, 400)
        for lost in (0, 20, 44, 60, 90):
            sets.append(np.unique(np.r_[base[lost:], rng.integers(-(2**62), 2**62, lost)]))
    sets += [np.unique(rng.integers(0, 2**62, 9)) for _ in range(5)] * 2
    want = np.arange(len(sets))
    for i in range(len(sets)):
        for j in range(i):
            k = len(np.intersect1d(sets[i], sets[j]))
            if 100 * k >= 80 * (len(sets[i]) + len(sets[j]) - k):
                want[want == want[i]] = want[j]
    same = lambda g: {tuple(np.flatnonzero(g == x)) for x in g}
    whole = nd.Joiner(sets, np.arange(len(sets)), 80)
    whole.compare(np.arange(len(sets)), np.arange(len(sets)))
    parts = nd.Joiner(sets, np.arange(len(sets)), 80)
    half = np.arange(len(sets)) % 2 == 0
    for x, y in ((half, half), (~half, ~half), (half, ~half)):
        parts.compare(np.flatnonzero(x), np.flatnonzero(y))
    assert same(whole.group) == same(parts.group) == same(want)


def test_awkward_rows(spark):
    df = h.awkward(spark)
    out = nd.near_duplicates(df, size=4).collect()
    got = {}
    for r in out:
        got.setdefault(r["doc_id"], []).append((r["n_shingles"], r["component_id"], r["kept"]))
    assert got[0] == got[1][:0] + [(0, 0, True)] and got[2] == [(0, 2, True)] and got[4] == [(1, 4, True)]
    assert got[6][0][1:] == (6, True) and [g[1:] for g in got[7]] == [(6, False)] * 2 and got[None][0][1] == 6
    assert nd.near_duplicates(h.empty(spark)).count() == 0
    stage = nd.without_near_duplicates(df)
    assert stage.columns == df.columns and sorted(str(r["doc_id"]) for r in stage.collect()).count("7") == 0


def test_ids_that_name_several_texts_and_null_ids(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(60)]
    near = [*words[:30], "zz", *words[31:]]
    other = [f"v{rng.randrange(999)}" for _ in range(60)]
    rows = [h.row(7, " ".join(words)), h.row(7, " ".join(other)), h.row(None, " ".join(near)), h.row(9, " ".join(near[:-1])), h.row(8, " ".join([*other[:-1], "q"]))]
    check(spark, rows, 4)


def test_the_stage_keeps_one_row_of_each_group(spark):
    words = [f"w{i}" for i in range(60)]
    near = " ".join([*words[:30], "zz", *words[31:]])
    alone = " ".join(f"v{i}" for i in range(60))
    nameless = " ".join(f"u{i}" for i in range(60))
    rows = [
        h.row(3, " ".join(words)), h.row(3, " ".join(words), "b"), h.row(7, near), h.row(7, alone), h.row(None, near),
        h.row(None, nameless), h.row(None, nameless), h.row(None, nameless + " x"), h.row(8, ""), h.row(8, ""), h.row(None, None),
    ]
    out = nd.without_near_duplicates(spark.createDataFrame(rows, h.DOCS_DDL).repartition(3)).collect()
    got = sorted(((r["doc_id"], r["text"]) for r in out), key=str)
    group = [r for r in got if r[0] is None and r[1]]
    assert len(group) == 1 and group[0][1].startswith(nameless)
    assert [r for r in got if r not in group] == sorted([(3, " ".join(words)), (7, alone), (8, ""), (8, ""), (None, None)], key=str)


def test_components_of_paths_and_loops(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(60)] + [(200, 100 + i) for i in range(30)] + [(300, 300), (None, 4)]
    rng.shuffle(edges)
    got = {r["id"]: r["component"] for r in cc.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(61)) and got[300] == 300
    assert all(got[i] == 100 for i in [200, *range(100, 130)])
    assert cc.components(spark.createDataFrame([], "a long, b long")).count() == 0
