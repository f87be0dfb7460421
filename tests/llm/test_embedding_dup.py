import numpy as np
from pyspark.sql import Row

from shopsignals.llm import embedding_dup as ed

DDL = "vec_id long, embedding array<float>, label int"


def brute(rows):
    ok = {}
    for k, (_, v, _) in enumerate(rows):
        if v and len(v) == 16 and all(x is not None and np.isfinite(x) for x in v) and any(v):
            x = np.array(v, np.float32).astype(float)
            ok[k] = x / np.linalg.norm(x)
    group, links = {k: k for k in range(len(rows))}, dict.fromkeys(range(len(rows)), 0)

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    keys = list(ok)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            if ok[a] @ ok[b] >= 0.95:
                links[a] += 1
                links[b] += 1
                group[find(a)] = find(b)
    least = {}
    for k, (i, _, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return sorted(((i, links[k], least.get(find(k))) for k, (i, _, _) in enumerate(rows)), key=str)


def corpus(seed=0):
    rng = np.random.default_rng(seed)
    rows, i = [], 0
    for size in [1] * 150 + [2] * 20 + [5] * 6 + [60, 130]:
        centre = rng.standard_normal(16)
        for _ in range(size):
            rows.append((i, (centre + 0.12 * rng.standard_normal(16)).astype(np.float32).tolist(), 0))
            i += 1
    for _ in range(70):  # equal vectors, beyond any list length
        rows.append((i, rows[3][1], 1))
        i += 1
    return [rows[k] for k in rng.permutation(len(rows))]


def got(df):
    return sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in ed.near_duplicate_vectors(df).collect()), key=str)


def test_matches_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(ed, "BLOCK", 32)  # components span many pairs of blocks
    monkeypatch.setattr(ed, "BUCKET", 40)
    rows = corpus()
    want = brute(rows)
    assert got(spark.createDataFrame(rows, DDL).repartition(4)) == want
    assert max(n for _, n, _ in want) > 100


def test_missed_pairs_are_noticed_and_found(spark, monkeypatch):
    """A graph that has every link of the large groups and none of the small ones."""
    descend, starts = ed.descend, []

    def without_small(graph, classes, k, rounds):
        starts.append(1)
        out = descend(graph, classes, k, rounds)
        large = out.where("sim >= 0.95").groupBy("id").count().where("count >= 10").select("id")
        return out.join(large, "id", "left_semi").select("id", "nbr", "sim")

    rows = corpus(3)
    df = spark.createDataFrame(rows, DDL).repartition(4)
    monkeypatch.setattr(ed, "descend", without_small)
    monkeypatch.setattr(ed, "RETRIES", 1)
    monkeypatch.setattr(ed, "CHUNK", 100)
    monkeypatch.setattr(ed, "ENOUGH", 30)
    assert got(df) == brute(rows)
    assert len(starts) >= 2


def test_full_lists_hide_no_group(spark):
    """Two groups of 14 that are all linked across: ten nearer neighbours fill every list."""
    rng = np.random.default_rng(2)
    rows, i = [], 0
    for _ in range(400):
        centre = rng.standard_normal(16)
        rows += [(i + k, (centre + 0.05 * rng.standard_normal(16)).astype(np.float32).tolist(), 0) for k in range(5)]
        i += 5
    centre, step = rng.standard_normal(16), rng.standard_normal(16)
    centre, step = centre / np.linalg.norm(centre), step / np.linalg.norm(step)
    for side in (-0.1, 0.1):
        rows += [(i + k, (centre + side * step + 0.005 * rng.standard_normal(16)).astype(np.float32).tolist(), 0) for k in range(14)]
        i += 14
    want = brute(rows)
    assert {n for v, n, _ in want if v >= 2000} == {27}
    assert got(spark.createDataFrame(rows, DDL).repartition(4)) == want


def test_the_audit_sees_every_size_of_group(spark):
    truth = [(1, 1, 1)] * 50 + [(2, 4000, 4000)] * 50 + [(3, 27, 27)]
    counted = spark.createDataFrame([(1, 1), (2, 4000), (3, 13)], "cls long, links long")
    rows = [Row("cls", "links", "others")(*t) for t in truth]
    assert abs(ed.recall_of(rows, counted) - 13 / 27) < 1e-12
    assert [ed.size_class(n) for n in (1, 2, 3, 5, 6, 10, 11, 20, 21)] == [0, 0, 1, 1, 2, 2, 3, 3, 4]


def test_other_columns_are_not_read(spark):
    from tests.llm import helpers as h

    rows = corpus(7)[:80]
    df = h.clashing(spark.createDataFrame(rows, DDL)).withColumnRenamed("value", "a.b").withColumnRenamed("class", "cls")
    assert got(df) == brute(rows)


def test_awkward_rows(spark):
    one = [1.0] + [0.0] * 15
    rows = [
        (1, None, 0), (2, [], 0), (3, [0.0] * 16, 0), (4, [float("nan")] + one[1:], 0), (5, [float("inf")] + one[1:], 0), (6, [None] + one[1:], 0),
        (7, [1.0, 2.0], 0), (8, one, None), (8, one, 0), (None, one, 1), (9, [2.0] + one[1:], 0), (10, [0.0, 1.0] + one[2:], 0), (11, [-0.0, 3.0] + one[2:], 0),
    ]
    df = spark.createDataFrame(rows, DDL)
    assert got(df) == brute(rows)
    assert ed.near_duplicate_vectors(spark.createDataFrame([], DDL)).count() == 0
    assert got(spark.createDataFrame(rows[:3], DDL)) == brute(rows[:3])
    assert got(spark.createDataFrame(rows[7:8], DDL)) == brute(rows[7:8])
