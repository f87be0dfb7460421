import random
import re

import pytest
from pyspark.sql import functions as F

from shopsignals.llm import mixing
from tests.llm import helpers as h

W = re.compile(r"[^\x20\x09-\x0D]+")


def brute_targets(sizes):
    """Water filling by repeated sharing."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, full, target = sum(sizes.values()), set(), {}
    while True:
        left = total - sum(3 * sizes[s] for s in full)
        open_weight = sum(weight[s] for s in names if s not in full)
        target = {s: 3.0 * sizes[s] if s in full else left * weight[s] / open_weight for s in names}
        over = {s for s in names if s not in full and target[s] > 3 * sizes[s]}
        if not over:
            return target
        full |= over


def corpus(spark, spread, n=900, parts=5):
    rng = random.Random(2)
    rows = [h.row(i, h.sentence(rng, rng.choice([1, 5, 20, 50, 400])), rng.choices(list(spread), list(spread.values()))[0]) for i in range(n)]
    return spark.createDataFrame(rows, h.DOCS_DDL).repartition(parts)


def test_targets_and_taken(spark):
    df = corpus(spark, {"s1": 8, "s2": 1, "s10": 1, None: 2, "é": 3})
    rows = mixing.mix(df).collect()
    source = {r["doc_id"]: r["source"] for r in df.collect()}
    size = {r["doc_id"]: len(W.findall(r["text"])) for r in df.collect()}
    assert {r["doc_id"]: r["size"] for r in rows} == size
    sizes, taken, target = {}, {}, {}
    for r in rows:
        s = source[r["doc_id"]]
        sizes[s] = sizes.get(s, 0) + r["size"]
        taken[s] = taken.get(s, 0) + r["taken"]
        target[s] = r["target"]
        assert 0 <= r["taken"] <= 3 * r["size"] and (not r["size"] or r["taken"] % r["size"] == 0)
    want = brute_targets(sizes)
    assert all(abs(target[s] - want[s]) < 1e-6 * max(1, want[s]) for s in want)
    assert all(r["source_size"] == sizes[source[r["doc_id"]]] for r in rows)
    assert all(abs(taken[s] - target[s]) <= 0.005 * target[s] + 200 for s in want)


def test_limit_is_reshared(spark):
    sizes = {"a": 10, "b": 1000, "c": 3, "d": 500, "e": 2, None: 40}
    df = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.targets(df).collect()}
    want = brute_targets(sizes)
    assert all(abs(got[s] - want[s]) < 1e-6 for s in want) and got["a"] == 30


def test_reruns_agree_whatever_the_partitions(spark):
    df = corpus(spark, {"a": 1, "b": 2, "c": 1}, n=300)
    take = lambda d: sorted((r["doc_id"], r["taken"]) for r in mixing.mix(d).collect())
    assert take(df) == take(df.repartition(2)) == take(df.coalesce(1))


@pytest.mark.parametrize("fan_in", [64, 4])
def test_expectations_are_kept(spark, fan_in):
    """Over 800 groups of the same twelve documents of one probability, each is taken as often as it says."""
    groups, p = 800, 0.37
    items = spark.range(12 * groups).select(
        F.struct((F.col("id") % groups).alias("g")).alias("group"), F.col("id").alias("key"), (F.floor(F.col("id") / groups) * 3 + 1).alias("size"), F.lit(p).alias("p"),
    )
    rows = mixing.pivotal(items, 12, fan_in=fan_in, seed=3).collect()
    assert len(rows) == 12 * groups
    hits, totals = [0] * 12, [0] * groups
    for r in rows:
        if r["up"]:
            hits[r["key"] // groups] += 1
            totals[r["key"] % groups] += 3 * (r["key"] // groups) + 1
    want = p * sum(3 * k + 1 for k in range(12))
    # five standard errors; at the second level the probabilities left differ, and only expected words stay
    error = 5 * (p * (1 - p) / groups) ** 0.5
    assert all(abs(n / groups - p) < (error if fan_in == 64 else 2 * error) for n in hits), hits
    assert abs(sum(totals) / groups - want) < 0.01 * want and max(abs(t - want) for t in totals) < 34


def test_repeated_rows_and_ids_do_not_depend_on_the_partitions(spark):
    """One id names many texts, one row is a third of all, ids are null."""
    rng = random.Random(8)
    rows = [h.row(rng.choice([None, 1, 2]), h.sentence(rng, rng.randrange(1, 30)), rng.choice("ab"), rng.choice(["en", "de"])) for _ in range(200)]
    rows += [h.row(5, "always the same words", "a")] * 100
    df = spark.createDataFrame(rows, h.DOCS_DDL)
    got = [sorted(map(str, mixing.mixed_documents(df.repartition(n)).collect())) for n in (2, 7)]
    assert got[0] == got[1] and len(got[0]) > 50
    mixed = mixing.mix(df).collect()
    assert len(mixed) == 300
    words = sum(r["taken"] for r in mixed)
    assert words == sum(len(W.findall(r["text"])) for r in mixing.mixed_documents(df).collect())


def test_numbers_of_hot_rows(spark, monkeypatch):
    monkeypatch.setattr(mixing, "RUN", 7)
    rows = spark.createDataFrame([(1, 1), (2, 7), (3, 50), (4, 8)], "h long, m long")
    got = {}
    for r in mixing._numbered(rows, "m").collect():
        got.setdefault(r["h"], []).append(r["n"])
    assert {k: sorted(v) for k, v in got.items()} == {1: [0], 2: list(range(7)), 3: list(range(50)), 4: list(range(8))}


def test_awkward_rows(spark):
    df = h.clashing(h.awkward(spark))
    rows = mixing.mix(df).collect()
    assert len(rows) == df.count()
    assert all(r["taken"] == 0 for r in rows if r["size"] == 0)
    assert mixing.mix(h.empty(spark)).count() == 0
    blank = spark.createDataFrame([h.row(1, None), h.row(2, "")], h.DOCS_DDL)
    assert [r["taken"] for r in mixing.mix(blank).collect()] == [0, 0]
    assert [r["target"] for r in mixing.mix(blank).collect()] == [0.0, 0.0]


def test_documents_are_repeated(spark):
    df = corpus(spark, {"a": 1, "b": 6}, n=200)
    taken = {r["doc_id"]: r["taken"] // r["size"] for r in mixing.mix(df).collect() if r["size"]}
    out = mixing.mixed_documents(df)
    assert out.columns == df.columns
    seen = {r["doc_id"]: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert seen == {k: v for k, v in taken.items() if v}


def test_native_plan(spark):
    plan = mixing.mix(corpus(spark, {"a": 1, "b": 2}, n=50))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
