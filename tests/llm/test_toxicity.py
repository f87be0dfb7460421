import random

import numpy as np

from shopsignals.llm import toxicity as tox
from tests.llm import helpers as h

INSULTS = ["zorkface", "blargwit", "snurfhead"]


def labelled(spark, n=600, seed=1, mention=lambda rng, toxic: "", insulting=1.0):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        toxic = int(rng.random() < 0.25)
        words = h.sentence(rng, 40).split()
        if toxic and rng.random() < insulting:
            words.insert(rng.randrange(40), rng.choice(INSULTS) + rng.choice(["", "s", "ing"]))
        docs.append(h.row(i, mention(rng, toxic) + " ".join(words)))
        labels.append((i, 1, toxic))
    return spark.createDataFrame(docs, h.DOCS_DDL), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_accuracy(spark):
    docs, labels = labelled(spark)
    truth = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    rows = tox.toxicity(h.clashing(docs), labels).collect()
    assert len(rows) == 600 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert 100 < len(held) < 200
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in held) / len(held) >= 0.97


def test_labels_of_held_out_rows_are_not_read(spark):
    from pyspark.sql import functions as F

    docs, labels = labelled(spark, 300)
    flipped = labels.withColumn("toxic", F.when(tox.bucket_of(F.col("doc_id"), 4) == 2, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    key = lambda rows: sorted((r["doc_id"], r["score"]) for r in rows.collect())
    assert key(tox.toxicity(docs, labels)) == key(tox.toxicity(docs, flipped))


def test_counterfactual_penalty_spares_neutral_mentions(spark):
    """Group names that mostly occur in toxic training texts."""
    mention = lambda rng, toxic: rng.choice(["muslims ", "women "]) if rng.random() < (0.7 if toxic else 0.02) else ""
    docs, labels = labelled(spark, 600, 3, mention, insulting=0.5)
    slim = docs.select("doc_id", "text")
    plain = tox.train(slim, labels, fairness=0.0)
    fair = tox.train(slim, labels, fairness=20.0)
    rng = random.Random(9)
    neutral = ["the muslims and women of the town " + h.sentence(rng, 30) for _ in range(20)]
    score = lambda m: np.mean([m.score(t, {}) for t in neutral])
    assert score(fair) < 0.5 * score(plain)
    gap = lambda m: abs(m.linear({"muslims"}, {}) - m.linear({"christians"}, {}))
    assert gap(fair) < 0.5 * gap(plain)
    insulted = [fair.score("muslims are " + w + " " + h.sentence(rng, 30), {}) for w in INSULTS]
    assert min(insulted) > 2 * score(fair)


def test_awkward_rows(spark):
    docs = h.awkward(spark)
    labels = spark.createDataFrame([(None, 1, 1), (5, None, None), (9, 0, 1), (9, 0, 0), (6, 1, 0), (999, 1, 1)], "doc_id long, quality int, toxic int")
    rows = tox.toxicity(docs, labels).collect()
    assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert all(not r["held_out"] for r in rows if r["doc_id"] is None)
    assert tox.toxicity(h.empty(spark), labels).count() == 0
    none = h.empty(spark, "doc_id long, quality int, toxic int")
    assert all(r["predicted"] == 0 for r in tox.toxicity(docs, none).collect())


def test_stage_keeps_columns_and_clean_documents(spark):
    docs, labels = labelled(spark, 300, 5)
    truth = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    out = tox.without_toxic(docs, labels)
    assert out.columns == docs.columns
    kept = {r["doc_id"] for r in out.collect()}
    assert sum(i in kept for i in truth if not truth[i]) >= 0.98 * sum(not v for v in truth.values())
    assert sum(i in kept for i in truth if truth[i]) <= 0.05 * sum(truth.values())
