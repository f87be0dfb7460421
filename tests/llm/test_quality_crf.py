import itertools
import random

import numpy as np

from shopsignals.llm import quality_crf as crf
from tests.llm import helpers as h


def test_forward_backward_matches_enumeration():
    rng = np.random.default_rng(0)
    length = np.array([4, 1, 3])
    emit, trans = rng.normal(size=(3, 4, 2)), rng.normal(size=(2, 2))
    marginal, moves = crf.forward_backward(emit, length, trans, np.ones(3))
    want_moves = np.zeros((2, 2))
    for d, n in enumerate(length):
        paths = list(itertools.product((0, 1), repeat=int(n)))
        weight = np.array([np.exp(sum(emit[d, t, y] for t, y in enumerate(p)) + sum(trans[a, b] for a, b in zip(p, p[1:]))) for p in paths])
        weight /= weight.sum()
        for t in range(n):
            good = sum(w for w, p in zip(weight, paths) if p[t])
            assert abs(marginal[d, t, 1] - good) < 1e-9
        for w, p in zip(weight, paths):
            for a, b in zip(p, p[1:]):
                want_moves[a, b] += w
    assert np.allclose(moves, want_moves)


def corpus(spark, n=500, seed=2):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        good = int(rng.random() < 0.7)
        lines = [h.sentence(rng, rng.randrange(5, 20)).capitalize() + "." for _ in range(rng.randrange(2, 8))]
        if not good:
            kind = rng.randrange(3)
            bad = lambda x: [x.upper() + "!!", " ".join(w + "###" for w in x.split()), " | ".join(x.split()[:3])][kind]
            lines = [bad(x) if k or rng.random() < 0.5 else x for k, x in enumerate(lines)]
        docs.append(h.row(i, "\n".join(lines)))
        labels.append((i, good, 0))
    return spark.createDataFrame(docs, h.DOCS_DDL), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_accuracy(spark):
    docs, labels = corpus(spark)
    truth = {r["doc_id"]: r["quality"] for r in labels.collect()}
    rows = crf.quality(h.clashing(docs), labels).collect()
    assert len(rows) == 500 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in held) / len(held) >= 0.97


def test_lines_of_one_document_differ(spark):
    """A good text with one bad block scores between the two."""
    docs, labels = corpus(spark)
    model = crf.train(docs.select("doc_id", "text"), labels)
    rng = random.Random(8)
    good = "\n".join(h.sentence(rng, 12).capitalize() + "." for _ in range(10))
    bad = "\n".join(h.sentence(rng, 12).upper() + "!!" for _ in range(10))
    g, b, both = crf.scores(model, [good, bad, good + "\n" + bad])
    assert b < 0.2 < 0.8 < g and b < both < g


def test_batching_does_not_change_scores(spark):
    docs, labels = corpus(spark, 200)
    model = crf.train(docs.select("doc_id", "text"), labels)
    texts = [r["text"] for r in docs.collect()] + [None, "", " \n", "x\n" * 3000]
    together = crf.scores(model, texts)
    alone = np.array([crf.scores(model, [t])[0] for t in texts])
    assert np.allclose(together, alone)


def test_awkward_rows(spark):
    docs = h.awkward(spark)
    labels = spark.createDataFrame([(None, 1, 1), (5, None, None), (9, 0, 1), (9, 1, 0), (6, 1, 0), (999, 1, 1), (8, 0, 0)], "doc_id long, quality int, toxic int")
    rows = crf.quality(docs, labels).collect()
    assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert crf.quality(h.empty(spark), labels).count() == 0
    none = h.empty(spark, "doc_id long, quality int, toxic int")
    assert all(r["score"] == 0 for r in crf.quality(docs, none).collect())
