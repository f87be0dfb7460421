import math
import random
import sys
import zlib
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa

from shopsignals.llm import lm_scoring as lm
from tests.llm import helpers as h


def corpus(n=300):
    """Two vocabularies that never mix in a text, so what came before tells what follows."""
    rng = random.Random(1)
    other = [w[::-1] for w in h.VOCAB]
    return [h.row(i, " ".join(rng.choice(h.VOCAB if i % 2 else other) for _ in range(60)) + f" Rare{i % 90}") for i in range(n)]


def brute(rows):
    counts = Counter()
    for r in rows:
        if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 != 2:
            counts.update(lm.tokens_of(r["text"]))
    n, v = sum(counts.values()), len(counts)
    return [
        (r["doc_id"], len(t := lm.tokens_of(r["text"])), sum(counts[w] > 0 for w in t), n, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in t))
        for r in rows
    ]


def compare(df):
    rows = lm.lm_scores(h.clashing(df)).collect()
    got = sorted(((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in rows), key=str)
    for a, b in zip(got, sorted(brute(df.collect()), key=str), strict=True):
        assert a[:4] == b[:4] and abs(a[4] - b[4]) < 1e-6 * max(1, abs(b[4]))
    return rows


def test_base_scores_and_held_out_gain(spark, monkeypatch):
    monkeypatch.setattr(lm, "FREQUENT", 30)  # most counts come from the join
    monkeypatch.setattr(lm, "TOP", 24)
    monkeypatch.setattr(lm, "BLOCK", 256)
    rows = compare(spark.createDataFrame(corpus(), h.DOCS_DDL).repartition(3))
    held = [r for r in rows if r["held_out"]]
    assert len(held) > 20
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held) + 0.05 * sum(r["n_tokens"] for r in held)


def test_whole_scores_equal_brute_force(spark, monkeypatch):
    """Scores from the model's parameters token by token: softmax over outcomes, and counts inside a class."""
    monkeypatch.setattr(lm, "FREQUENT", 30)
    monkeypatch.setattr(lm, "TOP", 24)
    df = h.awkward(spark, corpus(120)).select("doc_id", "text")
    fitted = lm.fit(df, 7, 2)
    model, top = fitted.model, {w: i for i, w in enumerate(fitted.top)}
    counts = {r["word"]: r["c"] for r in fitted.counts.collect()}

    def brute_score(text):
        total, start = 0.0, len(model.noise)
        before = [start, start]
        for w in lm.tokens_of(text):
            k = top.get(w, len(top) + lm.class_of(w))
            z = model.predicted(np.array([before]))[0].astype(float) @ model.q.T.astype(float) + model.bias
            total += (z[k] - np.log(np.exp(z - z.max()).sum()) - z.max()) / math.log(10)
            if w not in top:
                c = k - len(top)
                total += math.log10((counts.get(w, 0) + 1) / (fitted.class_n[c] + fitted.class_v[c] + 1))
            before = [k, before[0]]
        return total

    got = sorted((str(r["doc_id"]), r["n_tokens"], r["score"]) for r in lm.scores_of(fitted, 7, 2).collect())
    want = sorted((str(r["doc_id"]), len(lm.tokens_of(r["text"])), brute_score(r["text"])) for r in df.collect())
    for a, b in zip(got, want, strict=True):
        assert a[:2] == b[:2] and abs(a[2] - b[2]) < 1e-5 * max(1, abs(b[2]))
    # equally frequent words: the cut between outcomes and classes is by the word
    assert fitted.top == [w for w, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:24]]


def test_every_hash_class_is_trained_on(spark):
    """Production parameters; the ids are such that a sample by hash class 0 or 1 of 8 is empty."""
    ids = spark.range(8000).where("pmod(xxhash64(id), 8) >= 2").orderBy("id").collect()
    rows = [(r["id"], *c[1:]) for r, c in zip(ids, corpus(5000))]
    df = spark.createDataFrame(rows, h.DOCS_DDL).repartition(3)
    held = [r for r in lm.lm_scores(df).collect() if r["held_out"]]
    assert len(held) > 400
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held) + 0.05 * sum(r["n_tokens"] for r in held)


def test_awkward_rows(spark):
    rows = compare(h.awkward(spark))
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in rows)
    assert all(not r["held_out"] for r in rows if r["doc_id"] is None)
    assert lm.lm_scores(h.empty(spark)).count() == 0


def test_most_frequent_words(spark):
    rows = [(f"w{i}", 1 + i % 7 if i % 50 else 1000 + i) for i in range(400)]
    df = spark.createDataFrame(rows, "word string, c long").repartition(6)
    want = sorted(rows, key=lambda r: (-r[1], r[0]))
    for n in (1, 5, 8, 60, 399, 1000):
        assert lm.most_frequent(df, n) == want[:n]
    assert lm.most_frequent(df.limit(0), 5) == []


def test_outcome_probabilities_sum_to_one():
    noise = np.full(40, 1 / 40)
    model = lm.LogBilinear(noise)
    rng = np.random.default_rng(0)
    for _ in range(20):
        model.step(rng.integers(0, 41, (64, 2)), rng.integers(0, 40, 64), rng, 0.1, {})
    near, far, log_z = model.tables()
    before = rng.integers(0, 41, (7, 2))
    z = model.predicted(before) @ model.q.T + model.bias
    p = np.exp(near[before[:, 0]] + far[before[:, 1]] - log_z[before[:, 0], before[:, 1]][:, None])
    assert np.allclose(p.sum(1), 1)
    assert np.allclose(p, np.exp(z) / np.exp(z).sum(1, keepdims=True), atol=1e-5)


def test_training_lifts_likelihood():
    """Noise-contrastive updates learn which outcome follows which."""
    rng = np.random.default_rng(1)
    noise = np.full(10, 0.1)
    model, state = lm.LogBilinear(noise), {}
    before = rng.integers(0, 10, (4000, 2))
    outcome = ((before[:, 0] + 1) % 10).astype(np.int32)

    def mean_log():
        near, far, log_z = model.tables()
        return (near[before[:, 0], outcome] + far[before[:, 1], outcome] - log_z[before[:, 0], before[:, 1]]).mean()

    first = mean_log()
    for _ in range(60):
        model.step(before, outcome, rng, 0.1, state)
    assert mean_log() > first + 1.0


ODD_TEXTS = [
    None, "", " ", "\n\n", "one", " lead", "trail\t", "a  b\x0b\x0cc\r\nd", "A\x1cB\x85C\xa0D\u2003E", "İSTANBUL Kelvin ÄÖ É",
    "\U0001f600x y\U0001f600 \U0001f600", "\x00 \x08\x0e", *(f"Ab{chr(c)}cD" for c in range(0x250)),
]


def test_words_of_a_batch_equal_those_of_each_text():
    texts = pa.array(["skipped words", *ODD_TEXTS, "skipped too"])[1:-1]
    words, sizes = lm.batch_words(texts)
    assert [*words.to_pylist()] == [w for t in ODD_TEXTS for w in lm.tokens_of(t)[:-1]]
    assert sizes.tolist() == [len(lm.tokens_of(t)) - 1 for t in ODD_TEXTS]
    assert lm.classes_of(words).tolist() == [lm.class_of(w) for w in words.to_pylist()]
    words, sizes = lm.batch_words(pa.array([], pa.string()))
    assert len(words) == len(sizes) == 0


def test_slices_are_bounded_by_bytes(monkeypatch):
    monkeypatch.setattr(lm, "SLICE_BYTES", 10)
    texts = ["ab", None, "abcdefgh", "", "a" * 30, "ä" * 5, "x", None, "y" * 11, "z"]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    got = [s.column(0).to_pylist() for s in lm.slices([batch[:0], batch], 0)]
    assert got == [["ab", None, "abcdefgh", ""], ["a" * 30], ["ä" * 5], ["x", None], ["y" * 11], ["z"]]


def coded(texts, words, counts, n_top):
    """What one task of ``coded_documents`` makes of one batch, and how many calls Python ran for it."""
    run = lm.coded_documents(SimpleNamespace(mapInArrow=lambda run, ddl: run), n_top, SimpleNamespace(value=(words, counts)))
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts, pa.string()), pa.array([True] * len(texts))], names=["doc_id", "text", "trains"])
    calls = [0]

    def count(frame, event, arg):
        calls[0] += event in ("call", "c_call")

    sys.setprofile(count)
    try:
        [out] = run([batch])
    finally:
        sys.setprofile(None)
    return out, calls[0]


def test_coded_documents(monkeypatch):
    monkeypatch.setattr(lm, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 3)))
    texts = [*ODD_TEXTS, "a b a zz zz zz qq"]
    words, counts = ["a", lm.END, "b", "one"], [9, 7, 5, 2]
    out, _ = coded(texts, words, counts, 2)
    for i, (r, text) in enumerate(zip(out.to_pylist(), texts, strict=True)):
        tokens = Counter(every := lm.tokens_of(text))
        logged = {w: math.log10(c + 1) for w, c in zip(words, counts)}
        assert (r["row"], r["doc_id"], r["n_tokens"], r["known"]) == ((3 << 40) + i, i, len(every), sum(w in logged for w in every))
        assert np.frombuffer(r["ids"], "<i2").tolist() == [words[:2].index(w) if w in words[:2] else 2 + lm.class_of(w) for w in every]
        assert math.isclose(r["base"], sum(logged.get(w, 0) for w in every))
        assert math.isclose(r["inner"], sum(logged.get(w, 0) for w in every if w not in words[:2]))
        assert dict(zip(r["rare"], r["times"], strict=True)) == {w: c for w, c in tokens.items() if w not in words}


def test_coding_runs_no_python_for_each_word(monkeypatch):
    """Calls follow the endings of words that are new to the table, not the words of the texts."""
    monkeypatch.setattr(lm, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    rng = random.Random(2)
    known = [f"w{i}" for i in range(2000)]
    for vocabulary in (known, [f"x{i}y" for i in range(2000)]):
        few, many = ([" ".join(rng.choices(vocabulary, k=k)) for _ in range(20)] for k in (200, 4000))
        args = [*known, lm.END], [5] * 2001, 100
        assert coded(many, *args)[1] <= coded(few, *args)[1] + 100


def test_counts_told_in_many_parts(spark, monkeypatch):
    monkeypatch.setattr(lm, "COUNTED_WORDS", 50)
    monkeypatch.setattr(lm, "COUNT_ROWS", 7)
    monkeypatch.setattr(lm, "COUNTED_BYTES", 500)
    lm.small_batches(spark, 16)
    df = spark.createDataFrame([(t,) for t in ODD_TEXTS * 2], "text string").repartition(2)
    want = Counter(w for t in ODD_TEXTS * 2 for w in lm.tokens_of(t))
    assert {r["word"]: r["c"] for r in lm.word_counts(df).collect()} == want


def test_training_blocks_hold_every_position_once(monkeypatch):
    monkeypatch.setattr(lm, "SLICE_BYTES", 60)
    rng, start = np.random.default_rng(4), 30
    docs = [rng.integers(0, 30, k).astype("<i2") for k in (1, 2, 3, 1, 40, 7, 1, 90, 5, 5, 16, 1)]
    column = pa.array([b"", *(d.tobytes() for d in docs)], pa.binary())[1:]
    batches = [pa.RecordBatch.from_arrays([column[lo:hi]], names=["ids"]) for lo, hi in ((0, 4), (4, 4), (4, 5), (5, 12))]
    blocks = list(lm.training_blocks(batches, start, 16))
    assert all(len(y) <= 16 and x.shape == (len(y), 2) for x, y in blocks)
    padded = [np.r_[start, start, d] for d in docs]
    assert np.concatenate([y for _, y in blocks]).tolist() == np.concatenate(docs).tolist()
    assert np.concatenate([x for x, _ in blocks]).tolist() == np.concatenate([np.stack([p[1:-1], p[:-2]], 1) for p in padded]).tolist()


def test_step_equals_the_plain_gradient():
    """One update against the sums written out position by position in double precision."""
    noise = np.arange(1, 21) / 210
    model = lm.LogBilinear(noise)
    rng = np.random.default_rng(6)
    before, outcome = rng.integers(0, 21, (600, 2)), rng.integers(0, 20, 600)
    r, q, bias, position = (x.astype(float) for x in (model.r, model.q, model.bias, model.position))
    drawn = np.random.default_rng(9).choice(20, lm.NOISE * 8, p=noise)
    log_kp = np.log(len(drawn) * noise)
    dr, dq, db, dp = (np.zeros_like(x) for x in (r, q, bias, position))
    for (a, b), w in zip(before, outcome):
        h = r[a] * position[0] + r[b] * position[1]
        for v, true in [(w, 1), *((v, 0) for v in drawn)]:
            g = (true - 1 / (1 + np.exp(-(h @ q[v] + bias[v] - log_kp[v])))) / len(outcome)
            dq[v] += g * h
            db[v] += g
            for j, c in enumerate((a, b)):
                dr[c] += g * q[v] * position[j]
                dp[j] += g * q[v] * r[c]
    state = {}
    model.step(before, outcome, np.random.default_rng(9), 0.1, state)
    for name, old, g in (("r", r, dr), ("q", q, dq), ("bias", bias, db), ("position", position, dp)):
        assert np.allclose(state[name], 1e-8 + g**2, rtol=1e-3, atol=1e-9)
        assert np.allclose(getattr(model, name), old + 0.1 * g / np.sqrt(1e-8 + g**2), atol=2e-3)
