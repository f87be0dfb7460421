import random
import zlib

import numpy as np
import pytest

from shopsignals.llm import packing, token_count, wordbpe
from tests.llm import helpers as h

PATH = wordbpe.vocabulary_path()
LIB = wordbpe.load_tokenizer(PATH)
PARTS = ["a", "the", "ing", " ", "\n", "\t", "\r", "é", "É", "İ", "ß", "日本", "😀", "<|endoftext|>", "<|", "12", "³", "½", "aaaa", "'", "'s", "!!", "###", "́", "Σ", "ς", "\x85", "\xa0", "​", "ǅ", "ﬁ", "\x1c", "_"]


def ids(text):
    return LIB.encode(text or "", add_special_tokens=False).ids


def test_counts_equal_the_library():
    rng, counter = random.Random(3), token_count.Counter(PATH)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randrange(16))) for _ in range(3000)]
    assert counter.count(texts) == [len(ids(t)) for t in texts]


def test_long_and_repetitive_words():
    counter = token_count.Counter(PATH)
    texts = ["a" * 5000, "ab" * 3000, "x" + "ing" * 2000, ""]
    assert counter.count(texts) == [len(ids(t)) for t in texts]


def test_small_cache_gives_the_same(monkeypatch):
    monkeypatch.setattr(token_count, "CACHE", 3)
    counter = token_count.Counter(PATH)
    for t in ("one two three four five", "five six seven", "one two"):
        assert counter.count([t]) == [len(ids(t))]


def test_count_query(spark):
    df = h.awkward(spark)
    want = sorted(((r["doc_id"], len((r["text"] or "").encode()), len(ids(r["text"]))) for r in df.collect()), key=str)
    got = token_count.token_counts(h.clashing(df)).collect()
    assert sorted(((r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in got), key=str) == want
    assert all(r["over_limit"] == (r["n_tokens"] > 2048) for r in got)
    assert token_count.token_counts(h.empty(spark)).count() == 0


def check_packed(rows, docs, size):
    bins = {}
    for r in rows:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
    want = []
    for d in docs:
        all_ids = ids(d["text"]) + [1]
        for piece, begin in enumerate(range(0, len(all_ids), size)):
            part = all_ids[begin : begin + size]
            want.append((d["doc_id"], piece, begin, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    got = [(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows]
    assert sorted(got, key=str) == sorted(want, key=str)
    return len(bins)


def test_packing_round_trip(spark):
    df = h.awkward(spark)
    rows = packing.pack(h.clashing(df)).collect()
    used = check_packed(rows, df.collect(), 4096)
    assert used == -(-sum(r["length"] for r in rows) // 4096)
    assert packing.pack(h.empty(spark)).count() == 0


def test_packing_many_tasks(spark):
    rng = random.Random(5)
    rows = [h.row(i, h.sentence(rng, rng.choice([3, 9, 9, 9, 40]))) for i in range(700)]
    df = spark.createDataFrame(rows, h.DOCS_DDL).repartition(9)
    packed = packing.pack(df, capacities=packing.Capacities(tokens=64)).collect()
    used = check_packed(packed, df.collect(), 64)
    first_fit = []
    for n in sorted((r["length"] for r in packed), reverse=True):
        at = next((i for i, left in enumerate(first_fit) if left >= n), None)
        if at is None:
            first_fit.append(64 - n)
        else:
            first_fit[at] -= n
    assert used <= len(first_fit)


@pytest.mark.parametrize(("documents", "attention"), [(3, None), (None, 1200), (4, 1500)])
def test_packing_under_binding_capacities(spark, documents, attention):
    """The table-level operator with limits that bind: each holds in every sequence, and few sequences are used."""
    rng = random.Random(7)
    rows = [h.row(i, h.sentence(rng, rng.choice([2, 4, 9, 20]))) for i in range(400)]
    df = spark.createDataFrame(rows, h.DOCS_DDL).repartition(5)
    packed = packing.pack(df, capacities=packing.Capacities(tokens=64, documents=documents, attention=attention)).collect()
    used = check_packed(packed, df.collect(), 64)
    bins = {}
    for r in packed:
        bins.setdefault(r["sequence_id"], []).append(r["length"])
    assert documents is None or max(map(len, bins.values())) == documents
    costs = [sum(n * n for n in parts) for parts in bins.values() if len(parts) > 1]
    assert attention is None or max(costs) <= attention
    free = len({r["sequence_id"] for r in packing.pack(df, capacities=packing.Capacities(tokens=64)).collect()})
    total = [r["length"] for r in packed]
    least = max(-(-sum(total) // 64), -(-len(total) // documents) if documents else 0, -(-sum(n * n for n in total) // attention) if attention else 0)
    assert used > free and used <= 1.15 * least + 2


@pytest.mark.parametrize("score", ["norm", "dot"])
@pytest.mark.parametrize("limits", [(100, None, None), (100, 3, None), (100, None, 2500), (100, 4, 3000)])
def test_every_capacity_holds(score, limits):
    rng = np.random.default_rng(0)
    lengths = np.arange(1, 50)
    counts = rng.integers(0, 40, len(lengths))
    cap = packing.Capacities(*limits, weights=(1.0, 0.5, 0.5), score=score)
    runs = packing.vector_best_fit(lengths, counts, cap)
    placed = {}
    for length, rank, m, first, offset in runs.tolist():
        for i in range(m):
            placed.setdefault((length, rank + i), []).append((first + i, offset))
    assert sorted(placed) == sorted((int(n), r) for n, c in zip(lengths, counts) for r in range(c))
    bins = {}
    for (length, _), where in placed.items():
        assert len(where) == 1
        bins.setdefault(where[0][0], []).append((where[0][1], length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 100
        assert limits[1] is None or len(parts) <= limits[1]
        assert limits[2] is None or sum(n * n for _, n in parts) <= limits[2]
