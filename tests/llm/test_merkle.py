import hashlib
import zlib

import pytest

from shopsignals.llm import merkle as mk
from tests.llm import helpers as h


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(r, n_chars):
    fields = (r["doc_id"], r["source"], r["lang"], n_chars, r["text"])
    return H(*("-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields))


def walk(nodes, fanout):
    """(root, proof levels per node) of plain lists."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, p in enumerate(at):
            first = p - p % fanout
            paths[i].append((nodes[first:p], nodes[p + 1 : first + fanout]))
        at = [p // fanout for p in at]
        nodes = [H(*nodes[i : i + fanout]) for i in range(0, len(nodes), fanout)]
    return nodes[0], paths


def brute(rows, fanout=2):
    langs = {}
    for r in rows:
        langs.setdefault(r["lang"], []).append((r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r, r["n_chars"]), r))
    order = sorted(langs, key=lambda x: (x is not None, (x or "").encode()))
    done = [walk([x[2] for x in sorted(langs[g], key=lambda x: x[:3])], fanout) for g in order]
    root, tops = walk([s for s, _ in done], fanout)
    out = []
    for g, (subroot, paths), top in zip(order, done, tops):
        for (_, _, leaf, r), path in zip(sorted(langs[g], key=lambda x: x[:3]), paths):
            path = path + top
            tampered = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0
            folded = leaf_of(r, r["n_chars"] + 1 if tampered and r["n_chars"] is not None else r["n_chars"])
            for a, b in path:
                folded = H(*a, folded, *b)
            out.append((r["doc_id"], leaf, subroot, root, H(*(s for a, b in path for s in a + b)), folded, folded == root))
    return sorted(out, key=str)


def rows(n=150):
    import random

    rng = random.Random(2)
    return [h.row(i, h.sentence(rng, 1 + i % 9), "s" + str(i % 3), rng.choice(["en"] * 6 + ["de", "fr", "Äö", "", None])) for i in range(10, 10 + n)]


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


@pytest.mark.parametrize("height", [10, 2])
def test_matches_brute_force(spark, monkeypatch, height):
    """Height 2: superblocks of four nodes, so groups take several exchanges and lone nodes at their ends."""
    monkeypatch.setattr(mk, "HEIGHT", height)
    monkeypatch.setattr(mk.proofs, "__defaults__", (*mk.proofs.__defaults__[:-1], height))
    df = h.awkward(spark, rows()).repartition(4)
    got = mk.document_manifest(h.clashing(df).withColumnRenamed("value", "a.b"))
    assert got.columns == COLUMNS
    assert sorted(map(tuple, got.collect()), key=str) == brute(df.collect())


def test_wider_runs_and_proofs(spark):
    df = spark.createDataFrame(rows(70), h.DOCS_DDL)
    found = mk.proofs(df, ["text", "doc_id"], "doc_id", "lang", fanout=3, height=2).collect()
    assert len({r["root"] for r in found}) == 1 and len(found) == 70
    assert all(mk.fold(r["leaf"], r["left"], r["right"]) == r["root"] == r["folded_root"] for r in found)
    assert not any(mk.fold(H("x"), r["left"], r["right"]) == r["root"] for r in found)


def test_single_rows_and_empty(spark):
    one = mk.document_manifest(spark.createDataFrame([h.row(5, "a")], h.DOCS_DDL)).collect()[0]
    assert one["leaf"] == one["subroot"] == one["root"] and one["proof_sha256"] == H()
    two = mk.document_manifest(spark.createDataFrame([h.row(5, "a"), h.row(5, None, lang="de")], h.DOCS_DDL)).collect()
    assert len({r["root"] for r in two}) == 1 and all(r["leaf"] == r["subroot"] != r["root"] for r in two)
    assert mk.document_manifest(h.empty(spark)).count() == 0 and mk.document_manifest(h.empty(spark)).columns == COLUMNS


def test_many_equal_rows_spread(spark):
    """A third of all rows equal: positions still run from 0 without a gap."""
    df = spark.createDataFrame([h.row(7, "same")] * 300 + rows(60), h.DOCS_DDL).repartition(6)
    placed = mk.numbered(df.select("doc_id", "lang"), "lang", ["doc_id"]).groupBy("tree").agg({"pos": "collect_list"}).collect()
    assert all(sorted(r[1]) == list(range(len(r[1]))) for r in placed) and sum(len(r[1]) for r in placed) == 360
