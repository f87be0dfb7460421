import os
import random

from pyspark.sql import functions as F

import corpus_pipeline as cp
from tests.llm import helpers as h
from tests.llm.test_near_dup import brute as near_brute


def write(spark, tmp_path):
    rng = random.Random(12)
    rows, labels = [], []
    for i in range(160):
        words = h.sentence(rng, rng.choice([20, 60, 150])).split()
        toxic = int(i % 6 == 0)
        if toxic:
            words.insert(5, rng.choice(["zorkface", "blargwit"]))
        lines = [" ".join(words), f"shared footer line number {i} of the whole site and its terms"]
        rows.append(h.row(i, "\n".join(lines), rng.choice(["a", "b", None])))
        labels.append((i, 1, toxic))
    rows += [(200 + i, rows[1][1].replace("alpha", "beta", 1), "en", "c", 5) for i in range(5)]
    rows += [h.row(300, None), h.row(301, "")]
    spark.createDataFrame(rows, h.DOCS_DDL).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    return rows, labels


def test_stages(spark, tmp_path):
    rows, labels = write(spark, tmp_path)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns = docs.columns
    after = {}
    for name, stage in cp.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        docs.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        after[name] = docs.collect()
        assert name == "packing" or docs.columns == columns
    toxic = {i for i, _, t in labels if t}
    kept = {r["doc_id"] for r in after["toxicity"]}
    assert not kept & toxic and {i for i, *_ in rows} - toxic <= kept
    assert len(after["line_dedup"]) == len(after["toxicity"])
    assert sum("shared footer" in (r["text"] or "") for r in after["line_dedup"]) == 1
    groups = {i: c for i, _, c in near_brute(after["line_dedup"], 5)}
    assert {r["doc_id"] for r in after["near_dedup"]} == {i for i, c in groups.items() if i == c}
    assert {r["doc_id"] for r in after["source_mixing"]} <= {r["doc_id"] for r in after["near_dedup"]}
    assert {r["doc_id"] for r in after["packing"]} == {r["doc_id"] for r in after["source_mixing"]}
    assert len([r for r in after["packing"] if r["piece"] == 0]) == len(after["source_mixing"])


def test_run_over_an_empty_table(spark, tmp_path):
    h.empty(spark).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert cp.run(spark, str(tmp_path)).count() == 0


def test_stages_over_awkward_rows_and_names(spark, tmp_path):
    """Nulls, repeats, long texts, ids that name several texts, and columns named like the stages' own."""
    rows, labels = write(spark, tmp_path)
    labels_only = f"{tmp_path}/labels.parquet"
    twin = rows[2][1] + " and some more"
    extra = [(None, twin, None, None, None), (None, None, None, None, None), (7, twin, "en", "a", 3), (7, twin, "en", "a", 3), (7, "x " * 30_000, "de", "b", 1), (7, "", "de", "b", 0)]
    df = spark.createDataFrame([*rows, *extra], h.DOCS_DDL)
    names = ["_score", "_t_score", "_l_id", "_id", "_drop", "_all", "_lines", "_dropped", "_row_id", "_row_hash", "_hash", "_d_id", "h", "_h", "_times", "_n", "m", "a.b", "key"]
    docs = df.withColumns({c: F.lit(1) for c in names})
    assert os.path.isdir(labels_only)
    columns, texts = docs.columns, {r["text"] for r in df.collect()}
    for name, stage in cp.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        docs.write.parquet(f"{tmp_path}/odd_{name}")
        docs = spark.read.parquet(f"{tmp_path}/odd_{name}")
        assert name == "packing" or docs.columns == columns, name
        if name == "toxicity":
            assert {r["text"] for r in docs.collect()} < texts
        if name == "near_dedup":
            assert docs.where(F.length("text") > 20_000).count() == 1
    assert docs.count() > 50


def test_run_over_nulls_and_repeats(spark, tmp_path):
    rows = [(None, "the same words again and again", None, None, None)] * 4 + [(1, None, "en", "a", None)] * 2 + [(2, "x", "en", None, 1)]
    spark.createDataFrame(rows, h.DOCS_DDL).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(2, 1, 0), (None, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    out = cp.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in out} <= {None, 2} and sum(r["length"] for r in out) > 0
