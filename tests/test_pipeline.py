"""Sources, catalog, streaming, models and the end-to-end jobs on the small
test tables (scratch folders under the system temp dir)."""

import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from shopsignals.operators import features as feat
from shopsignals.operators import reports
from shopsignals.sources import adapters as ad
from shopsignals.sources import catalog
from shopsignals.sources.events import EVENT_COLUMNS, MissingInputError, ingest_csv, load_events, write_events_csv
from tests.conftest import SF_SMALL

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="test tables not present")


@pytest.fixture(scope="module")
def scratch():
    return tempfile.mkdtemp(prefix="shopsignals-test-")


@pytest.fixture(scope="module")
def event_root(spark, scratch):
    """Order-data events as raw CSV text → ingest → partitioned Parquet."""
    ev = ad.order_events(spark, SF_SMALL)
    csv_dir = f"{scratch}/csv"
    write_events_csv(ev, csv_dir)
    root = f"{scratch}/events"
    ingest_csv(spark, f"{csv_dir}/*.csv", root, mode="overwrite")
    return root


def test_ingest_round_trip_and_partition_pruning(spark, event_root):
    src = ad.order_events(spark, SF_SMALL)
    back = load_events(spark, event_root)
    assert back.count() == src.count()
    assert {"year", "month"} <= set(back.columns)
    y, m = back.select("year", "month").first()
    one = load_events(spark, event_root, [(y, m)])
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "year" in plan
    assert one.count() == back.filter((F.col("year") == y) & (F.col("month") == m)).count()


def test_ingest_can_be_repeated(spark, scratch):
    """A second run adds nothing, a new file is added, a changed file replaces its own rows in every month."""
    head = ",".join(EVENT_COLUMNS)
    line = lambda day, user: f"2020-{day} 10:00:00 UTC,view,1,2,a.b,x,1.5,{user},s{user}"

    def put(name, *lines):
        os.makedirs(f"{scratch}/again", exist_ok=True)
        with open(f"{scratch}/again/{name}", "w") as f:
            f.write("\n".join([head, *lines]) + "\n")

    def users():
        return sorted((r["user_id"], r["month"]) for r in load_events(spark, root).select("user_id", "month").collect())

    root, glob = f"{scratch}/again_events", f"{scratch}/again/*.csv"
    put("2020-Jan.csv", line("01-05", 1), line("01-06", 2), line("02-01", 3))
    put("2020-Feb.csv", line("02-03", 4))
    assert ingest_csv(spark, glob, root) == 2 and ingest_csv(spark, glob, root) == 0
    assert users() == [(1, 1), (2, 1), (3, 2), (4, 2)]
    put("2020-Mar.csv", line("03-03", 5))
    assert ingest_csv(spark, glob, root) == 1 and len(users()) == 5
    put("2020-Jan.csv", line("01-05", 1), line("01-07", 9))
    assert ingest_csv(spark, glob, root) == 1
    assert users() == [(1, 1), (4, 2), (5, 3), (9, 1)]
    assert ingest_csv(spark, glob, root, mode="overwrite") == 3 and len(users()) == 4
    with pytest.raises(MissingInputError, match="download"):
        ingest_csv(spark, f"{scratch}/nothing/*.csv", f"{scratch}/no_table")


def test_months_merge_to_the_batch_table(spark, scratch, event_root):
    """Features of a state that grew month by month equal those of all events; a repeated month changes nothing."""
    from shopsignals.operators import cells
    from shopsignals.plans import jobs

    ev = load_events(spark, event_root)
    months = [tuple(r) for r in ev.select("year", "month").distinct().orderBy("year", "month").collect()][:2]
    two = load_events(spark, event_root, months)
    want = feat.user_features(two, affinity_categories=ad.CLICKSTREAM_CATEGORIES)
    state = f"{scratch}/state"
    for month in [months[0], months[1], months[0]]:
        cells.write_cells(cells.user_cells(load_events(spark, event_root, [month])), state)
    got = cells.features_from_cells(cells.read_cells(spark, state), two, affinity_categories=ad.CLICKSTREAM_CATEGORIES)
    assert got.columns == want.columns and want.count() > 10
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    out = f"{scratch}/updates"
    jobs.update_features_job(spark, event_root, out, months[:1], affinity_categories=ad.CLICKSTREAM_CATEGORIES)
    jobs.update_features_job(spark, event_root, out, months[1:], affinity_categories=ad.CLICKSTREAM_CATEGORIES)
    assert sorted(map(tuple, spark.read.parquet(f"{out}/features_merged").select(want.columns).collect())) == sorted(map(tuple, want.collect()))


def test_missing_input_message(spark, scratch):
    from shopsignals.sources.events import read_events_csv

    with pytest.raises(MissingInputError, match="ingest"):
        load_events(spark, f"{scratch}/does-not-exist")
    with pytest.raises(MissingInputError, match="download"):
        read_events_csv(spark, f"{scratch}/no-such-folder/*.csv")


def test_catalog_table_repair_and_reports(spark, event_root):
    catalog.create_database(spark, "shopsignals_test")
    catalog.create_event_table(spark, "shopsignals_test.events", event_root)
    catalog.repair_partitions(spark, "shopsignals_test.events")
    n = spark.table("shopsignals_test.events").count()
    assert n == ad.order_events(spark, SF_SMALL).count()
    rpm = catalog.run_report(spark, "rows_per_month", "shopsignals_test.events").collect()
    ref = reports.rows_per_month(load_events(spark, event_root)).collect()
    assert [tuple(r) for r in rpm] == [tuple(r) for r in ref]
    for name, report in reports.REPORTS.items():
        got = catalog.run_report(spark, name, "shopsignals_test.events").collect()
        assert sorted(map(str, got)) == sorted(map(str, report(load_events(spark, event_root)).collect())) and got


def test_streams_end_complete_and_equal_the_batch(spark, scratch):
    """Silences of exactly the gap, of a microsecond more, and users active over midnight."""
    from datetime import datetime, timedelta

    from shopsignals.operators.sessionize import sessionize_by_gap
    from shopsignals.streaming.sessions import closing_event, dau_stream, read_event_stream, session_stream, start_to_parquet
    from tests.conftest import events_df

    t0, half = datetime(2022, 5, 1, 3), timedelta(hours=12)
    times = {1: [t0, t0 + half, t0 + 2 * half], 2: [t0, t0 + half + timedelta(microseconds=1)], 3: [t0 + timedelta(hours=20, minutes=m) for m in range(0, 120, 30)]}
    rows = [{"event_time": at, "event_type": "view", "price": 1.5, "user_id": u} for u, all_times in times.items() for at in all_times]
    ev = events_df(spark, rows)
    src = f"{scratch}/stream_src"
    ev.drop("user_session").repartition(3).write.mode("overwrite").parquet(src)
    closing_event(ev.drop("user_session")).write.mode("append").parquet(src)
    for name, build in (("sessions", session_stream), ("days", dau_stream)):
        start_to_parquet(build(read_event_stream(spark, src)), f"{scratch}/{name}", f"{scratch}/{name}_ck").awaitTermination(300)
    batch = reports.session_summary(sessionize_by_gap(ev.drop("user_session"), tiebreak_cols=("event_type",)), ordered=False)
    key = lambda df: sorted((r["user_id"], r["session_start"], r["session_end"], r["total_events"]) for r in df.collect())
    assert key(spark.read.parquet(f"{scratch}/sessions")) == key(batch)
    assert batch.groupBy("user_id").count().where("user_id = 1").first()["count"] == 1
    assert batch.groupBy("user_id").count().where("user_id = 2").first()["count"] == 2
    days = lambda df: sorted((r["event_date"], r["dau"]) for r in df.collect())
    assert days(spark.read.parquet(f"{scratch}/days")) == days(reports.daily_active_users(ev))


def test_late_rows_are_put_aside(spark, scratch):
    """Rows in sessions + late rows = input, also when a batch is written twice."""
    from datetime import datetime, timedelta

    from shopsignals.streaming import sessions as st
    from tests.conftest import events_df

    t0, src = datetime(2022, 5, 1), f"{scratch}/late_src"
    batches = [
        [(1, 0), (2, 1), (None, None)], [(1, 40), (2, 41)],
        [(1, 2), (3, 3), (1, 41)],  # two of them a day and more behind the 41 hours seen
        [(3, 100)], [(2, 42), (4, 99)],
    ]
    for k, batch in enumerate(batches):
        rows = [{"event_time": None if h is None else t0 + timedelta(hours=h), "event_type": "view", "price": 1.0, "user_id": u} for u, h in batch]
        events_df(spark, rows).coalesce(1).write.mode("append").parquet(src)
    events_df(spark, [{"event_time": t0 + timedelta(days=4000), "user_id": -1}]).write.mode("append").parquet(src)
    source = st.read_event_stream(spark, src, max_files_per_trigger=1)
    st.split_late(source, f"{scratch}/split", f"{scratch}/late_ck", delay="24 hours", slack="1 hour").awaitTermination(300)
    st.start_to_parquet(st.session_stream(st.in_time_stream(spark, f"{scratch}/split"), "1 hour", "24 hours"), f"{scratch}/late_sessions", f"{scratch}/late_ck2").awaitTermination(300)
    late = sorted((r["user_id"], r["event_time"] and (r["event_time"] - t0).total_seconds() / 3600) for r in st.late_rows(spark, f"{scratch}/split").where("user_id IS NOT NULL").collect())
    assert late == [(1, 2.0), (2, 42.0), (3, 3.0)]
    assert st.late_rows(spark, f"{scratch}/split").count() == 4
    held = {(r["user_id"], (r["session_start"] - t0).total_seconds() / 3600): r["total_events"] for r in spark.read.parquet(f"{scratch}/late_sessions").collect()}
    assert sum(held.values()) + len(late) == sum(u is not None for b in batches for u, _ in b)
    assert held[1, 40.0] == 2


def test_arrivals_are_written_by_many_tasks(spark, scratch, monkeypatch):
    """One micro-batch per arrival, though an arrival is many files (it was one file, written by one task)."""
    from shopsignals.plans import registry
    from shopsignals.streaming import sessions as st

    columns = [f"cast(null AS {f.dataType.simpleString()}) AS {f.name}" for f in st.STREAM_EVENT_SCHEMA.fields if f.name not in ("event_time", "user_id", "user_session")]
    rows = spark.range(0, 4000, 1, 6).selectExpr("timestamp_seconds(1650000000 + id * 600) AS event_time", "id % 40 AS user_id", *columns)
    monkeypatch.setattr(registry.ad, "clickstream_events", lambda *_args, **_named: rows)
    monkeypatch.setattr(registry, "scratch_path", lambda *_args: f"{scratch}/arrivals")
    assert tuple(registry.q_stream_late_rows(spark, SF_SMALL).first()) == (4000, True, True, True)
    files = spark.read.parquet(f"{scratch}/arrivals/source").select("user_id", F.input_file_name().alias("file")).where("user_id >= 0")
    assert files.select("file").distinct().count() >= 9
    batches = spark.read.parquet(f"{scratch}/arrivals/split").groupBy("batch").count().collect()
    assert len(batches) == 4 and sum(r["count"] for r in batches) == 4001


def test_sketches_of_days_unite(spark):
    from datetime import datetime, timedelta

    from tests.conftest import events_df

    rows = [{"event_time": datetime(2022, 3, 1) + timedelta(days=u % 5, hours=u % 24), "user_id": u % 3000} for u in range(9000)]
    ev = events_df(spark, [*rows, {"event_time": None, "user_id": 7}, {"event_time": datetime(2022, 3, 1), "user_id": None}])
    days = reports.daily_user_sketches(ev)
    assert days.count() == 5
    united = reports.active_users_from_sketches(days, F.lit("all")).first()
    assert abs(united["active_users"] - 3000) <= 3 * 1.04 / 64 * 3000
    by_day = {r["period"]: r["active_users"] for r in reports.active_users_from_sketches(days, F.col("event_date")).collect()}
    exact = {r[0]: r[1] for r in ev.where("event_time IS NOT NULL").groupBy(F.to_date("event_time")).agg(F.countDistinct("user_id")).collect()}
    assert all(abs(by_day[d] - n) <= 3 * 1.04 / 64 * n for d, n in exact.items())


def test_plain_silhouette_equals_brute_force(spark):
    import numpy as np
    from pyspark.ml.functions import array_to_vector

    from shopsignals.models import clusters

    rng = np.random.default_rng(4)
    points = [(i, int(c), [float(v) for v in rng.normal(c * 1.5, 1.0, 3)]) for i, c in enumerate([*rng.integers(0, 3, 240), 7, *[-1] * 20])]
    df = spark.createDataFrame(points, "user_id long, cluster int, x array<double>").withColumn("pca", array_to_vector("x")).repartition(4)
    core = [(c, np.array(x)) for _, c, x in points if c != -1]
    widths = []
    for i, (c, x) in enumerate(core):
        d = {}
        for j, (other, y) in enumerate(core):
            if i != j:
                d.setdefault(other, []).append(float(np.linalg.norm(x - y)))
        a, b = np.mean(d.get(c, [0])), min(np.mean(v) for k, v in d.items() if k != c)
        widths.append((b - a) / max(a, b) if c in d else 0.0)
    assert clusters.euclidean_silhouette(df).first()[0] == pytest.approx(np.mean(widths), abs=6e-5)
    assert clusters.euclidean_silhouette(df.where("cluster < 1")).first()[0] == 0.0
    assert -1 <= clusters.euclidean_silhouette(df, sample=50).first()[0] <= 1


def test_thousands_of_categories_as_one_sparse_column(spark):
    from pyspark.ml.classification import LogisticRegression

    from shopsignals.models import sparse

    df = spark.range(20_000).selectExpr("id", "concat('c', id % 5000) AS cat", "cast(id % 5000 < 100 AS double) AS label")
    index = sparse.category_index(df.union(df.limit(1).selectExpr("id", "CAST(NULL AS string)", "label")), "cat")
    assert index.count() == 5000 and index.agg(F.min("position"), F.max("position"), F.countDistinct("position")).first() == (0, 4999, 5000)
    coded = sparse.with_category_vector(df, index, "cat")
    first = {r["cat"]: r["category_vector"] for r in coded.limit(50).collect()}
    at = {r["category"]: r["position"] for r in index.collect()}
    assert all(v.size == 5001 and v.indices.tolist() == [at[c]] for c, v in first.items()) and coded.count() == 20_000
    unseen = sparse.with_category_vector(spark.createDataFrame([("new",), (None,)], "cat string"), index, "cat").collect()
    assert [r["category_vector"].indices.tolist() for r in unseen] == [[5000], [5000]]
    model = LogisticRegression(featuresCol="category_vector", maxIter=20).fit(coded)
    assert model.transform(coded).where("prediction = label").count() > 19_900


def test_models_and_jobs(spark, scratch, event_root):
    from shopsignals.plans import jobs

    out = f"{scratch}/jobs"
    jobs.features_job(spark, event_root, out, affinity_categories=ad.CLICKSTREAM_CATEGORIES)
    merged = spark.read.parquet(f"{out}/features_merged")
    assert merged.count() > 0 and merged.select("user_id").distinct().count() == merged.count()
    run_id = jobs.train_job(spark, out, params={"maxIter": 20})
    runs = spark.read.parquet(f"{out}/runs").filter(F.col("run_id") == run_id)
    assert runs.filter("kind = 'metric'").count() == 10
    facts = {r["name"]: r["value"] for r in runs.filter("kind = 'param'").collect()}
    assert 1 <= int(facts["trees"]) <= int(facts["rounds_trained"]) <= 20
    assert {"train_size", "test_size", "n_features", "churn_rate", "scale_pos_weight"} <= set(facts)
    assert spark.read.parquet(f"{out}/attributions").count() == merged.count()
    importance = spark.read.parquet(f"{out}/permutation_importance")
    assert importance.count() == int(facts["n_features"])
    scored = jobs.score_job(spark, out)
    rows = scored.collect()
    probs, rule_archetypes = [r["churn_probability"] for r in rows], {r["archetype"] for r in rows}
    assert probs and all(0.0 <= p <= 1.0 for p in probs)
    again = [r["churn_probability"] for r in jobs.score_job(spark, out).collect()]
    assert sorted(again) == sorted(probs)
    jobs.cluster_job(spark, out)
    labels = spark.read.parquet(f"{out}/cluster_labels")
    assert labels.count() == merged.filter("total_sessions >= 2").count()
    # with a cluster model the archetype is that of the cluster; rows come from an uploaded CSV without ids
    named = {r["archetype"] for r in spark.read.parquet(f"{out}/cluster_names").collect()} | {"Outlier"}
    upload = merged.drop("user_id", "weekend_activity_ratio").withColumn("weekend_activity_ratio", F.lit("0.25"))
    upload.select([F.col(c).cast("string") for c in upload.columns]).write.option("header", True).csv(f"{out}/upload")
    from_csv = jobs.score_job(spark, out, f"{out}/upload", f"{out}/predictions")
    assert from_csv.count() == merged.count() and from_csv.where("user_id IS NOT NULL").count() == 0
    assert {r["archetype"] for r in from_csv.collect()} <= named and rule_archetypes
    back = spark.read.option("header", True).csv(f"{out}/predictions")
    assert back.count() == merged.count() and "top_risk_factors" in back.columns
    jobs.monitor_job(spark, out)
    summary = json.loads(open([os.path.join(f"{out}/shift_summary", f) for f in os.listdir(f"{out}/shift_summary") if f.endswith(".json")][0]).readline())
    assert summary["n_total_features"] == 18
    assert summary["test"] == "Kolmogorov-Smirnov"


def test_raw_csv_text_layout(spark, scratch, event_root):
    """The raw files carry the zone-suffixed time text and the nine columns."""
    csv_dir = f"{scratch}/csv"
    raw = spark.read.option("header", True).csv(csv_dir)
    assert raw.columns == EVENT_COLUMNS
    assert raw.filter(~F.col("event_time").rlike(r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2} UTC$")).count() == 0


def test_onehot_vocabulary_is_bounded(spark):
    ev = ad.order_events(spark, SF_SMALL)
    cats = feat.onehot_categories(ev)
    assert cats == sorted(cats) and len(cats) > 1
    with pytest.raises(ValueError):
        feat.onehot_categories(ev, max_categories=1)


def test_training_ends_by_the_stopping_rule(spark):
    """The label follows a noisy rule: the AUC stops rising, and the kept trees are those up to the best round."""
    from shopsignals.models import churn

    df = spark.range(3000).selectExpr(
        "id AS user_id", "cast(hash(id, 1) % 100 AS double) AS a", "cast(hash(id, 2) % 100 AS double) AS b",
        "cast(CASE WHEN hash(id, 3) % 5 = 0 THEN hash(id, 4) % 2 = 0 ELSE hash(id, 1) % 100 > 0 END AS int) AS churned",
    )
    model, prepared = churn.train(df, ["a", "b"], params={"maxIter": 60, "maxDepth": 3, "stepSize": 0.5}, patience=3)
    facts = model.params
    assert facts["stopped_by_patience"] and facts["trees"] <= facts["rounds_trained"] - 3
    assert model.model.stages[-1].getNumTrees == facts["trees"]
    assert churn.model_info(model).first()["n_trees"] == facts["trees"]
    scored = churn.score(model, prepared.where("is_test"))
    ones, zeros = (scored.where(f"churned = {c}").agg(F.avg("churn_proba")).first()[0] for c in (1, 0))
    assert ones > zeros + 0.3
    balance = prepared.where("NOT is_test").groupBy("churned").count().collect()
    n = {r["churned"]: r["count"] for r in balance}
    assert prepared.where("churned = 1").first()["weight"] == pytest.approx(n[0] / n[1])


def test_windows_prune_folders_and_are_compared(spark, scratch, event_root):
    from shopsignals.plans import jobs
    from shopsignals.sources.events import in_window

    events = load_events(spark, event_root)
    lo, hi = events.agg(F.min("event_time"), F.max("event_time")).first()
    middle = lo + (hi - lo) / 2
    early = in_window(events, str(lo), str(middle))
    plan = early._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "year" in filters and "month" in filters
    late = in_window(events, str(middle), "2100-01-01")
    assert early.count() + late.count() == events.count()
    out = f"{scratch}/windows"
    jobs.monitor_windows_job(spark, event_root, out, (str(lo), str(middle)), (str(middle), "2100-01-01"), affinity_categories=ad.CLICKSTREAM_CATEGORIES)
    assert spark.read.parquet(f"{out}/shift_details").count() == 18
    assert jobs._months("2019-10,2019-11") == [(2019, 10), (2019, 11)]
    assert jobs._window("2020-01-01,2020-02-01") == ("2020-01-01", "2020-02-01")
