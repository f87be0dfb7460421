"""End-to-end jobs: the stages a user runs, each one distributed job.

    ingest    raw CSV files → events (partitioned Parquet)
    features  events (partitioned Parquet) → cells (partial aggregates) →
              session / temporal / category families and the merged table;
              with --update the cells are a state by month, and only the
              events of --months are read
    train     merged features → churn model, importances (of the trees and by
              permutation), attributions, facts and metrics appended to a
              run table
    cluster   merged features → cluster model, labels, profiles (JSON)
    score     merged features or an uploaded CSV → scored rows + summary
    monitor   merged features (or two time windows of the events) → KS
              details, verdict, overlay

Stage outputs are tables in ``out``; later stages read them, so a stage can
be re-run on its own and intermediate results survive executor loss.

Usage: python -m shopsignals.plans.jobs <stage> --events DIR --out DIR
       [--csv GLOB] [--months 2019-10,2019-11] [--horizon DAYS]
       [--baseline START,END --current START,END] [--predictions DIR]
"""

from __future__ import annotations

import argparse

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopsignals.models import churn as churn_model
from shopsignals.models import clusters as cluster_model
from shopsignals.operators import cells, evaluation, features, profiles, scoring, shift
from shopsignals.session import build_session
from shopsignals.sources import sinks
from shopsignals.sources.events import in_window, ingest_csv, load_events, path_exists


def features_job(
    spark: SparkSession,
    events_root: str,
    out: str,
    months: list[tuple[int, int]] | None = None,
    horizon_days: float = features.DEFAULT_HORIZON_DAYS,
    affinity_categories=features.DEFAULT_AFFINITY_CATEGORIES,
    onehot=None,
) -> None:
    """Cells are written once from the events; the families and the merged table roll up from them."""
    ev = load_events(spark, events_root, months)
    sinks.save_table(cells.user_cells(ev), f"{out}/cells")
    _write_features(ev, sinks.read_features(spark, f"{out}/cells"), out, horizon_days, affinity_categories, onehot)


def update_features_job(
    spark: SparkSession,
    events_root: str,
    out: str,
    months: list[tuple[int, int]],
    horizon_days: float = features.DEFAULT_HORIZON_DAYS,
    affinity_categories=features.DEFAULT_AFFINITY_CATEGORIES,
    onehot=None,
) -> None:
    """Features of all months so far, reading the events of ``months`` only.

    The cells of these months are added to the state (``out/state``) or
    replaced in it, so a run can be repeated; features roll up from the state.
    The midpoint's hour is looked up in the events with folders pruned.
    """
    cells.write_cells(cells.user_cells(load_events(spark, events_root, months)), f"{out}/state")
    _write_features(load_events(spark, events_root), cells.read_cells(spark, f"{out}/state"), out, horizon_days, affinity_categories, onehot)


def _write_features(ev: DataFrame, state: DataFrame, out: str, horizon_days: float, affinity_categories, onehot) -> None:
    merged = cells.features_from_cells(state, ev, horizon_days, affinity_categories, onehot)
    sinks.save_table(merged, f"{out}/features_merged")
    bounds = cells.cell_bounds(state) or (0, 0)
    sinks.save_table(features.session_columns_of(cells.cell_sessions(state), bounds, horizon_days), f"{out}/features_session")
    activity = cells.cell_activity(state, ev, bounds, affinity_categories)
    sinks.save_table(activity.select("user_id", *features._temporal_columns()), f"{out}/features_temporal")
    wanted = onehot if onehot is not None else [c.removeprefix("topcategory_") for c in merged.columns if c.startswith("topcategory_")]
    sinks.save_table(features.category_columns_of(activity, cells.cell_views(state), affinity_categories, wanted), f"{out}/features_category")


def train_job(spark: SparkSession, out: str, params: dict | None = None) -> str:
    feats = sinks.read_features(spark, f"{out}/features_merged")
    model, prepared = churn_model.train(feats, params=params)
    model.save(f"{out}/churn_model")
    sinks.save_table(churn_model.feature_importance(model, None), f"{out}/feature_importance")
    attrs, _ = churn_model.tree_attributions(model, feats)
    sinks.save_table(attrs, f"{out}/attributions")
    sinks.save_table(churn_model.permutation_importance(model, prepared.filter("is_test")), f"{out}/permutation_importance")
    metrics = {}
    for split, cond in (("train", ~F.col("is_test")), ("test", F.col("is_test"))):
        s = churn_model.score(model, prepared.filter(cond)).select(
            F.col("churned").alias("label"), F.col("churn_proba").alias("score")
        )
        curves = evaluation.summary_curves(s)
        row = (
            evaluation.threshold_metrics(s)
            .withColumns(
                {"roc_auc": curves.select("roc_auc").scalar(), "average_precision": curves.select("average_precision").scalar()}
            )
            .first()
            .asDict()
        )
        metrics[split] = {k: row[k] for k in ("precision", "recall", "f1", "roc_auc", "average_precision")}
    return churn_model.log_run(spark, f"{out}/runs", model.params, metrics)


def cluster_job(spark: SparkSession, out: str) -> None:
    feats = sinks.read_features(spark, f"{out}/features_merged")
    model, labelled = cluster_model.fit(feats)
    model.save(f"{out}/cluster_model")
    prof = profiles.cluster_profiles(labelled, "cluster", profiles.CLUSTER_FEATURES + ["total_purchases"])
    names = cluster_model.name_clusters(prof)
    sinks.save_table(
        labelled.join(F.broadcast(names), "cluster", "left").select("user_id", "cluster", "archetype"),
        f"{out}/cluster_labels",
    )
    sinks.save_json(prof.drop("archetype").join(names, "cluster"), f"{out}/cluster_profiles")
    sinks.save_table(names, f"{out}/cluster_names")


def score_job(spark: SparkSession, out: str, csv_path: str | None = None, predictions_csv: str | None = None) -> DataFrame:
    """Score the feature table or an uploaded CSV; written once, summarised from what was written.

    Columns of the model are cast to numbers and padded by the model's own
    list.  Rows may lack an id.  With a trained cluster model the archetype is
    that of the user's cluster, otherwise that of the rules.
    """
    feats = sinks.read_scoring_csv(spark, csv_path) if csv_path else sinks.read_features(spark, f"{out}/features_merged")
    if "user_id" not in feats.columns:
        feats = feats.withColumn("user_id", F.lit(None).cast("long"))
    sinks.save_table(scoring.validate_features(feats), f"{out}/checked")
    checked = sinks.read_features(spark, f"{out}/checked")
    sinks.save_table(checked.filter(~F.col("is_valid")).select("user_id", "rejection_reasons"), f"{out}/rejected")
    pm = PipelineModel.load(f"{out}/churn_model")
    cols = list(pm.stages[0].getInputCols())
    clusters = cluster_model.ClusterModel.load(spark, f"{out}/cluster_model") if path_exists(spark, f"{out}/cluster_model") else None
    wanted = list(dict.fromkeys([*cols, *scoring.REQUEST_FIELDS, *(clusters.feature_cols if clusters else [])]))
    valid = checked.filter("is_valid")
    numbers = valid.select(
        "user_id", *[F.coalesce(F.col(c).try_cast("double"), F.lit(0.0)).alias(c) for c in wanted if c in valid.columns]
    )
    padded = scoring.pad_features(numbers, wanted, keep=["user_id"])
    scored_in = churn_model.score(churn_model.ChurnModel(pm, cols), padded)
    archetype = None
    if clusters:
        names = sinks.read_features(spark, f"{out}/cluster_names")  # one row per cluster
        assigned = cluster_model.assign(clusters, scored_in).drop("pca")
        scored_in = assigned.join(F.broadcast(names.withColumnRenamed("archetype", "_archetype")), "cluster", "left").withColumn(
            "cluster_archetype", F.coalesce("_archetype", F.concat(F.lit("Cluster "), F.col("cluster").cast("string")))
        )
        archetype = "cluster_archetype"
    sinks.save_table(scoring.score_users(scored_in, "churn_proba", archetype), f"{out}/scored_table")
    scored = sinks.read_features(spark, f"{out}/scored_table")
    sinks.save_json(scored, f"{out}/scored")
    if predictions_csv:
        sinks.write_scoring_csv(scored, predictions_csv)
    summary = scoring.batch_summary(scored).withColumn(
        "archetype_distribution", scoring.archetype_map(scored).scalar()
    )
    sinks.save_json(summary, f"{out}/score_summary")
    return scored


def monitor_job(spark: SparkSession, out: str, baseline_path: str | None = None, current_path: str | None = None) -> None:
    if baseline_path and current_path:
        base, cur = sinks.read_features(spark, baseline_path), sinks.read_features(spark, current_path)
    else:
        base, cur = shift.positional_split(sinks.read_features(spark, f"{out}/features_merged"))
    feats = shift.available_features(base)
    details = shift.ks_details(base, cur, feats)
    sinks.save_table(details, f"{out}/shift_details")
    details = sinks.read_features(spark, f"{out}/shift_details")
    sinks.save_json(shift.shift_verdict(details), f"{out}/shift_summary")
    overlay = shift.distribution_overlay(base, cur, feats, wanted=shift.top_shifted(details))
    sinks.save_table(overlay, f"{out}/shift_overlay")


def monitor_windows_job(
    spark: SparkSession,
    events_root: str,
    out: str,
    baseline: tuple[str, str],
    current: tuple[str, str],
    horizon_days: float = features.DEFAULT_HORIZON_DAYS,
    affinity_categories=features.DEFAULT_AFFINITY_CATEGORIES,
) -> None:
    """Shift report between two time windows of the event log ([start, end)
    as timestamps): features are built per window, then compared.  A
    scheduler runs this weekly with the last two weeks; scheduling itself is
    left to the caller."""
    ev = load_events(spark, events_root)
    for name, (start, end) in (("baseline", baseline), ("current", current)):
        win = in_window(ev, start, end)
        sinks.save_table(
            features.user_features(win, horizon_days, affinity_categories), f"{out}/features_{name}"
        )
    monitor_job(spark, out, f"{out}/features_baseline", f"{out}/features_current")


def _months(text: str | None) -> list[tuple[int, int]] | None:
    """``2019-10,2019-11`` as (year, month) pairs."""
    return [tuple(int(x) for x in m.split("-")) for m in text.split(",")] if text else None


def _window(text: str) -> tuple[str, str]:
    start, end = text.split(",")
    return start, end


def main(argv=None):
    ap = argparse.ArgumentParser(prog="shopsignals")
    ap.add_argument("stage", choices=["ingest", "features", "train", "cluster", "score", "monitor"])
    ap.add_argument("--events", help="folder of the event table")
    ap.add_argument("--out", help="folder of the stage outputs")
    ap.add_argument("--csv", help="ingest: raw files; score: uploaded rows")
    ap.add_argument("--predictions", help="score: folder for the scored rows as CSV")
    ap.add_argument("--months", help="features: 2019-10,2019-11")
    ap.add_argument("--update", action="store_true", help="features: add --months to the state")
    ap.add_argument("--horizon", type=float, default=features.DEFAULT_HORIZON_DAYS, help="days without a purchase")
    ap.add_argument("--baseline", type=_window, help="monitor: start,end of the first window")
    ap.add_argument("--current", type=_window, help="monitor: start,end of the second window")
    ap.add_argument("--master")
    args = ap.parse_args(argv)
    spark = build_session("shopsignals-" + args.stage, master=args.master)
    if args.stage == "ingest":
        ingest_csv(spark, args.csv, args.events)
    elif args.stage == "features" and args.update:
        update_features_job(spark, args.events, args.out, _months(args.months), args.horizon)
    elif args.stage == "features":
        features_job(spark, args.events, args.out, _months(args.months), args.horizon)
    elif args.stage == "train":
        print(train_job(spark, args.out))
    elif args.stage == "cluster":
        cluster_job(spark, args.out)
    elif args.stage == "score":
        score_job(spark, args.out, args.csv, args.predictions)
    elif args.baseline and args.current:
        monitor_windows_job(spark, args.events, args.out, args.baseline, args.current, args.horizon)
    else:
        monitor_job(spark, args.out)


if __name__ == "__main__":
    main()
