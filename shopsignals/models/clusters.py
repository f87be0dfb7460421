"""Behavioural clusters on Spark ML, with a noise label.

The original groups users with a density method that marks outliers as −1.
On Spark the same outcome is built from distributed pieces:

    standard scaling → PCA (8 components) → k-means, then
    noise = −1 when a user is farther from its centre than the cluster's
    ``noise_quantile`` distance, or the cluster holds fewer than
    ``min_cluster_share`` of the users.

``fit_density`` finds the clusters and the noise by density in the same space;
the k-means model is the one that is saved and assigns new users.

Scaling note: Spark's ``StandardScaler`` divides by the sample standard
deviation (scikit-learn by the population one); the difference is a constant
factor per column, which PCA directions and k-means assignments do not
depend on.  Cluster ids are arbitrary; each cluster is named by applying the
archetype rules to its mean profile.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopsignals.functions import rules
from shopsignals.models.density import density_clusters
from shopsignals.operators.profiles import NOISE_CLUSTER, clustering_input
from shopsignals.session import materialize

# Clustering settings.
PCA_COMPONENTS = 8
N_CLUSTERS = 7
NOISE_QUANTILE = 0.95
MIN_CLUSTER_SHARE = 0.01  # 2,000 of a 200,000-user sample
SEED = 42
MIN_SAMPLES = 50


@dataclass
class ClusterModel:
    model: PipelineModel
    feature_cols: list[str]
    thresholds: DataFrame  # cluster, max_distance, members, keep

    def save(self, path: str) -> None:
        self.model.write().overwrite().save(f"{path}/pipeline")
        self.thresholds.write.mode("overwrite").parquet(f"{path}/thresholds")

    @staticmethod
    def load(spark, path: str) -> "ClusterModel":
        model = PipelineModel.load(f"{path}/pipeline")
        return ClusterModel(model, model.stages[0].getInputCols(), spark.read.parquet(f"{path}/thresholds"))


def _pipeline(feature_cols: Sequence[str], k: int, components: int) -> Pipeline:
    return Pipeline(
        stages=[
            VectorAssembler(inputCols=list(feature_cols), outputCol="_raw", handleInvalid="keep"),
            StandardScaler(inputCol="_raw", outputCol="_scaled", withMean=True, withStd=True),
            PCA(k=min(components, len(feature_cols)), inputCol="_scaled", outputCol="pca"),
            KMeans(k=k, seed=SEED, featuresCol="pca", predictionCol="_kmeans", distanceMeasure="euclidean"),
        ]
    )


def _distance(model: PipelineModel) -> F.Column:
    centres = model.stages[-1].clusterCenters()
    arr = F.array(*[F.array(*[F.lit(float(x)) for x in c]) for c in centres])  # k × components constants
    v = vector_to_array("pca")
    centre = arr[F.col("_kmeans")]
    return F.sqrt(F.aggregate(F.zip_with(v, centre, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x))


def fit(
    features: DataFrame,
    k: int = N_CLUSTERS,
    components: int = PCA_COMPONENTS,
    noise_quantile: float = NOISE_QUANTILE,
    min_cluster_share: float = MIN_CLUSTER_SHARE,
) -> tuple[ClusterModel, DataFrame]:
    """Fit on users with >= 2 sessions; returns the model and their labels."""
    df, cols, _missing = clustering_input(features)
    model = _pipeline(cols, k, components).fit(df)
    scored = model.transform(df).withColumn("_dist", _distance(model))
    total = df.count()
    thresholds = scored.groupBy(F.col("_kmeans").alias("cluster")).agg(
        F.percentile_approx("_dist", noise_quantile, 10000).alias("max_distance"),
        F.count(F.lit(1)).alias("members"),
    ).withColumn("keep", F.col("members") >= F.lit(max(1.0, min_cluster_share * total)))
    thresholds = materialize(thresholds)  # k rows, reused by every assignment
    cm = ClusterModel(model, cols, thresholds)
    return cm, assign(cm, df, transformed=scored)


def fit_density(
    features: DataFrame,
    components: int = PCA_COMPONENTS,
    min_cluster_share: float = MIN_CLUSTER_SHARE,
    min_samples: int = MIN_SAMPLES,
) -> DataFrame:
    """``user_id, cluster`` by density (``models.density``) in the same scaled PCA space, -1 for noise.

    The smallest cluster is the same share of the users as in ``fit``; small
    tables take fewer neighbours for the core distance.
    """
    df, cols, _missing = clustering_input(features)
    stages = _pipeline(cols, 2, components).getStages()[:-1]
    space = materialize(Pipeline(stages=stages).fit(df).transform(df).select("user_id", vector_to_array("pca").alias("x")))
    users = space.count()
    least = max(5, round(min_cluster_share * users))
    found = density_clusters(space, least, min(min_samples, least), "user_id", "x")
    return found.select(F.col("id").alias("user_id"), F.col("label").alias("cluster"))


def assign(model: ClusterModel, df: DataFrame, transformed: DataFrame | None = None) -> DataFrame:
    """Cluster id per user (−1 for noise) using the stored centres and limits.

    The thresholds table has one row per cluster (k rows): a proven, tiny
    broadcast.
    """
    t = transformed if transformed is not None else model.model.transform(df).withColumn("_dist", _distance(model.model))
    j = t.join(F.broadcast(model.thresholds), t["_kmeans"] == model.thresholds["cluster"], "left")
    label = F.when(F.col("keep") & (F.col("_dist") <= F.col("max_distance")), F.col("_kmeans")).otherwise(
        F.lit(NOISE_CLUSTER)
    )
    return j.select(*df.columns, label.alias("cluster_id"), "pca").withColumnRenamed("cluster_id", "cluster")


def name_clusters(profiles: DataFrame) -> DataFrame:
    """Archetype per cluster from its mean profile; noise is 'Outlier'."""
    return profiles.select(
        "cluster",
        F.when(F.col("cluster") == NOISE_CLUSTER, F.lit(rules.ARCHETYPE_NAMES[NOISE_CLUSTER]))
        .otherwise(rules.rule_archetype())
        .alias("archetype"),
    )


def silhouette(labelled: DataFrame) -> DataFrame:
    """Silhouette of all non-noise users in PCA space, in Spark's squared-Euclidean
    form (linear in the users; ``euclidean_silhouette`` is the plain one)."""
    core = labelled.filter(F.col("cluster") != NOISE_CLUSTER)
    if core.select("cluster").distinct().limit(2).count() < 2:
        return core.sparkSession.createDataFrame([(0.0,)], "silhouette double")
    ev = ClusteringEvaluator(featuresCol="pca", predictionCol="cluster", metricName="silhouette")
    value = ev.evaluate(core.withColumn("cluster", F.col("cluster").cast("double")))
    return core.sparkSession.createDataFrame([(round(float(value), 4),)], "silhouette double")


#: points of the plain silhouette: it compares each with all others of the sample
SILHOUETTE_SAMPLE = 10_000


def euclidean_silhouette(labelled: DataFrame, sample: int = SILHOUETTE_SAMPLE, seed: int = SEED, key: str = "user_id") -> DataFrame:
    """Mean plain Euclidean silhouette of a fixed-size sample of the non-noise users (lowest hashes).

    The sample is the measure's parameter (its cost is quadratic); it goes to
    all tasks, each of which compares its rows of the sample with all of it.
    0 with fewer than two clusters; a cluster of one point has silhouette 0.
    """
    spark = labelled.sparkSession
    core = labelled.filter(F.col("cluster") != NOISE_CLUSTER).select(key, F.col("cluster").cast("long").alias("cluster"), vector_to_array("pca").alias("x"))
    taken = materialize(core.orderBy(F.xxhash64(key, F.lit(seed)), key).limit(sample).select("cluster", "x"))
    rows = taken.toArrow()
    labels = rows.column("cluster").to_numpy() if rows.num_rows else np.zeros(0, np.int64)
    names, group = np.unique(labels, return_inverse=True)
    if len(names) < 2:
        return spark.createDataFrame([(0.0,)], "silhouette double")
    points = np.array(rows.column("x").to_pylist())
    member = np.eye(len(names))[group]
    sizes, number = member.sum(axis=0), {int(c): k for k, c in enumerate(names)}

    def widths(batches):
        for b in batches:
            if not b.num_rows:
                continue
            x, own = np.array(b.column(1).to_pylist()), np.array([number[c] for c in b.column(0).to_pylist()])
            # one cluster coordinate at a time keeps the block at rows x sample
            d = np.sqrt(sum((x[:, [j]] - points[:, j]) ** 2 for j in range(x.shape[1])))
            total, at = d @ member, np.arange(len(x))
            inside = total[at, own] / np.maximum(sizes[own] - 1, 1)
            mean = total / sizes
            mean[at, own] = np.inf
            outside = mean.min(axis=1)
            top = np.maximum(inside, outside)
            s = np.where((sizes[own] > 1) & (top > 0), (outside - inside) / np.where(top > 0, top, 1), 0.0)
            yield pa.RecordBatch.from_arrays([pa.array(s)], names=["s"])

    parts = max(1, -(-rows.num_rows // 500))
    spread = taken.repartition(parts)
    return spread.mapInArrow(widths, "s double").agg(F.round(F.avg("s"), 4).alias("silhouette"))


def scaler_statistics(model: ClusterModel) -> DataFrame:
    """``feature, mean, std`` as the fitted scaler holds them (one row per feature)."""
    scaler = model.model.stages[1]
    rows = [(c, float(m), float(d)) for c, m, d in zip(model.feature_cols, scaler.mean.toArray(), scaler.std.toArray())]
    return SparkSession.getActiveSession().createDataFrame(rows, "feature string, mean double, std double")


def explained_variance(model: ClusterModel) -> DataFrame:
    """``component, share``: variance explained by each principal component, and by all as component 0."""
    shares = [float(x) for x in model.model.stages[2].explainedVariance.toArray()]
    rows = [(0, sum(shares)), *((i + 1, x) for i, x in enumerate(shares))]
    return SparkSession.getActiveSession().createDataFrame(rows, "component int, share double")
