"""Sinks: feature and label tables, attributions, JSON results, scoring CSV.

All writes are distributed DataFrame writes (object-store URIs work the same
as local paths); nothing is gathered on the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shopsignals.sources.events import load_table


def save_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None) -> None:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def save_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON lines, one object per row (nested structs, arrays and maps kept)."""
    df.write.mode(mode).json(path)


def read_scoring_csv(spark: SparkSession, path: str) -> DataFrame:
    """User feature rows uploaded as CSV (header, types inferred per column by
    the validation step, not by the reader)."""
    return spark.read.option("header", True).csv(path)


def write_scoring_csv(df: DataFrame, path: str) -> None:
    """Scored rows as CSV; nested factor arrays become text first."""
    from shopsignals.functions.rules import factors_text

    out = df
    if "top_risk_factors" in df.columns:
        out = out.withColumn("top_risk_factors", factors_text("top_risk_factors"))
    out.write.mode("overwrite").option("header", True).csv(path)


def read_features(spark: SparkSession, path: str) -> DataFrame:
    return load_table(spark, path, "the feature job (shopsignals.plans.jobs features)")
