"""Catalog side of the event table: database, external partitioned table,
partition discovery, and the reports over a registered table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shopsignals.operators.reports import REPORTS

EVENT_TABLE_DDL = """CREATE TABLE IF NOT EXISTS {table} (
    event_time    TIMESTAMP,
    event_type    STRING,
    product_id    INT,
    category_id   BIGINT,
    category_code STRING,
    brand         STRING,
    price         DOUBLE,
    user_id       BIGINT,
    user_session  STRING,
    year          INT,
    month         INT,
    source        STRING
)
USING parquet
PARTITIONED BY (year, month, source)
LOCATION '{location}'
OPTIONS ('compression' = 'snappy')"""


def create_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")


def create_event_table(spark: SparkSession, qualified_name: str, location: str) -> None:
    """External table over ``year=/month=/source=`` folders written by ``write_events_parquet``."""
    spark.sql(EVENT_TABLE_DDL.format(table=qualified_name, location=location))


def repair_partitions(spark: SparkSession, qualified_name: str) -> None:
    """Register partition folders added since the table was created."""
    spark.sql(f"MSCK REPAIR TABLE {qualified_name}")


def run_report(spark: SparkSession, name: str, qualified_name: str) -> DataFrame:
    """One of ``operators.reports.REPORTS`` over a registered table."""
    return REPORTS[name](spark.table(qualified_name))
