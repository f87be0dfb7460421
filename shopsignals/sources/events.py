"""Event table: schema, CSV ingest, partitioned Parquet, readers.

Production layout: ``<root>/year=YYYY/month=M/source=<file>/part-*.parquet``
written with ``partitionBy`` so that a month filter prunes whole folders and
the partition values are not repeated inside the files.

Ingest can be repeated: ``<root>/_ingested`` lists the files taken so far (path,
size, time of change).  Files listed there are not read again; a changed file
replaces its own folders and no others.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from shopsignals.session import ensure_utc

#: raw CSV columns and types of the event log
EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_time", T.StringType(), True),
        T.StructField("event_type", T.StringType(), True),
        T.StructField("product_id", T.IntegerType(), True),
        T.StructField("category_id", T.LongType(), True),
        T.StructField("category_code", T.StringType(), True),
        T.StructField("brand", T.StringType(), True),
        T.StructField("price", T.FloatType(), True),
        T.StructField("user_id", T.LongType(), True),
        T.StructField("user_session", T.StringType(), True),
    ]
)

#: columns of the typed event table, in order
EVENT_COLUMNS = [f.name for f in EVENT_SCHEMA.fields]

#: text form of event_time in the raw files, e.g. "2019-10-01 00:00:00 UTC"
EVENT_TIME_PATTERN = "yyyy-MM-dd HH:mm:ss z"


class MissingInputError(FileNotFoundError):
    """Raised when an input is absent; the message says what to run first."""


def parse_event_time(c) -> "F.Column":
    """Text → UTC timestamp; accepts the zone suffix or a plain timestamp."""
    col = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.try_to_timestamp(col, F.lit(EVENT_TIME_PATTERN)), col.cast("timestamp"))


def typed_events(raw: DataFrame, *more) -> DataFrame:
    """Cast raw columns to the event types; price becomes double for sums.  ``more`` are further columns to keep."""
    return raw.select(
        parse_event_time("event_time").alias("event_time"),
        F.col("event_type").cast("string"),
        F.col("product_id").cast("int"),
        F.col("category_id").cast("bigint"),
        F.col("category_code").cast("string"),
        F.col("brand").cast("string"),
        F.col("price").cast("double"),
        F.col("user_id").cast("bigint"),
        F.col("user_session").cast("string"),
        *more,
    )


def write_events_csv(events: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Raw layout of the monthly event files: header, the nine columns in
    order, ``event_time`` as text with the zone suffix (``2019-10-01 00:00:00
    UTC``).  A distributed write; one file per task."""
    events.select(
        F.date_format("event_time", "yyyy-MM-dd HH:mm:ss 'UTC'").alias("event_time"),
        *EVENT_COLUMNS[1:],
    ).write.mode(mode).option("header", True).csv(path)


def with_partition_columns(events: DataFrame) -> DataFrame:
    return events.withColumn("year", F.year("event_time")).withColumn("month", F.month("event_time"))


def read_events_csv(spark: SparkSession, path: str | Iterable[str]) -> DataFrame:
    """CSV scan with a declared schema (no inference); glob paths allowed."""
    ensure_utc(spark)
    paths = [path] if isinstance(path, str) else list(path)
    try:
        raw = spark.read.schema(EVENT_SCHEMA).option("header", True).csv(paths)
    except AnalysisException as exc:  # PATH_NOT_FOUND, empty glob
        raise MissingInputError(
            f"No event CSV found at {paths}: download the monthly event files first."
        ) from exc
    return typed_events(raw)


def write_events_parquet(events: DataFrame, root: str, mode: str = "append", source: str = "direct") -> None:
    """Partitioned Parquet sink: ``year=/month=/source=`` folders, Snappy."""
    if "source" not in events.columns:
        events = events.withColumn("source", F.lit(source))
    (
        with_partition_columns(events)
        .write.mode("overwrite" if mode == "replace" else mode)
        .option("partitionOverwriteMode", "dynamic" if mode == "replace" else "static")
        .option("compression", "snappy")
        .partitionBy("year", "month", "source")
        .parquet(root)
    )


def source_slug(path) -> "F.Column":
    """Folder name of a raw file: its own name, and a hash of its whole path."""
    name = F.lower(F.element_at(F.split(path, "/"), -1))
    return F.concat(F.regexp_replace(name, "[^a-z0-9]+", "_"), F.lit("_"), F.lower(F.hex(F.xxhash64(path))))


def raw_files(spark: SparkSession, csv_glob: str) -> DataFrame:
    """``path, size, changed, source`` of the raw files; contents are not read."""
    file = F.col("_metadata")
    try:
        files = spark.read.format("binaryFile").load(csv_glob)
    except AnalysisException as exc:
        raise MissingInputError(f"No event CSV found at {csv_glob}: download the monthly event files first.") from exc
    return files.select(
        file["file_path"].alias("path"), file["file_size"].alias("size"), file["file_modification_time"].alias("changed"), source_slug(file["file_path"]).alias("source")
    )


def ingest_csv(spark: SparkSession, csv_glob: str, root: str, mode: str = "append") -> int:
    """CSV → typed → partitioned Parquet; returns the number of files taken.

    Running it again takes only files that are new or have changed.  The list
    of files is written last: after a failure the same files are taken again,
    and their folders replaced.  ``overwrite`` starts an empty table.
    """
    listed = f"{root.rstrip('/')}/_ingested"
    files = raw_files(spark, csv_glob)
    fresh = mode == "overwrite" or not path_exists(spark, listed)
    known = None if fresh else spark.read.parquet(listed)
    todo = files if known is None else files.join(known, ["path", "size", "changed"], "left_anti")
    # one row per raw file
    rows = todo.collect()
    if not rows:
        if known is None:
            raise MissingInputError(f"No event CSV found at {csv_glob}: download the monthly event files first.")
        return 0
    if known is not None:
        changed = known.select("source").distinct().join(spark.createDataFrame([(r["source"],) for r in rows], "source string"), "source")
        for r in changed.collect():
            delete_paths(spark, f"{root.rstrip('/')}/year=*/month=*/source={r['source']}")
    raw = spark.read.schema(EVENT_SCHEMA).option("header", True).csv([r["path"] for r in rows])
    ensure_utc(spark)
    events = typed_events(raw, source_slug(F.col("_metadata.file_path")).alias("source"))
    write_events_parquet(events, root, "overwrite" if mode == "overwrite" else "replace")
    spark.createDataFrame([tuple(r) for r in rows], files.schema).write.mode("append").parquet(listed)
    return len(rows)


def delete_paths(spark: SparkSession, pattern: str) -> None:
    """Folders that match a pattern, in any store that Spark reads."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    fs = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    for found in fs.globStatus(jvm_path) or []:
        fs.delete(found.getPath(), True)


def load_events(
    spark: SparkSession,
    root: str,
    months: Iterable[tuple[int, int]] | None = None,
) -> DataFrame:
    """Read the partitioned event table; ``months`` = [(year, month), …].

    The month filter is on partition columns, so Spark prunes folders.
    """
    ensure_utc(spark)
    try:
        df = spark.read.parquet(root)
    except AnalysisException as exc:
        raise MissingInputError(
            f"Event table not found at {root}: run the CSV ingest (ingest_csv) first."
        ) from exc
    if months:
        cond = None
        for y, m in months:
            c = (F.col("year") == y) & (F.col("month") == m)
            cond = c if cond is None else cond | c
        df = df.filter(cond)
    return df.drop("source")


def in_window(events: DataFrame, start: str, end: str) -> DataFrame:
    """Rows with start <= event_time < end (UTC text or timestamps).

    The months of the window are a predicate on the partition columns as well,
    so only their folders are read.
    """
    lo, hi = F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")
    out = events.filter((F.col("event_time") >= lo) & (F.col("event_time") < hi))
    if {"year", "month"} <= set(events.columns):
        ym = F.col("year") * 100 + F.col("month")
        out = out.filter((ym >= F.year(lo) * 100 + F.month(lo)) & (ym <= F.year(hi) * 100 + F.month(hi)))
    return out


def load_table(spark: SparkSession, path: str, produced_by: str = "the step that writes it") -> DataFrame:
    """Parquet scan of a derived table with a clear hint when it is missing."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as exc:
        raise MissingInputError(f"{path} not found. Run {produced_by} first.") from exc


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether Spark's file system has the path (any store, not only local)."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path)
