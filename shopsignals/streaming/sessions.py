"""Structured Streaming forms of the session summary and daily active users.

* ``session_stream``: per user, gap-based session windows with a watermark;
  append mode emits a session once the watermark passes its end, so state
  stays bounded.  Windows that touch are merged, so a silence of exactly the
  gap stays inside a session, as in the batch rule.
* ``dau_stream``: users are de-duplicated per day, then counted per day, both
  under the watermark, so the counts are exact.
* ``closing_event``: a finite replay ends with one event far in the future; it
  moves the watermark past every open window, so the result is complete.  Its
  own window stays in state and is never written.

Rows later than the watermark are dropped by Structured Streaming without a
trace.  ``split_late`` puts them aside: a first query writes every micro-batch
in two folders, rows in time and late rows, by a watermark of its own that it
keeps per batch in the shared folder; ``in_time_stream`` reads the rows in time.
A batch of the second query is a run of batches of the first, so its watermark
is never ahead and it drops nothing: rows in sessions + late rows = input.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shopsignals.functions.numeric import exact_sum
from shopsignals.sources.events import EVENT_SCHEMA
from pyspark.sql import types as T

#: typed event schema of a streamed Parquet/JSON source
STREAM_EVENT_SCHEMA = T.StructType(
    [T.StructField("event_time", T.TimestampType(), True)]
    + [f for f in EVENT_SCHEMA.fields if f.name != "event_time" and f.name != "price"]
    + [T.StructField("price", T.DoubleType(), True)]
)


def read_event_stream(spark: SparkSession, path: str, fmt: str = "parquet", max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.format(fmt).schema(STREAM_EVENT_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def session_stream(events: DataFrame, gap: str = "12 hours", watermark: str = "12 hours") -> DataFrame:
    """Incremental session summary (per user and session window)."""
    purchase = F.col("event_type") == "purchase"

    def count_type(t):
        return F.sum(F.when(F.col("event_type") == t, 1).otherwise(0))

    return (
        events.withWatermark("event_time", watermark)
        .groupBy("user_id", F.session_window("event_time", gap).alias("session"))
        .agg(
            F.min("event_time").alias("session_start"),
            F.max("event_time").alias("session_end"),
            F.count(F.lit(1)).alias("total_events"),
            count_type("view").alias("views"),
            count_type("cart").alias("cart_adds"),
            count_type("purchase").alias("purchases"),
            exact_sum(F.when(purchase, F.col("price")).otherwise(F.lit(0.0))).cast("double").alias("session_revenue"),
        )
        .drop("session")
    )


def dau_stream(events: DataFrame, watermark: str = "1 day") -> DataFrame:
    """Exact distinct users per day; rows without a user or a time do not count."""
    return (
        events.withWatermark("event_time", watermark)
        .where("user_id IS NOT NULL")
        .select("user_id", F.window("event_time", "1 day").alias("day"))
        .dropDuplicates(["user_id", "day"])
        .groupBy("day")
        .agg(F.count(F.lit(1)).alias("dau"))
        .select(F.to_date(F.col("day.start")).alias("event_date"), "dau")
    )


def closing_event(events: DataFrame, after: str = "3650 days") -> DataFrame:
    """One row of the events' schema, ``after`` the last event, with every other column null but a user id."""
    last = events.agg((F.max("event_time") + F.expr(f"INTERVAL {after}")).alias("event_time"))
    return last.select(
        *[
            F.col("event_time") if f.name == "event_time"
            else F.lit(-1).cast(f.dataType).alias(f.name) if f.name == "user_id"
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in events.schema
        ]
    )


def split_late(events: DataFrame, root: str, checkpoint: str, delay: str = "12 hours", slack: str = "0 seconds") -> StreamingQuery:
    """Writes each micro-batch to ``root/batch=N/late=false|true`` (once, whatever is retried).

    A row is late if its time plus ``slack`` is not after the watermark, which is
    the latest time of all earlier batches less ``delay``.  With the session gap
    as ``slack`` the rule is that of ``session_stream``: a session's window ends
    a gap after its last row.  Rows without a time are late.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        earlier = spark.read.parquet(f"{root}_marks/batch={number - 1}").first()["mark"] if number else None
        in_time = F.col("event_time").isNotNull()
        if earlier is not None:
            in_time = in_time & (F.col("event_time") + F.expr(f"INTERVAL {slack}") > F.lit(earlier) - F.expr(f"INTERVAL {delay}"))
        batch.withColumn("late", ~in_time).write.mode("overwrite").partitionBy("late").parquet(f"{root}/batch={number}")
        # the latest time so far, from what was written
        mark = spark.read.schema(batch.schema).parquet(f"{root}/batch={number}").agg(F.greatest(F.max("event_time"), F.lit(earlier).cast("timestamp")).alias("mark"))
        mark.write.mode("overwrite").parquet(f"{root}_marks/batch={number}")

    return events.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def split_arrivals(arrivals: Iterable[DataFrame], root: str, delay: str = "12 hours", slack: str = "0 seconds") -> None:
    """Each table in turn arrives in ``root/source`` as one micro-batch of ``split_late`` (to ``root/split``).

    A table is written by as many tasks as it has, and the split resumes from its
    checkpoint after each, so no batch has to be one file written by one task.
    """
    for rows in arrivals:
        rows.write.mode("append").parquet(f"{root}/source")
        source = read_event_stream(rows.sparkSession, f"{root}/source")
        split_late(source, f"{root}/split", f"{root}/ck_split", delay, slack).awaitTermination()


def in_time_stream(spark: SparkSession, root: str) -> DataFrame:
    """The rows that ``split_late`` found in time, as a stream in the order of its batches."""
    return spark.readStream.format("parquet").schema(STREAM_EVENT_SCHEMA).load(f"{root}/batch=*/late=false")


def late_rows(spark: SparkSession, root: str) -> DataFrame:
    """The rows put aside so far, with the number of their batch."""
    schema = T.StructType([*STREAM_EVENT_SCHEMA.fields, T.StructField("batch", T.LongType()), T.StructField("late", T.BooleanType())])
    return spark.read.schema(schema).parquet(root).where("late").drop("late")


def start_to_parquet(df: DataFrame, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Append results to Parquet with a checkpoint in the shared folder, so a
    restarted query resumes where it stopped (exactly-once file sink)."""
    w = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start(path)
