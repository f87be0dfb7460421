"""Map the generic test tables onto the event schema.

The production input is the event log (``sources.events``).  The test tables
shipped with this repository's driver are a clickstream (``events``) and a
TPC-H-like order schema; two adapters turn them into event tables so that
every operator runs on them unchanged.  Both are plain DataFrame plans, and
both have a SQL twin (``*_sql``) so that DuckDB can check the results.

Adapter A, ``clickstream_events``: events ⟕ part.
  * ``click`` becomes ``cart``; ``view`` and ``purchase`` stay; other types stay
    as they are (they count in totals, not in the three counters).
  * product_id is the first number in ``props``; the part row gives category
    and brand; category is null when product_id % 10 = 1, brand when it is 0.
  * sessions: a gap of more than 12 hours starts a new session.

Adapter B, ``order_events``: lineitem ⋈ orders ⟕ part.
  * event_time = l_shipdate, user = o_custkey, session = the order key,
    return flag N/A/R → view/cart/purchase, price = l_extendedprice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopsignals.operators.sessionize import sessionize_by_gap, sessionize_sql
from shopsignals.session import ensure_utc

# Fixed values of the test-table mapping.
SESSION_GAP_SECONDS = 12 * 3600
#: affinity categories for the clickstream adapter (the part types, lower case)
CLICKSTREAM_CATEGORIES = ["economy", "small", "medium", "promo", "standard", "large"]
#: churn horizon that gives both classes on the 30-day clickstream
CLICKSTREAM_HORIZON_DAYS = 2
#: the reference horizon, used with the multi-year order data
ORDERS_HORIZON_DAYS = 14
RETURNFLAG_EVENT = {"N": "view", "A": "cart", "R": "purchase"}


def _part_attributes(part: DataFrame, key: F.Column) -> list:
    return [
        F.col("p_size").alias("category_id"),
        F.when(key % 10 == 1, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lower("p_type"), F.lit("."), F.split_part("p_name", F.lit(" "), F.lit(2))))
        .alias("category_code"),
        F.when(key % 10 == 0, F.lit(None).cast("string")).otherwise(F.col("p_brand")).alias("brand"),
    ]


def clickstream_events(spark: SparkSession, sf_dir: str, sessionize: bool = True) -> DataFrame:
    """Adapter A → event table with user_session (and the source event_id)."""
    ensure_utc(spark)
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    part = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    product = F.regexp_extract("props", "[0-9]+", 0).try_cast("int")
    base = ev.select(
        "event_id",
        F.col("ts").cast("timestamp").alias("event_time"),
        F.when(F.col("event_type") == "click", F.lit("cart")).otherwise(F.col("event_type")).alias("event_type"),
        product.alias("product_id"),
        F.col("value").alias("price"),
        "user_id",
    )
    # The part side is a dimension; AQE broadcasts it when small at run time
    # and splits skewed product keys otherwise.
    joined = base.join(part, base.product_id == part.p_partkey, "left").select(
        "event_id",
        "event_time",
        "event_type",
        "product_id",
        *_part_attributes(part, F.col("product_id")),
        "price",
        "user_id",
    )
    if not sessionize:
        return joined
    return sessionize_by_gap(
        joined, "user_id", "event_time", ("event_id",), gap_seconds=SESSION_GAP_SECONDS
    )


def order_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adapter B → event table from line items (one session per order)."""
    ensure_utc(spark)
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        "l_orderkey", "l_partkey", "l_extendedprice", "l_returnflag", "l_shipdate"
    )
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_custkey")
    part = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    flag = F.col("l_returnflag")
    etype = F.when(flag == "N", "view").when(flag == "A", "cart").when(flag == "R", "purchase")
    joined = li.join(orders, li.l_orderkey == orders.o_orderkey, "inner").join(
        part, li.l_partkey == part.p_partkey, "left"
    )
    return joined.select(
        F.col("l_shipdate").cast("timestamp").alias("event_time"),
        etype.alias("event_type"),
        F.col("l_partkey").cast("int").alias("product_id"),
        *_part_attributes(part, F.col("l_partkey")),
        F.col("l_extendedprice").alias("price"),
        F.col("o_custkey").alias("user_id"),
        F.col("l_orderkey").cast("string").alias("user_session"),
    )


# ---------------------------------------------------------------- SQL twins

def _part_sql(key: str) -> str:
    return f"""p.p_size AS category_id,
      CASE WHEN {key} % 10 = 1 THEN NULL
           ELSE lower(p.p_type) || '.' || split_part(p.p_name, ' ', 2) END AS category_code,
      CASE WHEN {key} % 10 = 0 THEN NULL ELSE p.p_brand END AS brand"""


def clickstream_events_sql() -> str:
    """DuckDB text of adapter A (a sub-query usable as a CTE body)."""
    base = f"""
      SELECT e.event_id, CAST(e.ts AS TIMESTAMP) AS event_time,
             CASE WHEN e.event_type = 'click' THEN 'cart' ELSE e.event_type END AS event_type,
             TRY_CAST(regexp_extract(e.props, '[0-9]+', 0) AS INTEGER) AS product_id,
             e.value AS price, e.user_id
      FROM events e"""
    joined = f"""(
      SELECT b.event_id, b.event_time, b.event_type, b.product_id, {_part_sql('b.product_id')},
             b.price, b.user_id
      FROM ({base}) b LEFT JOIN part p ON p.p_partkey = b.product_id)"""
    return sessionize_sql(joined, "user_id", "event_time", ("event_id",), SESSION_GAP_SECONDS)


def order_events_sql() -> str:
    return f"""
      SELECT CAST(l.l_shipdate AS TIMESTAMP) AS event_time,
             CASE l.l_returnflag WHEN 'N' THEN 'view' WHEN 'A' THEN 'cart' WHEN 'R' THEN 'purchase' END AS event_type,
             CAST(l.l_partkey AS INTEGER) AS product_id,
             {_part_sql('l.l_partkey')},
             l.l_extendedprice AS price, o.o_custkey AS user_id,
             CAST(l.l_orderkey AS VARCHAR) AS user_session
      FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
      LEFT JOIN part p ON p.p_partkey = l.l_partkey"""
