"""Table scans and the fixture adapter.

The driver tables (TPC-H-like ``lineitem``/``orders``/``part``/``customer``/
``nation``) are mapped onto the retail source shape with the deterministic
rules of FIXTURES.md §4. Every later stage reads only what this adapter (or a
real feed with the same columns) produces.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.functions import iso_seconds, parse_ts
from tillflow.sources.schemas import (
    CANCEL_PREFIX, CANCELLATION, DEFAULT_TOPIC, PURCHASE, SOURCE_COLUMNS, TOPIC_PARTITIONS,
)


def read_table(spark: SparkSession, sf_dir: str, name: str, fmt: str = "parquet") -> DataFrame:
    """Table scan by name; ``fmt`` is a setting (parquet offline, delta where installed)."""
    path = os.path.join(sf_dir, f"{name}.{fmt}") if fmt == "parquet" else os.path.join(sf_dir, name)
    return spark.read.format(fmt).load(path)


def transactions(spark: SparkSession, sf_dir: str, share: tuple[int, int] = (0, 1)) -> DataFrame:
    """Source transactions (8 columns) derived from the driver tables.

    ``share`` (i, n) gives the i-th of n disjoint shares of the orders, by a hash of the order key; all of them together are the whole.

    lineitem is the large side. Orders are enriched with customer and nation
    first (an order-level join), then joined to the lines on the order key and
    to part on the part key. The planner picks the strategies: it broadcasts
    a side only when its measured size is under the broadcast threshold, and
    otherwise sort-merge joins with AQE splitting skewed keys.
    """
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_returnflag")
    od = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    li, od = in_share(li, "l_orderkey", share), in_share(od, "o_orderkey", share)
    pt = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice")
    cu = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    na = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    # customer and nation are joined at order level first: when customer is too
    # large to broadcast, its shuffle moves order-sized rows, not line-sized ones
    orders = (od.join(cu, od.o_custkey == cu.c_custkey)
                .join(na, cu.c_nationkey == na.n_nationkey)
                .select("o_orderkey", "o_custkey", "o_orderdate", "n_name"))
    j = (li.join(orders, li.l_orderkey == orders.o_orderkey)
           .join(pt, li.l_partkey == pt.p_partkey))
    returned = F.col("l_returnflag") == "R"
    part_key = F.col("l_partkey")
    return j.select(
        F.concat(F.when(returned, F.lit(CANCEL_PREFIX)).otherwise(F.lit("")),
                 F.col("l_orderkey").cast("string")).alias("InvoiceNo"),
        F.concat(part_key.cast("string"),
                 F.when(part_key % 10 == 0, F.lit("A")).otherwise(F.lit(""))).alias("StockCode"),
        F.when(part_key % 50 == 0, F.lit(None).cast("string")).otherwise(F.col("p_name")).alias("Description"),
        (F.col("l_quantity").cast("int") * F.when(returned, F.lit(-1)).otherwise(F.lit(1))).alias("Quantity"),
        (F.col("o_orderdate") + F.make_dt_interval(hours=(F.col("o_orderkey") % 24).cast("int")))
        .cast("timestamp_ntz").alias("InvoiceDate"),
        F.when(part_key % 97 == 0, F.lit(0.0)).otherwise(F.col("p_retailprice")).alias("UnitPrice"),
        F.when(F.col("o_orderkey") % 5 == 0, F.lit(None).cast("long"))
        .otherwise(F.col("o_custkey")).alias("CustomerID"),
        F.col("n_name").alias("Country"),
        # replay position of the line inside the feed; used as broker offset
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("_feed_position"),
    )


def in_share(df: DataFrame, key: str, share: tuple[int, int]) -> DataFrame:
    """The i-th of n disjoint shares of a frame's rows by a hash of ``key`` (nulls are in one of them)."""
    i, n = share
    return df if n == 1 else df.filter(F.pmod(F.xxhash64(key), F.lit(n)) == i)


def load_union(*frames: DataFrame) -> DataFrame:
    """Concatenate source sheets, rename the header positionally, parse the date."""
    out = None
    for f in frames:
        g = f.toDF(*SOURCE_COLUMNS) if len(f.columns) == len(SOURCE_COLUMNS) else f
        out = g if out is None else out.unionByName(g)
    return out.withColumn("InvoiceDate", F.col("InvoiceDate").cast("timestamp_ntz"))


def to_messages(tx: DataFrame, sent_at: F.Column | None = None) -> DataFrame:
    """K4 (value part): source rows -> the 10-field event message columns.

    ``timestamp`` is the send time; by default the invoice time, so a replay
    of history gives repeatable messages.
    """
    inv = F.col("InvoiceNo").cast("string")
    sent = sent_at if sent_at is not None else iso_seconds("InvoiceDate")
    return tx.select(
        sent.alias("timestamp"),
        F.col("CustomerID").cast("long").alias("kullanici_ID"),
        F.when(inv.startswith(CANCEL_PREFIX), F.lit(CANCELLATION)).otherwise(F.lit(PURCHASE)).alias("olay_tipi"),
        inv.alias("ilgili_ID"),
        F.col("StockCode").cast("string").alias("stock_code"),
        F.col("Description").cast("string").alias("description"),
        F.col("Quantity").cast("int").alias("quantity"),
        F.col("UnitPrice").cast("double").alias("unit_price"),
        F.col("Country").cast("string").alias("country"),
        iso_seconds("InvoiceDate").alias("invoice_date"),
        *([F.col("_feed_position")] if "_feed_position" in tx.columns else []),
    )


def bronze_batch(spark: SparkSession, sf_dir: str, topic: str = DEFAULT_TOPIC, share: tuple[int, int] = (0, 1)) -> DataFrame:
    """Bronze rows as the streaming ingest would write them, built in batch.

    Broker metadata is deterministic: partition from the message key (the
    customer, as the producer keys messages), offset from the feed position,
    broker time = invoice time.
    """
    msgs = to_messages(transactions(spark, sf_dir, share))
    key = F.coalesce(F.col("kullanici_ID"), F.lit(0))
    ts = parse_ts("invoice_date")
    return msgs.select(
        F.lit(topic).alias("kafka_topic"),
        F.pmod(key, F.lit(TOPIC_PARTITIONS)).cast("int").alias("kafka_partition"),
        F.col("_feed_position").cast("long").alias("kafka_offset"),
        ts.alias("kafka_timestamp"),
        *[F.col(c) for c in msgs.columns if c != "_feed_position"],
        ts.alias("ingestion_time"),
    )
