"""Registered queries: source loading, message encode/decode and the streaming ingest."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from tillflow.plans.pipeline import Layers, rounded
from tillflow.plans.registry import query
from tillflow.plans.sqlbase import q
from tillflow.session import clean_scratch, scratch_path
from tillflow.sources.tables import load_union, to_messages, transactions
from tillflow.streaming import bronze as stream

_TX_COLS = "InvoiceNo, StockCode, Description, Quantity, InvoiceDate, round(UnitPrice, 4) AS UnitPrice, CustomerID, Country"
_BRONZE_COLS = """kafka_topic, kafka_partition, kafka_offset, kafka_timestamp, "timestamp", kullanici_ID, olay_tipi,
       ilgili_ID, stock_code, description, quantity, round(unit_price, 4) AS unit_price, country, invoice_date"""


def _messages(spark, sf_dir):
    """The messages of all source rows, written: the range exchange of ``encode`` reads them twice."""
    return Layers(spark, sf_dir).write(to_messages(transactions(spark, sf_dir)).drop("_feed_position"), "messages")


@query("load_union", q(f"SELECT {_TX_COLS} FROM tx", "tx"))
def load_union_q(spark, sf_dir):
    """Two yearly "sheets" with their own headers, concatenated and renamed."""
    tx = transactions(spark, sf_dir).drop("_feed_position")
    first = tx.filter(F.col("InvoiceDate") < F.lit("1998-01-01").cast("timestamp_ntz"))
    second = tx.filter(~(F.col("InvoiceDate") < F.lit("1998-01-01").cast("timestamp_ntz"))
                       | F.col("InvoiceDate").isNull())
    sheet_a = first.toDF(*[f"a{i}" for i in range(len(tx.columns))])
    sheet_b = second.toDF(*[f"b{i}" for i in range(len(tx.columns))])
    return rounded(load_union(sheet_a, sheet_b))


@query("encode_messages", q("""
SELECT CAST(kullanici_ID AS VARCHAR) AS key,
       CAST(to_json(struct_pack("timestamp" := "timestamp", kullanici_ID := kullanici_ID, olay_tipi := olay_tipi,
               ilgili_ID := ilgili_ID, stock_code := stock_code, description := description, quantity := quantity,
               unit_price := unit_price, country := country, invoice_date := invoice_date)) AS VARCHAR) AS value
FROM msg""", "msg"))
def encode_messages(spark, sf_dir):
    """Keyed JSON records of every source row."""
    return stream.encode(_messages(spark, sf_dir))


@query("publish_offsets", q("""
SELECT 'online-retail-transactions' AS topic, CAST(coalesce(kullanici_ID, 0) % 3 AS INTEGER) AS "partition", key, value,
       row_number() OVER (PARTITION BY coalesce(kullanici_ID, 0) % 3 ORDER BY CAST(invoice_date AS TIMESTAMP), key NULLS FIRST, value) - 1 AS "offset"
FROM (SELECT *, CAST(kullanici_ID AS VARCHAR) AS key,
       CAST(to_json(struct_pack("timestamp" := "timestamp", kullanici_ID := kullanici_ID, olay_tipi := olay_tipi,
               ilgili_ID := ilgili_ID, stock_code := stock_code, description := description, quantity := quantity,
               unit_price := unit_price, country := country, invoice_date := invoice_date)) AS VARCHAR) AS value FROM msg)""", "msg"))
def publish_offsets(spark, sf_dir):
    """The published feed's records with the dense offsets of their topic partitions."""
    return stream.published(stream.encode(_messages(spark, sf_dir), keep_event_time=True)).drop("timestamp")


@query("decode_messages", q(f"SELECT {_BRONZE_COLS}, ingestion_time FROM bronze", "bronze"))
def decode_messages(spark, sf_dir):
    """Broker records (as the feed holds them) decoded back to Bronze rows."""
    records = stream.feed_records(to_messages(transactions(spark, sf_dir)))
    return rounded(stream.decode(records, ingestion_time=F.col("timestamp")))


@query("encode_first", q("""
SELECT CAST(kullanici_ID AS VARCHAR) AS key,
       CAST(to_json(struct_pack("timestamp" := "timestamp", kullanici_ID := kullanici_ID, olay_tipi := olay_tipi,
               ilgili_ID := ilgili_ID, stock_code := stock_code, description := description, quantity := quantity,
               unit_price := unit_price, country := country, invoice_date := invoice_date)) AS VARCHAR) AS value
FROM msg ORDER BY invoice_date, key NULLS FIRST, value LIMIT 500""", "msg"))
def encode_first(spark, sf_dir):
    """Publishing stops after the first 500 messages in event-time order (the message limit is the feature)."""
    return stream.encode(to_messages(transactions(spark, sf_dir)), max_messages=500)


@query("bronze_ingest", q(f"SELECT {_BRONZE_COLS} FROM bronze", "bronze"))
def bronze_ingest(spark, sf_dir):
    """A feed ingested by a checkpointed stream in two increments and a restart without news.

    Each increment is drained in bounded batches. The scratch folders live under
    the shared checkpoint folder of the session.
    """
    root = _ingested(spark, sf_dir)
    return rounded(spark.read.parquet(os.path.join(root, "bronze")).drop("ingestion_time"))


def _ingested(spark, sf_dir, log: bool = False) -> str:
    """Two increments and a restart without news; the root of Bronze, and of the progress log if there is one."""
    root = scratch_path(spark, f"ingest-{uuid.uuid4().hex}")
    feed, out, ckpt, progress = (os.path.join(root, x) for x in ("feed", "bronze", "_checkpoint", "progress"))
    records = stream.feed_records(to_messages(transactions(spark, sf_dir)))
    early = F.col("timestamp") < F.lit("1998-01-01").cast("timestamp_ntz")
    for part in (records.filter(early), records.filter(~early | F.col("timestamp").isNull()), None):
        if part is not None:
            stream.write_feed(part, feed)
        stream.run_ingest(spark, feed, out, ckpt, progress_path=progress if log else None)
    clean_scratch(spark, feed)
    return root


@query("stream_progress", q("""
SELECT 1 AS increment, count(*) FILTER (CAST(invoice_date AS TIMESTAMP) < TIMESTAMP '1998-01-01') AS "rows", 0::BIGINT AS malformed FROM msg
UNION ALL SELECT 2, count(*) FILTER (NOT coalesce(CAST(invoice_date AS TIMESTAMP) < TIMESTAMP '1998-01-01', false)), 0 FROM msg
UNION ALL SELECT 3, 0, 0""", "msg"))
def stream_progress(spark, sf_dir):
    """T5: rows and malformed rows that each run of the ingest observed: two increments and an empty restart."""
    runs = stream.run_frame(spark, os.path.join(_ingested(spark, sf_dir, log=True), "progress"))
    increment = F.row_number().over(Window.partitionBy().orderBy("started_at"))  # a row per run
    return runs.select(increment.alias("increment"), "rows", "malformed")


PREVIEW_ROWS = 50


@query("stream_preview", q(f"SELECT {_BRONZE_COLS} FROM bronze ORDER BY kafka_timestamp, kafka_partition, kafka_offset LIMIT {PREVIEW_ROWS}", "bronze"))
def stream_preview(spark, sf_dir):
    """The first rows of a feed that arrives in two increments, the later one first (the row limit is the feature)."""
    root = scratch_path(spark, f"preview-{uuid.uuid4().hex}")
    feed, out, ckpt = (os.path.join(root, x) for x in ("feed", "preview", "_checkpoint"))
    records = stream.feed_records(to_messages(transactions(spark, sf_dir)))
    early = F.col("timestamp") < F.lit("1998-01-01").cast("timestamp_ntz")
    for part in (records.filter(~early), records.filter(early)):
        stream.write_feed(part, feed)
        stream.preview(stream.read_stream(spark, "files", feed), out, ckpt, PREVIEW_ROWS).awaitTermination()
    clean_scratch(spark, feed)
    return rounded(stream.read_preview(spark, out).drop("ingestion_time"))
