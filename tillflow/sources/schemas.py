"""Schemas and names of the retail data model."""

from pyspark.sql import types as T

# --- fixed values: the event message and table layouts of the retail pipeline ---
# Message fields, in order (event time string, customer id, event type,
# invoice number, stock code, description, quantity, unit price, country,
# invoice date string).
MESSAGE_SCHEMA = T.StructType([
    T.StructField("timestamp", T.StringType(), True),
    T.StructField("kullanici_ID", T.LongType(), True),
    T.StructField("olay_tipi", T.StringType(), True),
    T.StructField("ilgili_ID", T.StringType(), True),
    T.StructField("stock_code", T.StringType(), True),
    T.StructField("description", T.StringType(), True),
    T.StructField("quantity", T.IntegerType(), True),
    T.StructField("unit_price", T.DoubleType(), True),
    T.StructField("country", T.StringType(), True),
    T.StructField("invoice_date", T.StringType(), True),
])
MESSAGE_FIELDS = [f.name for f in MESSAGE_SCHEMA.fields]

# Source transaction header (positional rename of the two yearly sheets).
SOURCE_COLUMNS = ["InvoiceNo", "StockCode", "Description", "Quantity",
                  "InvoiceDate", "UnitPrice", "CustomerID", "Country"]

# Event types and the cancellation invoice prefix.
PURCHASE = "purchase"
CANCELLATION = "cancellation"
CANCEL_PREFIX = "C"

# Broker metadata columns carried into Bronze.
KAFKA_COLUMNS = ["kafka_topic", "kafka_partition", "kafka_offset", "kafka_timestamp"]
DEFAULT_TOPIC = "online-retail-transactions"
TOPIC_PARTITIONS = 3

# Silver de-duplication keys.
DEDUP_KEYS = ["ilgili_ID", "stock_code", "kullanici_ID", "invoice_date", "quantity"]

# Customer key of every per-customer table.
CUSTOMER = "kullanici_ID"

# Gold column order.
GOLD_COLUMNS = ["kullanici_ID", "recency_days", "frequency", "monetary",
                "avg_basket_value", "avg_days_between_purchases", "unique_products",
                "cancellation_count", "active_months", "most_active_hour", "country",
                "future_spending"]

# Weekday labels for dayofweek 1..7 (1 = Sunday).
WEEKDAY_NAMES = ["Pazar", "Pazartesi", "Salı", "Çarşamba", "Perşembe", "Cuma", "Cumartesi"]

# Share of the whole-day span used as feature period.
FEATURE_SHARE = 0.75
# --- end of fixed values ---

BRONZE_COLUMNS = KAFKA_COLUMNS + MESSAGE_FIELDS + ["ingestion_time"]

RUN_LOG_SCHEMA = T.StructType([
    T.StructField("experiment", T.StringType(), False),
    T.StructField("run_name", T.StringType(), False),
    T.StructField("model_type", T.StringType(), False),
    T.StructField("started_at", T.TimestampType(), True),
    T.StructField("params", T.MapType(T.StringType(), T.StringType()), True),
    T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType()), True),
])

PUBLISH_LOG_SCHEMA = T.StructType([
    T.StructField("table", T.StringType(), False),
    T.StructField("version", T.LongType(), False),
    T.StructField("timestamp", T.TimestampType(), True),
    T.StructField("operation", T.StringType(), False),
    T.StructField("num_output_rows", T.LongType(), True),
    T.StructField("path", T.StringType(), True),
])
