"""Registered queries: Silver layers, the time split and the Gold features."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillflow.operators import gold, profile, silver
from tillflow.plans.pipeline import Layers, rounded
from tillflow.plans.registry import query
from tillflow.plans.sqlbase import q
from tillflow.sources import store

SILVER_COLS = """kafka_topic, kafka_partition, kafka_offset, kafka_timestamp, "timestamp", kullanici_ID,
       olay_tipi, ilgili_ID, stock_code, description, quantity, unit_price, country, invoice_date,
       ingestion_time, round(total_price, 4) AS total_price, is_cancellation"""


@query("silver_typed", q(f"SELECT {SILVER_COLS} FROM typed", "typed"))
def silver_typed(spark, sf_dir):
    return rounded(Layers(spark, sf_dir).typed())


@query("silver_clean", q(f"SELECT {SILVER_COLS} FROM clean", "clean"))
def silver_clean(spark, sf_dir):
    return rounded(Layers(spark, sf_dir).clean())


@query("silver_purchases", q(f"SELECT {SILVER_COLS} FROM purchases", "purchases"))
def silver_purchases(spark, sf_dir):
    return rounded(Layers(spark, sf_dir).purchases())


@query("silver_cancellations", q(f"SELECT {SILVER_COLS} FROM cancellations", "cancellations"))
def silver_cancellations(spark, sf_dir):
    return rounded(Layers(spark, sf_dir).cancellations())


@query("split_point", q("SELECT min_date, max_date, total_days, split_at FROM split", "split"))
def split_point(spark, sf_dir):
    return gold.split_point(Layers(spark, sf_dir).purchases())


@query("date_range", q("""
SELECT min_date, max_date, total_days, CAST(floor(total_days / 30) AS BIGINT) AS total_months FROM split""", "split"))
def date_range(spark, sf_dir):
    return gold.date_range(Layers(spark, sf_dir).purchases())


_PERIOD_SQL = q("""
SELECT period, count(*) AS row_count, count(DISTINCT kullanici_ID) AS customer_count,
       min(invoice_date) AS first_invoice, max(invoice_date) AS last_invoice,
       round(sum(total_price), 2) AS amount
FROM (SELECT 'feature' AS period, * FROM feat UNION ALL SELECT 'target', * FROM targ
      UNION ALL SELECT 'feature_cancellations', * FROM canc_feat)
GROUP BY period""", "feat", "targ", "canc_feat")


@query("temporal_split", _PERIOD_SQL)
def temporal_split(spark, sf_dir):
    """Rows, customers, bounds and amount of each period of the split."""
    L = Layers(spark, sf_dir)
    split, table, ts = L.split(), F.col("silver_table"), F.col("invoice_date")
    period = (F.when((table == "purchases") & (ts < split), "feature").when((table == "purchases") & (ts >= split), "target")
              .when((table == "cancellations") & (ts < split), "feature_cancellations"))
    tagged = L.written_silver().select("kullanici_ID", "invoice_date", "total_price", period.alias("period")) \
                               .filter(F.col("period").isNotNull())
    return tagged.groupBy("period").agg(
        F.count("*").alias("row_count"), F.count_distinct("kullanici_ID").alias("customer_count"),
        F.min("invoice_date").alias("first_invoice"), F.max("invoice_date").alias("last_invoice"),
        F.round(F.sum("total_price"), 2).alias("amount"))


@query("rfm", q("SELECT kullanici_ID, recency_days, frequency, round(monetary, 4) AS monetary FROM g_rfm", "g_rfm"))
def rfm(spark, sf_dir):
    f, _, _, split = Layers(spark, sf_dir).periods()
    return rounded(gold.rfm(f, split))


@query("avg_basket", q("SELECT kullanici_ID, round(avg_basket_value, 4) AS avg_basket_value FROM g_basket", "g_basket"))
def avg_basket(spark, sf_dir):
    f, _, _, _ = Layers(spark, sf_dir).periods()
    return rounded(gold.avg_basket(f))


@query("purchase_gap", q("""
SELECT kullanici_ID, round(avg_days_between_purchases, 4) AS avg_days_between_purchases FROM g_gap""", "g_gap"))
def purchase_gap(spark, sf_dir):
    f, _, _, _ = Layers(spark, sf_dir).periods()
    return rounded(gold.purchase_gap(f))


@query("unique_products", q("SELECT * FROM g_products", "g_products"))
def unique_products(spark, sf_dir):
    f, _, _, _ = Layers(spark, sf_dir).periods()
    return gold.unique_products(f)


@query("active_months", q("SELECT * FROM g_months", "g_months"))
def active_months(spark, sf_dir):
    f, _, _, _ = Layers(spark, sf_dir).periods()
    return gold.active_months(f)


@query("cancellation_count", q("SELECT * FROM g_canc", "g_canc"))
def cancellation_count(spark, sf_dir):
    _, _, c, _ = Layers(spark, sf_dir).periods()
    return gold.cancellation_count(c)


@query("most_active_hour", q("SELECT * FROM g_hour", "g_hour"))
def most_active_hour(spark, sf_dir):
    f, _, _, _ = Layers(spark, sf_dir).periods()
    return gold.most_active_hour(f)


@query("main_country", q("SELECT * FROM g_country", "g_country"))
def main_country(spark, sf_dir):
    f, _, _, _ = Layers(spark, sf_dir).periods()
    return gold.main_country(f)


@query("future_spending", q("SELECT kullanici_ID, round(future_spending, 4) AS future_spending FROM g_target",
                            "g_target"))
def future_spending(spark, sf_dir):
    _, t, _, _ = Layers(spark, sf_dir).periods()
    return rounded(gold.future_spending(t))


GOLD_SQL = q("""
SELECT kullanici_ID, recency_days, frequency, round(monetary, 4) AS monetary,
       round(avg_basket_value, 4) AS avg_basket_value,
       round(avg_days_between_purchases, 4) AS avg_days_between_purchases, unique_products,
       cancellation_count, active_months, most_active_hour, country, round(future_spending, 4) AS future_spending
FROM gold""", "gold")


@query("gold_features", GOLD_SQL)
def gold_features(spark, sf_dir):
    """C3 flagship: one-pass Gold from the Silver tables, which are evaluated once."""
    L = Layers(spark, sf_dir)
    return rounded(gold.gold_features(L.written_purchases(), L.written_cancellations(), L.split()))


@query("gold_features_joined", GOLD_SQL)
def gold_features_joined(spark, sf_dir):
    """C3 by joins, the form that the jobs and later queries use; must equal ``gold_features``."""
    return rounded(Layers(spark, sf_dir).gold())


_SCHEMA = {"kullanici_ID": "bigint", "ilgili_ID": "string", "stock_code": "string", "invoice_date": "timestamp_ntz",
           "total_price": "double", "country": "string", "silver_table": "string"}


@query("schema_report", q(" UNION ALL ".join(f"""
SELECT 'silver' AS "table", '{c}' AS column_name, '{t}' AS data_type, true AS nullable, count({c}) AS filled
FROM (SELECT *, CASE WHEN is_cancellation THEN 'cancellations' WHEN quantity > 0 AND unit_price > 0 THEN 'purchases' END AS silver_table FROM clean)"""
                                            for c, t in _SCHEMA.items()), "clean"))
def schema_report(spark, sf_dir):
    """Columns, types and filled rows of the written Silver rows (Gold's inputs and the table tag)."""
    written = Layers(spark, sf_dir).written_silver()
    filled = profile.fill_profile(written).select("column_name", "filled")
    # a row per column on both sides
    return store.schema_report(written, "silver").join(filled, "column_name").select("table", "column_name", "data_type", "nullable", "filled")


_REPLAYED = q("""
SELECT ilgili_ID, stock_code, kullanici_ID, invoice_date, quantity, kafka_offset, olay_tipi, is_cancellation
FROM clean""", "clean")


@query("silver_replayed", _REPLAYED)
def silver_replayed(spark, sf_dir):
    """U2 on a feed that replays a slice of itself (FIXTURES §4): the first delivery survives, so the result is Silver's."""
    first = Layers(spark, sf_dir).bronze()
    copies = first.filter(F.pmod(F.floor(F.col("kafka_offset") / 8), F.lit(20)) == 0) \
                  .withColumn("kafka_offset", F.col("kafka_offset") + (1 << 40))
    clean = silver.silver_clean(silver.silver_typed(first.unionByName(copies)))
    return clean.select(*silver.DEDUP_KEYS, "kafka_offset", "olay_tipi", "is_cancellation")
