"""Registered queries: profiles and reports (nb00, nb01, nb04, nb05, dashboard)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tillflow.operators import profile, reports, silver
from tillflow.plans.pipeline import Layers, rounded
from tillflow.plans.registry import query
from tillflow.plans.sqlbase import q, register
from tillflow.session import scratch_path
from tillflow.sources import store
from tillflow.sources.tables import transactions
from tillflow.sources.schemas import BRONZE_COLUMNS, CUSTOMER, GOLD_COLUMNS, SOURCE_COLUMNS, WEEKDAY_NAMES

# Home country of the fixture (largest country at sf0.01); a parameter of the reports.
HOME = "NATION_7"
PURCHASE_NUMERIC = ["quantity", "unit_price", "total_price"]
SOURCE_NUMERIC = ["Quantity", "UnitPrice", "CustomerID"]
GOLD_NUMERIC = [c for c in GOLD_COLUMNS if c not in (CUSTOMER, "country")]
SILVER_COLUMNS = BRONZE_COLUMNS + ["total_price", "is_cancellation"]

register("tx_gaps", "SELECT * REPLACE (CASE WHEN feed_position % 7 = 0 THEN NULL ELSE Quantity END AS Quantity) FROM tx", ("tx",))
register("cstats", """
SELECT kullanici_ID, count(*) AS row_count, count(DISTINCT ilgili_ID) AS invoice_count,
       sum(total_price) AS total_spend, count(DISTINCT stock_code) AS unique_products
FROM purchases GROUP BY kullanici_ID""", ("purchases",))


def _qi(c: str) -> str:
    return f'"{c}"'


# ------------------------------------------------------------------ time
@query("monthly_trend", q("""
SELECT strftime(invoice_date, '%Y-%m') AS year_month, count(*) AS row_count, round(sum(total_price), 4) AS sales
FROM purchases GROUP BY 1""", "purchases"))
def monthly_trend(spark, sf_dir):
    return rounded(reports.monthly_trend(Layers(spark, sf_dir).purchases()))


@query("hourly_distribution", q("""
SELECT CAST(hour(invoice_date) AS INTEGER) AS hour, count(*) AS row_count FROM purchases GROUP BY 1""", "purchases"))
def hourly_distribution(spark, sf_dir):
    return reports.hourly_distribution(Layers(spark, sf_dir).purchases())


@query("peak_hour", q("""
SELECT CAST(hour(invoice_date) AS INTEGER) AS hour, count(*) AS row_count FROM purchases GROUP BY 1
ORDER BY row_count DESC, hour ASC LIMIT 1""", "purchases"))
def peak_hour(spark, sf_dir):
    return reports.peak_hour(Layers(spark, sf_dir).purchases())


_DAYS = ", ".join(f"'{d}'" for d in WEEKDAY_NAMES)


@query("weekday_distribution", q(f"""
SELECT CAST(dayofweek(invoice_date) + 1 AS INTEGER) AS day_of_week,
       ([{_DAYS}])[dayofweek(invoice_date) + 1] AS day_name, count(*) AS row_count
FROM purchases GROUP BY 1, 2""", "purchases"))
def weekday_distribution(spark, sf_dir):
    return reports.weekday_distribution(Layers(spark, sf_dir).purchases())


@query("year_counts", q("""
SELECT CAST(year(InvoiceDate) AS INTEGER) AS year, count(*) AS row_count FROM tx
WHERE InvoiceDate IS NOT NULL GROUP BY 1""", "tx"))
def year_counts(spark, sf_dir):
    return reports.year_counts(Layers(spark, sf_dir).transactions())


@query("source_monthly", q("""
SELECT strftime(InvoiceDate, '%Y-%m') AS year_month, count(*) AS row_count FROM tx
WHERE InvoiceDate IS NOT NULL GROUP BY 1""", "tx"))
def source_monthly(spark, sf_dir):
    return reports.source_monthly(Layers(spark, sf_dir).transactions())


# ------------------------------------------------------------- customers
@query("customer_stats", q("""
SELECT kullanici_ID, row_count, invoice_count, round(total_spend, 4) AS total_spend, unique_products FROM cstats""",
                           "cstats"))
def customer_stats(spark, sf_dir):
    return rounded(reports.customer_stats(Layers(spark, sf_dir).purchases()))


@query("top_customers", q("""
SELECT kullanici_ID, row_count, invoice_count, round(total_spend, 4) AS total_spend, unique_products FROM cstats
ORDER BY total_spend DESC, kullanici_ID LIMIT 10""", "cstats"))
def top_customers(spark, sf_dir):
    return rounded(reports.top_customers(Layers(spark, sf_dir).purchases()))


@query("invoices_per_customer", q("""
SELECT count(*) AS customers, round(avg(invoices), 4) AS mean, round(quantile_cont(invoices, 0.5), 4) AS median,
       max(invoices) AS max
FROM (SELECT CustomerID, count(DISTINCT InvoiceNo) AS invoices FROM tx WHERE CustomerID IS NOT NULL GROUP BY 1)""",
                                  "tx"))
def invoices_per_customer(spark, sf_dir):
    L = Layers(spark, sf_dir)
    per = L.write(reports.invoices_by_customer(L.transactions()), "invoices")
    return rounded(reports.invoices_per_customer(per))


# -------------------------------------------------------------- products
@query("top_products", q("""
SELECT stock_code, description, CAST(sum(quantity) AS BIGINT) AS total_quantity, count(*) AS row_count,
       round(sum(total_price), 4) AS sales, substr(description, 1, 40) AS description_short
FROM purchases GROUP BY stock_code, description
ORDER BY sum(total_price) DESC, stock_code, description LIMIT 20""", "purchases"))
def top_products(spark, sf_dir):
    return rounded(reports.top_products(Layers(spark, sf_dir).purchases()))


@query("nonproduct_codes", q("""
SELECT StockCode AS stock_code, count(*) AS row_count FROM tx WHERE regexp_matches(StockCode, '[A-Za-z]')
GROUP BY 1 ORDER BY 1 LIMIT 10""", "tx"))
def nonproduct_codes(spark, sf_dir):
    return reports.nonproduct_codes(Layers(spark, sf_dir).transactions())


# ------------------------------------------------------------- countries
@query("country_stats", q("""
SELECT country, count(*) AS row_count, count(DISTINCT kullanici_ID) AS customer_count,
       round(sum(total_price), 4) AS sales FROM purchases GROUP BY country""", "purchases"))
def country_stats(spark, sf_dir):
    return rounded(reports.country_stats(Layers(spark, sf_dir).purchases()))


@query("country_share", q("""
SELECT Country AS country, count(*) AS row_count,
       round(count(*) * 100.0 / sum(count(*)) OVER (), 4) AS share_pct
FROM tx WHERE Country IS NOT NULL GROUP BY Country""", "tx"))
def country_share(spark, sf_dir):
    return rounded(reports.country_share(Layers(spark, sf_dir).transactions()))


@query("country_counts", q("""
SELECT Country AS country, count(*) AS row_count FROM tx WHERE Country IS NOT NULL GROUP BY Country
ORDER BY row_count DESC, country LIMIT 10""", "tx"))
def country_counts(spark, sf_dir):
    return reports.country_counts(Layers(spark, sf_dir).transactions())


@query("country_top_excl_home", q(f"""
SELECT country, count(*) AS row_count, round(sum(total_price), 4) AS sales FROM purchases
WHERE country <> '{HOME}' GROUP BY country ORDER BY sum(total_price) DESC, country LIMIT 10""", "purchases"))
def country_top_excl_home(spark, sf_dir):
    return rounded(reports.country_top_excl_home(Layers(spark, sf_dir).purchases(), HOME))


@query("home_vs_others", q(f"""
SELECT '{HOME}' AS home_country, home_rows, round(coalesce(home_rows * 100.0 / nullif(all_rows, 0), 0.0), 4) AS home_row_pct,
       round(home_sales, 4) AS home_sales, round(other_sales, 4) AS other_sales,
       round(coalesce(home_sales * 100.0 / nullif(home_sales + other_sales, 0), 0.0), 4) AS home_sales_pct
FROM (SELECT count(*) FILTER (WHERE country = '{HOME}') AS home_rows, count(*) AS all_rows,
             coalesce(sum(total_price) FILTER (WHERE country = '{HOME}'), 0.0) AS home_sales,
             coalesce(sum(total_price) FILTER (WHERE country <> '{HOME}' OR country IS NULL), 0.0) AS other_sales
      FROM purchases)""", "purchases"))
def home_vs_others(spark, sf_dir):
    return rounded(reports.home_vs_others(Layers(spark, sf_dir).purchases(), HOME))


# ---------------------------------------------------------- cancellations
@query("cancellation_summary", q("""
SELECT count(*) AS cancellations, (SELECT count(*) FROM purchases) AS purchases,
       round(coalesce(count(*) * 100.0 / nullif(count(*) + (SELECT count(*) FROM purchases), 0), 0.0), 4)
         AS cancellation_rate_pct,
       round(abs(coalesce(sum(total_price), 0.0)), 4) AS cancelled_amount
FROM cancellations""", "purchases", "cancellations"))
def cancellation_summary(spark, sf_dir):
    return rounded(reports.cancellation_summary(Layers(spark, sf_dir).clean()))


@query("cancellations_by_country", q("""
SELECT country, count(*) AS row_count FROM cancellations GROUP BY country""", "cancellations"))
def cancellations_by_country(spark, sf_dir):
    return reports.cancellations_by_country(Layers(spark, sf_dir).cancellations())


@query("prefix_classify", q("""
SELECT CASE WHEN starts_with(InvoiceNo, 'C') THEN 'cancellation' ELSE 'purchase' END AS kind,
       count(*) AS row_count, round(count(*) * 100.0 / sum(count(*)) OVER (), 4) AS share_pct,
       min(Quantity) AS min_quantity, round(avg(Quantity), 4) AS mean_quantity, max(Quantity) AS max_quantity
FROM tx GROUP BY 1""", "tx"))
def prefix_classify(spark, sf_dir):
    return rounded(reports.prefix_classify(Layers(spark, sf_dir).transactions()))


# ------------------------------------------------------------- counts
@query("basic_stats", q("""
SELECT count(DISTINCT kullanici_ID) AS customers, count(DISTINCT stock_code) AS products,
       count(DISTINCT ilgili_ID) AS invoices, count(DISTINCT country) AS countries,
       min(invoice_date) AS first_invoice, max(invoice_date) AS last_invoice FROM purchases""", "purchases"))
def basic_stats(spark, sf_dir):
    return reports.basic_stats(Layers(spark, sf_dir).purchases())


@query("entity_counts", q("""
SELECT count(DISTINCT CustomerID) AS customers, count(DISTINCT StockCode) AS products,
       count(DISTINCT InvoiceNo) AS invoices, count(CustomerID) AS rows_with_customer, count(*) AS row_count
FROM tx""", "tx"))
def entity_counts(spark, sf_dir):
    return reports.entity_counts(Layers(spark, sf_dir).transactions())


@query("anomaly_counts", q("""
SELECT count(*) FILTER (WHERE Quantity <= 0) AS quantity_le0, count(*) FILTER (WHERE Quantity = 0) AS quantity_eq0,
       count(*) FILTER (WHERE Quantity < 0) AS quantity_lt0, count(*) FILTER (WHERE UnitPrice <= 0) AS price_le0,
       count(*) FILTER (WHERE UnitPrice = 0) AS price_eq0, count(*) FILTER (WHERE UnitPrice < 0) AS price_lt0,
       count(*) FILTER (WHERE regexp_matches(StockCode, '[A-Za-z]')) AS codes_with_letters
FROM tx""", "tx"))
def anomaly_counts(spark, sf_dir):
    return reports.anomaly_counts(Layers(spark, sf_dir).transactions())


@query("event_type_counts", q("SELECT olay_tipi, count(*) AS row_count FROM bronze GROUP BY 1", "bronze"))
def event_type_counts(spark, sf_dir):
    return reports.event_type_counts(Layers(spark, sf_dir).bronze())


@query("dashboard_kpis", q("""
SELECT count(*) AS purchases, (SELECT count(*) FROM cancellations) AS cancellations,
       (SELECT count(*) FROM gold) AS gold_customers, count(DISTINCT country) AS countries,
       CAST(min(invoice_date) AS DATE) AS first_date, CAST(max(invoice_date) AS DATE) AS last_date
FROM purchases""", "purchases", "cancellations", "gold"))
def dashboard_kpis(spark, sf_dir):
    L = Layers(spark, sf_dir)
    return reports.dashboard_kpis(L.written_silver(), L.gold())


@query("cleaning_funnel", q("""
SELECT 'bronze' AS step, 0 AS position, count(*) AS row_count FROM typed
UNION ALL SELECT 'with_customer', 1, count(*) FROM typed WHERE kullanici_ID IS NOT NULL
UNION ALL SELECT 'with_description', 2, count(*) FROM typed WHERE kullanici_ID IS NOT NULL AND description IS NOT NULL
UNION ALL SELECT 'deduplicated', 3, count(*) FROM clean
UNION ALL SELECT 'purchases', 4, count(*) FROM purchases
UNION ALL SELECT 'cancellations', 5, count(*) FROM cancellations
UNION ALL SELECT 'null_event_type', 6, count(*) FROM clean WHERE is_cancellation IS NULL""",
                            "typed", "clean", "purchases", "cancellations"))
def cleaning_funnel(spark, sf_dir):
    return reports.cleaning_funnel(Layers(spark, sf_dir).typed())


register("typed_gaps", """
SELECT * REPLACE (CASE WHEN kafka_offset // 8 % 31 = 0 THEN NULL ELSE olay_tipi END AS olay_tipi,
                  CASE WHEN kafka_offset // 8 % 31 = 0 THEN NULL ELSE is_cancellation END AS is_cancellation) FROM typed""", ("typed",))
register("typed_twice", """
SELECT * FROM typed_gaps UNION ALL SELECT * FROM typed_gaps WHERE kafka_offset // 8 % 20 = 0""", ("typed_gaps",))
register("clean_gaps", """
SELECT DISTINCT ON (ilgili_ID, stock_code, kullanici_ID, invoice_date, quantity) * FROM typed_twice
WHERE kullanici_ID IS NOT NULL AND description IS NOT NULL
ORDER BY ilgili_ID, stock_code, kullanici_ID, invoice_date, quantity, kafka_timestamp, kafka_partition, kafka_offset""", ("typed_twice",))


@query("cleaning_funnel_replayed", q("""
SELECT 'bronze' AS step, 0 AS position, count(*) AS row_count FROM typed_twice
UNION ALL SELECT 'with_customer', 1, count(*) FROM typed_twice WHERE kullanici_ID IS NOT NULL
UNION ALL SELECT 'with_description', 2, count(*) FROM typed_twice WHERE kullanici_ID IS NOT NULL AND description IS NOT NULL
UNION ALL SELECT 'deduplicated', 3, count(*) FROM clean_gaps
UNION ALL SELECT 'purchases', 4, count(*) FROM clean_gaps WHERE NOT is_cancellation AND quantity > 0 AND unit_price > 0
UNION ALL SELECT 'cancellations', 5, count(*) FROM clean_gaps WHERE is_cancellation
UNION ALL SELECT 'null_event_type', 6, count(*) FROM clean_gaps WHERE is_cancellation IS NULL""", "clean_gaps"))
def cleaning_funnel_replayed(spark, sf_dir):
    """E17 over a feed with replayed orders (a twentieth) and orders without an event type (one in 31)."""
    order = F.floor(F.col("kafka_offset") / 8)
    gaps = Layers(spark, sf_dir).bronze().withColumn("olay_tipi", F.when(order % 31 != 0, F.col("olay_tipi")))
    return reports.cleaning_funnel(silver.silver_typed(gaps.unionByName(gaps.filter(order % 20 == 0))))


@query("layer_counts", q("""
SELECT 'bronze' AS layer, count(*) AS row_count FROM bronze
UNION ALL SELECT 'silver_purchases', count(*) FROM purchases
UNION ALL SELECT 'silver_cancellations', count(*) FROM cancellations
UNION ALL SELECT 'gold', count(*) FROM gold""", "bronze", "purchases", "cancellations", "gold"))
def layer_counts(spark, sf_dir):
    """The layers written by the jobs, and the row count of every one of them."""
    from tillflow.plans import jobs
    lake = scratch_path(spark, f"lake-{uuid.uuid4().hex}")
    jobs.run_all(spark, sf_dir, lake)
    names = F.create_map(*[F.lit(x) for kv in jobs.LAYERS.items() for x in kv])
    counts = store.layer_counts(spark, lake, list(jobs.LAYERS))
    return counts.select(names[F.col("layer")].alias("layer"), "row_count")


# ------------------------------------------------------------- profiles
def _union(parts: list[str]) -> str:
    return "\nUNION ALL ".join(parts)


@query("describe_numeric", q(_union([f"""
SELECT '{c}' AS column_name, count({c}) AS count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS stddev,
       round(CAST(min({c}) AS DOUBLE), 4) AS min, round(CAST(max({c}) AS DOUBLE), 4) AS max FROM purchases"""
                                     for c in PURCHASE_NUMERIC]), "purchases"))
def describe_numeric(spark, sf_dir):
    return rounded(profile.describe_numeric(Layers(spark, sf_dir).purchases(), PURCHASE_NUMERIC))


@query("describe_quartiles", q(_union([f"""
SELECT '{c}' AS column_name, count({c}) AS count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std,
       round(CAST(min({c}) AS DOUBLE), 4) AS min, round(CAST(max({c}) AS DOUBLE), 4) AS max,
       round(quantile_cont({c}, 0.25), 4) AS p25, round(quantile_cont({c}, 0.5), 4) AS p50,
       round(quantile_cont({c}, 0.75), 4) AS p75 FROM tx""" for c in SOURCE_NUMERIC]), "tx"))
def describe_quartiles(spark, sf_dir):
    """E2 of the source columns, written once: moments and quartiles refer to them five times."""
    L = Layers(spark, sf_dir)
    return rounded(profile.describe_quartiles(L.write(L.transactions().select(*SOURCE_NUMERIC), "source-numbers"), SOURCE_NUMERIC))


@query("null_profile", q("SELECT " + ", ".join(
    f"count(*) FILTER (WHERE {_qi(c)} IS NULL) AS {_qi(c)}" for c in BRONZE_COLUMNS) + " FROM bronze", "bronze"))
def null_profile(spark, sf_dir):
    return profile.null_profile(Layers(spark, sf_dir).bronze())


@query("missing_report", q("SELECT column_name, null_count, round(null_count * 100.0 / n, 2) AS null_pct FROM (" + _union([
    f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_count, count(*) AS n FROM tx"
    for c in SOURCE_COLUMNS]) + ") WHERE null_count > 0", "tx"))
def missing_report(spark, sf_dir):
    return profile.missing_report(Layers(spark, sf_dir).transactions())


@query("fill_profile", q(_union([
    f"""SELECT '{c}' AS column_name, count({_qi(c)}) AS filled, count(*) - count({_qi(c)}) AS null_count,
       round(coalesce(count({_qi(c)}) * 100.0 / nullif(count(*), 0), 0.0), 4) AS fill_pct FROM purchases"""
    for c in SILVER_COLUMNS]), "purchases"))
def fill_profile(spark, sf_dir):
    return rounded(profile.fill_profile(Layers(spark, sf_dir).purchases()))


@query("spend_summary", q("""
SELECT count(total_spend) AS count, round(quantile_cont(total_spend, 0.5), 4) AS median,
       round(avg(total_spend), 4) AS mean, round(stddev_samp(total_spend), 4) AS std,
       round(max(total_spend), 4) AS max FROM cstats""", "cstats"))
def spend_summary(spark, sf_dir):
    stats = Layers(spark, sf_dir).customer_stats()
    return rounded(profile.spend_summary(stats, "total_spend"))


@query("target_skew", q("""
SELECT count(future_spending) AS n, round(avg(future_spending), 4) AS mean,
       round(skewness(future_spending), 4) AS skewness FROM gold""", "gold"))
def target_skew(spark, sf_dir):
    return rounded(profile.skew_summary(Layers(spark, sf_dir).gold(), "future_spending"))


def _hist_sql(source: str, spec: dict[str, int], exprs: dict[str, str] | None = None) -> str:
    exprs = exprs or {}
    parts = []
    for c, k in spec.items():
        x = exprs.get(c, c)
        parts.append(f"""
SELECT '{c}' AS feature, CAST(t.i AS INTEGER) AS bin, round(r.lo + t.i * (r.hi - r.lo) / {k}, 4) AS bin_start,
       round(r.lo + (t.i + 1) * (r.hi - r.lo) / {k}, 4) AS bin_end, coalesce(b.c, 0) AS count
FROM range({k}) t(i)
CROSS JOIN (SELECT CASE WHEN min(x) = max(x) THEN min(x) - 0.5 ELSE min(x) END AS lo,
                   CASE WHEN min(x) = max(x) THEN max(x) + 0.5 ELSE max(x) END AS hi
            FROM (SELECT CAST({x} AS DOUBLE) AS x FROM {source}) WHERE x IS NOT NULL) r
LEFT JOIN (SELECT least(CAST(floor((v.x - r2.lo) * {k} / (r2.hi - r2.lo)) AS INTEGER), {k - 1}) AS bin, count(*) AS c
           FROM (SELECT CAST({x} AS DOUBLE) AS x FROM {source}) v,
                (SELECT CASE WHEN min(x) = max(x) THEN min(x) - 0.5 ELSE min(x) END AS lo,
                        CASE WHEN min(x) = max(x) THEN max(x) + 0.5 ELSE max(x) END AS hi
                 FROM (SELECT CAST({x} AS DOUBLE) AS x FROM {source})) r2
           WHERE v.x IS NOT NULL GROUP BY 1) b ON b.bin = t.i
WHERE r.lo IS NOT NULL""")
    return _union(parts)


SPEND_BINS = {"total_spend": 50}
RFM_BINS = {"recency_days": 50, "frequency": 30, "monetary": 50}
TARGET_BINS = {"future_spending": 50, "log1p_future_spending": 50}


@query("spend_histogram", q(_hist_sql("cstats", SPEND_BINS), "cstats"))
def spend_histogram(spark, sf_dir):
    stats = Layers(spark, sf_dir).customer_stats()
    return rounded(profile.histograms(stats, SPEND_BINS))


@query("rfm_histograms", q(_hist_sql("gold", RFM_BINS), "gold"))
def rfm_histograms(spark, sf_dir):
    return rounded(profile.histograms(Layers(spark, sf_dir).gold_materialized(), RFM_BINS))


@query("target_log_histogram", q(_hist_sql("gold", TARGET_BINS,
                                           {"log1p_future_spending": "ln(1 + future_spending)"}), "gold"))
def target_log_histogram(spark, sf_dir):
    g = Layers(spark, sf_dir).gold_materialized().withColumn("log1p_future_spending", F.log1p("future_spending"))
    return rounded(profile.histograms(g, TARGET_BINS))


@query("spend_boxplot", q("""
SELECT round(q1, 4) AS q1, round(median, 4) AS median, round(q3, 4) AS q3, round(q3 - q1, 4) AS iqr,
       round(q1 - 1.5 * (q3 - q1), 4) AS lower_fence, round(q3 + 1.5 * (q3 - q1), 4) AS upper_fence,
       round((SELECT min(total_spend) FROM cstats WHERE total_spend >= q1 - 1.5 * (q3 - q1)), 4) AS whisker_low,
       round((SELECT max(total_spend) FROM cstats WHERE total_spend <= q3 + 1.5 * (q3 - q1)), 4) AS whisker_high,
       (SELECT count(*) FROM cstats WHERE total_spend < q1 - 1.5 * (q3 - q1) OR total_spend > q3 + 1.5 * (q3 - q1))
         AS outliers
FROM (SELECT quantile_cont(total_spend, 0.25) AS q1, quantile_cont(total_spend, 0.5) AS median,
             quantile_cont(total_spend, 0.75) AS q3 FROM cstats)""", "cstats"))
def spend_boxplot(spark, sf_dir):
    stats = Layers(spark, sf_dir).customer_stats()
    return rounded(profile.boxplot_stats(stats, "total_spend"))


def _corr_sql(columns: list[str], source: str) -> str:
    """Pairwise-complete correlations: DuckDB's corr uses the rows where both columns are present."""
    pairs = [(a, b) for a in columns for b in columns]
    varies = lambda x, y: f"stddev_samp({x}) FILTER (WHERE {y} IS NOT NULL) > 0"
    exprs = [f"round(CASE WHEN {varies(a, b)} AND {varies(b, a)} THEN corr({a}, {b}) END, 6)" for a, b in pairs]
    return (f"SELECT unnest([{', '.join(repr(a) for a, _ in pairs)}]) AS feature_a, "
            f"unnest([{', '.join(repr(b) for _, b in pairs)}]) AS feature_b, unnest([{', '.join(exprs)}]) AS corr FROM {source}")


@query("feature_correlation", q(_corr_sql(GOLD_NUMERIC, "gold"), "gold"))
def feature_correlation(spark, sf_dir):
    return rounded(profile.correlation_matrix(Layers(spark, sf_dir).gold(), GOLD_NUMERIC), 6)


@query("source_correlation", q(_corr_sql(SOURCE_NUMERIC, "tx_gaps"), "tx_gaps"))
def source_correlation(spark, sf_dir):
    """E9 over source columns with nulls (the customers' own, and every seventh quantity taken out)."""
    tx = transactions(spark, sf_dir)
    gaps = tx.withColumn("Quantity", F.when(F.col("_feed_position") % 7 != 0, F.col("Quantity")))
    return rounded(profile.correlation_matrix(gaps, SOURCE_NUMERIC), 6)


@query("target_correlation", q("SELECT feature_a AS feature, corr FROM (" + _corr_sql(GOLD_NUMERIC, "gold")
                               + ") WHERE feature_b = 'future_spending' AND feature_a <> 'future_spending'", "gold"))
def target_correlation(spark, sf_dir):
    """Every feature's correlation with the target, strongest first."""
    return rounded(profile.target_correlation(Layers(spark, sf_dir).gold(), GOLD_NUMERIC, "future_spending"), 6)


def _describe_sql(source: str, cols: list[str]) -> str:
    return _union([f"""
SELECT '{c}' AS column_name, count({c}) AS count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std,
       round(CAST(min({c}) AS DOUBLE), 4) AS min, round(CAST(max({c}) AS DOUBLE), 4) AS max,
       round(quantile_cont({c}, 0.25), 4) AS p25, round(quantile_cont({c}, 0.5), 4) AS p50,
       round(quantile_cont({c}, 0.75), 4) AS p75 FROM {source}""" for c in cols])


CUSTOMER_STAT_COLS = ["row_count", "invoice_count", "total_spend", "unique_products"]


@query("describe_gold", q(_describe_sql("gold", GOLD_NUMERIC), "gold"))
def describe_gold(spark, sf_dir):
    """E1/E2 on the Gold features (count, mean, std, min, quartiles, max per column)."""
    return rounded(profile.describe_quartiles(Layers(spark, sf_dir).gold_materialized(), GOLD_NUMERIC))


@query("describe_customer_stats", q(_describe_sql("cstats", CUSTOMER_STAT_COLS), "cstats"))
def describe_customer_stats(spark, sf_dir):
    """E2 on the per-customer profile (rows, invoices, spend, products)."""
    stats = Layers(spark, sf_dir).customer_stats()
    return rounded(profile.describe_quartiles(stats, CUSTOMER_STAT_COLS))
