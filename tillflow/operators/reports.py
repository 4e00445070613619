"""Reports over source, Silver and Gold tables (A*, O*, E10-E17).

All are grouped aggregates; results that are "top N" keep an explicit,
total order (value, then key) so repeated runs agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillflow.functions import literal_row, pct, weekday_name, year_month
from tillflow.operators import silver
from tillflow.operators.profile import exact_quantiles

K = "kullanici_ID"
LETTER = "[A-Za-z]"


# ----------------------------------------------------------------- time
def monthly_trend(purch: DataFrame) -> DataFrame:
    """Rows and sales per calendar month."""
    return purch.groupBy(year_month("invoice_date").alias("year_month")).agg(
        F.count("*").alias("row_count"), F.sum("total_price").alias("sales")).orderBy("year_month")


def hourly_distribution(purch: DataFrame) -> DataFrame:
    """Rows per hour of day."""
    return purch.groupBy(F.hour("invoice_date").alias("hour")).agg(
        F.count("*").alias("row_count")).orderBy("hour")


def peak_hour(purch: DataFrame) -> DataFrame:
    """The busiest hour (ties: the earlier hour)."""
    h = hourly_distribution(purch)
    best = F.max(F.struct(F.col("row_count"), (-F.col("hour")).alias("neg_hour")))
    return h.agg(best.alias("b")).select((-F.col("b.neg_hour")).alias("hour"), F.col("b.row_count").alias("row_count"))


def weekday_distribution(purch: DataFrame) -> DataFrame:
    """Rows per weekday (1 = Sunday) with its label."""
    return purch.groupBy(F.dayofweek("invoice_date").alias("day_of_week")).agg(
        F.count("*").alias("row_count")) \
        .select("day_of_week", weekday_name(F.col("day_of_week")).alias("day_name"), "row_count") \
        .orderBy("day_of_week")


def year_counts(tx: DataFrame) -> DataFrame:
    """Source rows per year (nulls excluded)."""
    return tx.filter(F.col("InvoiceDate").isNotNull()) \
             .groupBy(F.year("InvoiceDate").alias("year")).agg(F.count("*").alias("row_count")).orderBy("year")


def source_monthly(tx: DataFrame) -> DataFrame:
    """nb00 monthly counts on the source rows."""
    return tx.filter(F.col("InvoiceDate").isNotNull()) \
             .groupBy(year_month("InvoiceDate").alias("year_month")).agg(F.count("*").alias("row_count")) \
             .orderBy("year_month")


# ------------------------------------------------------------- customers
def customer_stats(purch: DataFrame) -> DataFrame:
    """Rows, invoices, spend and distinct products per customer."""
    return purch.groupBy(K).agg(
        F.count("*").alias("row_count"), F.count_distinct("ilgili_ID").alias("invoice_count"),
        F.sum("total_price").alias("total_spend"), F.count_distinct("stock_code").alias("unique_products"))


def top_customers(purch: DataFrame, n: int = 10) -> DataFrame:
    """O3: the n customers with highest spend (ties: smaller id)."""
    return customer_stats(purch).orderBy(F.col("total_spend").desc(), F.col(K).asc()).limit(n)


def invoices_by_customer(tx: DataFrame) -> DataFrame:
    """Distinct invoices of every known customer."""
    return tx.dropna(subset=["CustomerID"]).groupBy("CustomerID").agg(F.count_distinct("InvoiceNo").alias("invoices"))


def invoices_per_customer(per: DataFrame) -> DataFrame:
    """Customers, mean, median and max of ``invoices_by_customer`` (read twice: give a written table)."""
    med = literal_row(exact_quantiles(per, "invoices", [0.5], ["median"]))["median"]
    sums = per.agg(F.count("*").alias("customers"), F.avg("invoices").alias("mean"), F.max("invoices").alias("max"))
    return sums.select("customers", "mean", med.alias("median"), "max")


# -------------------------------------------------------------- products
def top_products(purch: DataFrame, n: int = 20) -> DataFrame:
    """(stock code, description) by sales; top n with a 40-char label."""
    g = purch.groupBy("stock_code", "description").agg(
        F.sum("quantity").alias("total_quantity"), F.count("*").alias("row_count"),
        F.sum("total_price").alias("sales"))
    return g.orderBy(F.col("sales").desc(), "stock_code", "description").limit(n) \
            .withColumn("description_short", F.substring("description", 1, 40))


def nonproduct_codes(tx: DataFrame, n: int = 10) -> DataFrame:
    """Stock codes containing a letter; the first n codes with their row counts."""
    return tx.filter(F.col("StockCode").cast("string").rlike(LETTER)) \
             .groupBy(F.col("StockCode").cast("string").alias("stock_code")).agg(F.count("*").alias("row_count")) \
             .orderBy("stock_code").limit(n)


# ------------------------------------------------------------- countries
def country_stats(purch: DataFrame) -> DataFrame:
    """Rows, customers and sales per country."""
    return purch.groupBy("country").agg(
        F.count("*").alias("row_count"), F.count_distinct(K).alias("customer_count"),
        F.sum("total_price").alias("sales")).orderBy(F.col("sales").desc(), "country")


def country_share(tx: DataFrame) -> DataFrame:
    """Source rows per country and percent of all rows (nulls excluded)."""
    g = tx.filter(F.col("Country").isNotNull()).groupBy(F.col("Country").alias("country")) \
          .agg(F.count("*").alias("row_count"))
    # the window has no partition key, but it runs over one row per country
    total = F.sum("row_count").over(Window.partitionBy())
    return g.select("country", "row_count", pct(F.col("row_count"), total).alias("share_pct")) \
            .orderBy(F.col("row_count").desc(), "country")


def country_counts(tx: DataFrame, n: int = 10) -> DataFrame:
    """The n countries with most source rows."""
    return tx.filter(F.col("Country").isNotNull()).groupBy(F.col("Country").alias("country")) \
             .agg(F.count("*").alias("row_count")).orderBy(F.col("row_count").desc(), "country").limit(n)


def country_top_excl_home(purch: DataFrame, home: str, n: int = 10) -> DataFrame:
    """Top n countries by sales, home country left out."""
    return purch.filter(F.col("country") != F.lit(home)).groupBy("country").agg(
        F.count("*").alias("row_count"), F.sum("total_price").alias("sales")) \
        .orderBy(F.col("sales").desc(), "country").limit(n)


def home_vs_others(purch: DataFrame, home: str) -> DataFrame:
    """Home-country rows and sales against all others, with shares (0 when absent)."""
    is_home = F.col("country") == F.lit(home)
    return purch.agg(
        F.count_if(is_home).alias("home_rows"), F.count("*").alias("all_rows"),
        F.coalesce(F.sum(F.when(is_home, F.col("total_price"))), F.lit(0.0)).alias("home_sales"),
        F.coalesce(F.sum(F.when(~is_home | F.col("country").isNull(), F.col("total_price"))), F.lit(0.0))
        .alias("other_sales"),
    ).select(F.lit(home).alias("home_country"), "home_rows",
             pct(F.col("home_rows"), F.col("all_rows")).alias("home_row_pct"),
             "home_sales", "other_sales",
             pct(F.col("home_sales"), F.col("home_sales") + F.col("other_sales")).alias("home_sales_pct"))


# ---------------------------------------------------------- cancellations
def cancellation_summary(clean: DataFrame) -> DataFrame:
    """Counts, rate and absolute cancelled amount (0 when empty), in one aggregate over the cleaned rows."""
    is_c, is_p = F.col("is_cancellation"), silver.is_purchase()
    sums = clean.agg(F.count_if(is_c).alias("cancellations"), F.count_if(is_p).alias("purchases"),
                     F.abs(F.coalesce(F.sum(F.when(is_c, F.col("total_price"))), F.lit(0.0))).alias("cancelled_amount"))
    rate = pct(F.col("cancellations"), F.col("cancellations") + F.col("purchases"))
    return sums.select("cancellations", "purchases", rate.alias("cancellation_rate_pct"), "cancelled_amount")


def cancellations_by_country(canc: DataFrame) -> DataFrame:
    """Cancellation rows per country, most first."""
    return canc.groupBy("country").agg(F.count("*").alias("row_count")) \
               .orderBy(F.col("row_count").desc(), "country")


def prefix_classify(tx: DataFrame) -> DataFrame:
    """Rows by invoice prefix (C = cancellation) with share and quantity range."""
    kind = F.when(F.col("InvoiceNo").cast("string").startswith("C"), F.lit("cancellation")) \
            .otherwise(F.lit("purchase"))
    g = tx.groupBy(kind.alias("kind")).agg(
        F.count("*").alias("row_count"), F.min("Quantity").alias("min_quantity"),
        F.avg("Quantity").alias("mean_quantity"), F.max("Quantity").alias("max_quantity"))
    total = F.sum("row_count").over(Window.partitionBy())
    return g.select("kind", "row_count", pct(F.col("row_count"), total).alias("share_pct"),
                    "min_quantity", "mean_quantity", "max_quantity")


# ------------------------------------------------------------ counts
def basic_stats(purch: DataFrame) -> DataFrame:
    """A4: four distinct counts and the first/last invoice in one row."""
    return purch.agg(
        F.count_distinct(K).alias("customers"), F.count_distinct("stock_code").alias("products"),
        F.count_distinct("ilgili_ID").alias("invoices"), F.count_distinct("country").alias("countries"),
        F.min("invoice_date").alias("first_invoice"), F.max("invoice_date").alias("last_invoice"))


def entity_counts(tx: DataFrame) -> DataFrame:
    """Distinct customers, products, invoices; rows and customers with an id."""
    return tx.agg(
        F.count_distinct("CustomerID").alias("customers"), F.count_distinct("StockCode").alias("products"),
        F.count_distinct("InvoiceNo").alias("invoices"),
        F.count("CustomerID").alias("rows_with_customer"), F.count("*").alias("row_count"))


def anomaly_counts(tx: DataFrame) -> DataFrame:
    """A10: non-positive, zero and negative quantities and prices; codes with letters."""
    q, p = F.col("Quantity"), F.col("UnitPrice")
    return tx.agg(
        F.count_if(q <= 0).alias("quantity_le0"), F.count_if(q == 0).alias("quantity_eq0"),
        F.count_if(q < 0).alias("quantity_lt0"), F.count_if(p <= 0).alias("price_le0"),
        F.count_if(p == 0).alias("price_eq0"), F.count_if(p < 0).alias("price_lt0"),
        F.count_if(F.col("StockCode").cast("string").rlike(LETTER)).alias("codes_with_letters"))


def event_type_counts(bronze: DataFrame) -> DataFrame:
    """A1: rows per event type."""
    return bronze.groupBy("olay_tipi").agg(F.count("*").alias("row_count")).orderBy(F.col("row_count").desc())


def dashboard_kpis(tagged: DataFrame, gold: DataFrame) -> DataFrame:
    """The KPI row, one conditional aggregate over the tagged Silver rows; no table reaches the driver."""
    p, c = (F.col(silver.SILVER_TABLE) == t for t in ("purchases", "cancellations"))
    customers = literal_row(gold.agg(F.count("*").alias("n")))["n"]
    day = lambda f: F.to_date(f(F.when(p, F.col("invoice_date"))))
    sums = tagged.agg(F.count_if(p).alias("purchases"), F.count_if(c).alias("cancellations"),
                      F.count_distinct(F.when(p, F.col("country"))).alias("countries"),
                      day(F.min).alias("first_date"), day(F.max).alias("last_date"))
    return sums.select("purchases", "cancellations", customers.alias("gold_customers"), "countries", "first_date", "last_date")


def step_counts(steps: list[tuple[str, DataFrame]]) -> DataFrame:
    """Row count of each named frame as (step, position, row_count) rows."""
    out = None
    for i, (name, df) in enumerate(steps):
        r = df.agg(F.count("*").alias("row_count")).select(
            F.lit(name).alias("step"), F.lit(i).alias("position"), "row_count")
        out = r if out is None else out.unionByName(r)
    return out


def cleaning_funnel(typed: DataFrame) -> DataFrame:
    """Rows after each Silver step, plus the null-flag rows, from one grouping of the typed rows.

    Rows that fail an early step are grouped under their step alone; the others
    by the de-duplication keys, where the group's size counts the copies and
    the surviving row tells the Silver table.
    """
    step = F.when(F.col(K).isNull(), 0).when(F.col("description").isNull(), 1).otherwise(2)
    staged = typed.withColumn("_step", step)
    keys = [F.when(F.col("_step") == 2, F.col(k)).alias(f"_k{i}") for i, k in enumerate(silver.DEDUP_KEYS)]
    # the survivor's struct lacks the keys; the quantity is one of them and is carried along
    groups = staged.groupBy("_step", *keys).agg(F.count("*").alias("_n"), silver.survivor(typed, silver.DEDUP_KEYS).alias("_row"),
                                                F.min("quantity").alias("_q"))
    last = F.col("_step") == 2
    kind, price = F.col("_row.is_cancellation"), F.col("_row.unit_price")
    counts = {"bronze": F.sum("_n"), "with_customer": F.sum(F.when(F.col("_step") >= 1, F.col("_n"))),
              "with_description": F.sum(F.when(last, F.col("_n"))), "deduplicated": F.count_if(last),
              "purchases": F.count_if(last & ~kind & (F.col("_q") > 0) & (price > 0)),
              "cancellations": F.count_if(last & kind), "null_event_type": F.count_if(last & kind.isNull())}
    row = groups.agg(*[F.coalesce(c, F.lit(0)).alias(n) for n, c in counts.items()])
    steps = [F.struct(F.lit(n).alias("step"), F.lit(i).alias("position"), F.col(n).alias("row_count")) for i, n in enumerate(counts)]
    return row.select(F.inline(F.array(*steps)))
