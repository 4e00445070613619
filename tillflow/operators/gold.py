"""Gold: leakage-free per-customer features and the future-spending target.

Two plan shapes give the same table:

* ``gold_features`` is one ``groupBy(customer)`` over the tagged
  feature / target / cancellation rows with conditional aggregates.
* ``gold_features_joined`` (what jobs and later queries use: fewer rows are
  expanded for its distinct counts) aggregates the feature rows once per customer, left
  joins the cancellation counts and inner joins the target: two joins of
  customer-level sides.

Both read the Silver tables; give them written ones (``jobs``,
``Layers.written_*``), since the split instant is computed from them first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillflow.functions import literal_row, safe_ratio, split_instant, whole_days_between, year_month
from tillflow.sources.schemas import CUSTOMER, FEATURE_SHARE, GOLD_COLUMNS

K = CUSTOMER


# ---------------------------------------------------------------- time split
def date_range(purchases: DataFrame) -> DataFrame:
    """First and last invoice, whole days and whole 30-day months between."""
    r = purchases.agg(F.min("invoice_date").alias("min_date"), F.max("invoice_date").alias("max_date"))
    days = whole_days_between("min_date", "max_date")
    return r.select("min_date", "max_date", days.alias("total_days"),
                    F.floor(days / 30).cast("long").alias("total_months"))


def split_point(purchases: DataFrame, share: float = FEATURE_SHARE) -> DataFrame:
    """one row with the split instant (min + floor(days * share) days, to the second)."""
    r = purchases.agg(F.min("invoice_date").alias("min_date"), F.max("invoice_date").alias("max_date"))
    return r.select("min_date", "max_date",
                    whole_days_between("min_date", "max_date").alias("total_days"),
                    split_instant("min_date", "max_date", share).alias("split_at"))


def split_column(purchases: DataFrame, share: float = FEATURE_SHARE) -> Column:
    """The split instant as a literal (one aggregate row collected).

    A literal bound is pushed into a Parquet scan of a written Silver table
    (``PushedFilters``) and is evaluated once, wherever the plan uses it.
    """
    return literal_row(split_point(purchases, share).select("split_at"))["split_at"]


def temporal_split(purchases: DataFrame, cancellations: DataFrame, split: Column):
    """Feature rows ``< split``, target rows ``>= split``, cancellations ``< split``."""
    ts = F.col("invoice_date")
    return (purchases.filter(ts < split), purchases.filter(ts >= split), cancellations.filter(ts < split))


# ---------------------------------------------------------- single features
def rfm(feat: DataFrame, split: Column) -> DataFrame:
    """Recency (days from last purchase to the split), frequency, monetary."""
    return feat.groupBy(K).agg(
        F.datediff(split, F.max("invoice_date")).alias("recency_days"),
        F.count_distinct("ilgili_ID").alias("frequency"),
        F.sum("total_price").alias("monetary"))


def avg_basket(feat: DataFrame) -> DataFrame:
    """Per-invoice totals, then their sum / distinct invoices.

    A null invoice counts in the numerator only; with no invoice at all the
    value is null instead of a division error.
    """
    baskets = feat.groupBy(K, "ilgili_ID").agg(F.sum("total_price").alias("basket_total"))
    return baskets.groupBy(K).agg(
        safe_ratio(F.sum("basket_total"), F.count_distinct("ilgili_ID")).alias("avg_basket_value"))


def _gap(first: Column, last: Column, n: Column) -> Column:
    return F.when(n > 1, F.datediff(last, first) / (n - 1)).otherwise(F.lit(0.0))


def purchase_gap(feat: DataFrame) -> DataFrame:
    """Days between first and last purchase / (invoices - 1); 0.0 for one invoice."""
    g = feat.groupBy(K).agg(F.min("invoice_date").alias("first_purchase"),
                            F.max("invoice_date").alias("last_purchase"),
                            F.count_distinct("ilgili_ID").alias("invoice_count"))
    return g.select(K, _gap(F.col("first_purchase"), F.col("last_purchase"),
                            F.col("invoice_count")).alias("avg_days_between_purchases"))


def unique_products(feat: DataFrame) -> DataFrame:
    return feat.groupBy(K).agg(F.count_distinct("stock_code").alias("unique_products"))


def cancellation_count(canc_feat: DataFrame) -> DataFrame:
    return canc_feat.groupBy(K).agg(F.count_distinct("ilgili_ID").alias("cancellation_count"))


def active_months(feat: DataFrame) -> DataFrame:
    return feat.groupBy(K).agg(F.count_distinct(year_month("invoice_date")).alias("active_months"))


def _top1(counts: DataFrame, value: str, out: str) -> DataFrame:
    """Top-1 value per customer by row count; ties go to the smaller value.

    The input is already one row per (customer, value), so a window partition
    holds at most the number of distinct values of one customer (24 hours,
    a handful of countries); Spark plans it with a partial ``WindowGroupLimit``.
    """
    w = Window.partitionBy(K).orderBy(F.col("_n").desc(), F.col(value).asc())
    return counts.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") == 1) \
                 .select(K, F.col(value).alias(out))


def most_active_hour(feat: DataFrame) -> DataFrame:
    """Busiest hour of day per customer."""
    c = feat.withColumn("hour", F.hour("invoice_date")).groupBy(K, "hour").agg(F.count("*").alias("_n"))
    return _top1(c, "hour", "most_active_hour")


def main_country(feat: DataFrame) -> DataFrame:
    """The country with most rows per customer."""
    c = feat.groupBy(K, "country").agg(F.count("*").alias("_n"))
    return _top1(c, "country", "country")


def future_spending(targ: DataFrame) -> DataFrame:
    """The target, total spend in the target period."""
    return targ.groupBy(K).agg(F.sum("total_price").alias("future_spending"))


# ------------------------------------------------------------- whole tables
def _per_customer(tagged: DataFrame) -> DataFrame:
    """One row per customer with the aggregates of its rows tagged f / t / c (column ``_p``).

    Distinct values are counted, and the modes found, from the rows of each (customer, value), five
    grouping sets of one hash aggregate whose buffers are numbers: no sort, no map of values as a
    buffer, and a customer holding a large share of rows is spread over many reducers by its values.
    Those rows are summed up per customer (and country, of which the customer has a few), then per customer.
    """
    ts, on = F.col("invoice_date"), F.col("_p") == "f"
    cells = tagged.select(K, "_p", "total_price", ts.alias("_ts"), F.col("ilgili_ID").alias("_invoice"), *[F.when(on, x).alias(n) for n, x in {
        "_product": F.col("stock_code"), "_month": F.year(ts) * 12 + F.month(ts), "_hour": F.hour(ts), "_country": F.col("country")}.items()])
    sets = [[K, "_p", "_invoice"], [K, "_product"], [K, "_month"], [K, "_hour"], [K, "_country"]]
    columns = [K, "_p", "_invoice", "_product", "_month", "_hour", "_country"]
    # the bit of a column is 0 in the sets that hold it
    bit = lambda c: 1 << (len(columns) - 1 - columns.index(c))
    here = lambda c: F.col("_set").bitwiseAND(bit(c)) == 0
    # sums and times are those of invoices: in the rows of the other sets they would only be moved
    of_invoice = F.grouping_id().bitwiseAND(bit("_invoice")) == 0
    values = cells.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in columns]).agg(
        F.grouping_id().alias("_set"), F.count("*").alias("_n"), *[f(F.when(of_invoice, F.col(c))).alias(n) for f, c, n in [
            (F.sum, "total_price", "_s"), (F.min, "_ts", "_lo"), (F.max, "_ts", "_hi")]])
    kind = lambda p: here("_invoice") & (F.col("_p") == p)
    distinct = lambda c, cond: F.count_if(cond & F.col(c).isNotNull())
    # the larger count first, then the smaller hour
    busiest = F.max(F.when(here("_hour") & F.col("_hour").isNotNull(), F.col("_n") * 32 + (31 - F.col("_hour"))))
    parts = values.groupBy(K, "_country").agg(
        F.min(F.when(kind("f"), F.col("_lo"))).alias("_first"), F.max(F.when(kind("f"), F.col("_hi"))).alias("_last"),
        F.sum(F.when(kind("f"), F.col("_s"))).alias("monetary"), F.sum(F.when(kind("t"), F.col("_s"))).alias("future_spending"),
        distinct("_invoice", kind("f")).alias("frequency"), distinct("_invoice", kind("c")).alias("cancellation_count"),
        distinct("_product", here("_product")).alias("unique_products"), distinct("_month", here("_month")).alias("active_months"),
        busiest.alias("_busiest"), F.count_if(kind("f")).alias("_f"), F.count_if(kind("t")).alias("_t"),
        F.sum(F.when(here("_country"), F.col("_n"))).alias("_rows"))
    main = F.min(F.when(F.col("_country").isNotNull(), F.struct((-F.col("_rows")).alias("n"), F.col("_country").alias("c"))))
    sums = ["monetary", "future_spending", "frequency", "cancellation_count", "unique_products", "active_months", "_f", "_t"]
    return parts.groupBy(K).agg(F.min("_first").alias("_first"), F.max("_last").alias("_last"), *[F.sum(c).alias(c) for c in sums],
                                F.max("_busiest").alias("_busiest"), main["c"].alias("country")) \
                .withColumn("most_active_hour", (31 - F.col("_busiest") % 32).cast("int"))


def _finish(g: DataFrame, split: Column) -> DataFrame:
    """Gold's columns from the aggregates of one customer per row."""
    derived = {"recency_days": F.datediff(split, F.col("_last")),
               "avg_basket_value": safe_ratio(F.col("monetary"), F.col("frequency")),
               "avg_days_between_purchases": _gap(F.col("_first"), F.col("_last"), F.col("frequency"))}
    return g.select(*[derived[c].alias(c) if c in derived else F.col(c) for c in GOLD_COLUMNS])


def gold_features_joined(purchases: DataFrame, cancellations: DataFrame,
                         split: Column | None = None, require_target: bool = True) -> DataFrame:
    """C3 by joins: one aggregate of the feature rows, J1 with the cancellations, J2 with the target."""
    split = split if split is not None else split_column(purchases)
    feat, targ, canc = temporal_split(purchases, cancellations, split)
    per_customer = _per_customer(feat.select(*INPUT_COLUMNS, F.lit("f").alias("_p"))).drop("cancellation_count", "future_spending")
    fill = {"cancellation_count": 0} if require_target else {"cancellation_count": 0, "future_spending": 0.0}
    whole = (per_customer.join(cancellation_count(canc), K, "left")
             .join(future_spending(targ), K, "inner" if require_target else "left").fillna(fill))
    return _finish(whole, split)


INPUT_COLUMNS = [K, "ilgili_ID", "stock_code", "invoice_date", "total_price", "country"]


def gold_features(purchases: DataFrame, cancellations: DataFrame,
                  split: Column | None = None, require_target: bool = True) -> DataFrame:
    """C3 as one aggregation per customer, from the two Silver tables.

    Rows are tagged f (feature purchase), t (target purchase) or c (feature
    cancellation) and aggregated once (see ``aggregate_tagged``).
    """
    split = split if split is not None else split_column(purchases)
    ts = F.col("invoice_date")
    tagged = (purchases.select(*INPUT_COLUMNS, F.when(ts < split, F.lit("f"))
                               .when(ts >= split, F.lit("t")).alias("_p"))
              .unionByName(cancellations.filter(ts < split).select(*INPUT_COLUMNS, F.lit("c").alias("_p"))))
    return aggregate_tagged(tagged, split, require_target)


def aggregate_tagged(tagged: DataFrame, split: Column, require_target: bool = True) -> DataFrame:
    """The one-pass Gold aggregate over rows tagged f / t / c.

    All of them are combined map-side (see ``_per_customer``).
    """
    g = _per_customer(tagged.filter(F.col("_p").isNotNull())).filter(F.col("_f") > 0)
    if require_target:
        g = g.filter(F.col("_t") > 0)
    else:
        g = g.withColumn("future_spending", F.coalesce("future_spending", F.lit(0.0)))
    return _finish(g, split)
