"""A hot customer (a third of all rows, with replayed copies) against a brute-force result."""

import datetime as dt
import math
import random

import pandas as pd
import pytest

from conftest import msg, records
from pyspark.sql import functions as F
from tillflow.operators import gold, silver
from tillflow.streaming.bronze import decode


def _messages(seed=7):
    rnd = random.Random(seed)
    t0 = dt.datetime(2021, 1, 1)
    out = []
    for i in range(600):
        hot = i % 3 == 0
        cust = 1 if hot else rnd.randint(2, 40)
        kind = "cancellation" if rnd.random() < 0.1 else "purchase"
        inv = ("C" if kind == "cancellation" else "") + str(rnd.randint(1, 120))
        when = t0 + dt.timedelta(hours=rnd.randint(0, 24 * 200))
        out.append(msg(customer=cust, kind=kind, invoice=inv, code=f"P{rnd.randint(1, 30)}",
                       qty=rnd.randint(1, 5) * (-1 if kind == "cancellation" else 1),
                       price=round(rnd.uniform(0.5, 20), 2), country=rnd.choice("ABC"),
                       when=when.isoformat()))
    out += out[:150]          # replayed deliveries
    return out


def _brute(messages):
    df = pd.DataFrame(messages)
    df["invoice_date"] = pd.to_datetime(df["invoice_date"])
    df = df[df.kullanici_ID.notna() & df.description.notna()]
    df = df.drop_duplicates(["ilgili_ID", "stock_code", "kullanici_ID", "invoice_date", "quantity"])
    df["total_price"] = df.quantity * df.unit_price
    p = df[(df.olay_tipi == "purchase") & (df.quantity > 0) & (df.unit_price > 0)]
    c = df[df.olay_tipi == "cancellation"]
    lo, hi = p.invoice_date.min(), p.invoice_date.max()
    split = (lo + pd.Timedelta(days=math.floor((hi - lo).days * 0.75))).floor("s")
    f, t, cf = p[p.invoice_date < split], p[p.invoice_date >= split], c[c.invoice_date < split]
    rows = {}
    for k, g in f.groupby("kullanici_ID"):
        if k not in set(t.kullanici_ID):
            continue
        n = g.ilgili_ID.nunique()
        span = (g.invoice_date.max().normalize() - g.invoice_date.min().normalize()).days
        hours = g.invoice_date.dt.hour.value_counts()
        countries = g.country.value_counts()
        rows[k] = {
            "recency_days": (split.normalize() - g.invoice_date.max().normalize()).days,
            "frequency": n, "monetary": g.total_price.sum(),
            "avg_days_between_purchases": span / (n - 1) if n > 1 else 0.0,
            "unique_products": g.stock_code.nunique(),
            "cancellation_count": cf[cf.kullanici_ID == k].ilgili_ID.nunique(),
            "active_months": g.invoice_date.dt.strftime("%Y-%m").nunique(),
            "most_active_hour": min(h for h, v in hours.items() if v == hours.max()),
            "country": min(x for x, v in countries.items() if v == countries.max()),
            "future_spending": t[t.kullanici_ID == k].total_price.sum(),
        }
    return rows


def test_hot_customer_gold_matches_brute_force(spark):
    messages = _messages()
    want = _brute(messages)
    b = decode(records(spark, messages), ingestion_time=F.lit(None).cast("timestamp"))
    p, c = silver.silver_tables(b)
    for form in (gold.gold_features, gold.gold_features_joined):
        got = {r["kullanici_ID"]: r.asDict() for r in form(p, c).collect()}
        assert set(got) == set(want)
        for k, w in want.items():
            for col, v in w.items():
                assert got[k][col] == (pytest.approx(v) if isinstance(v, float) else v), (form.__name__, k, col)
    clean = silver.silver_clean(silver.silver_typed(b))
    assert clean.count() == len(pd.DataFrame(messages).dropna(subset=["kullanici_ID", "description"])
                                .drop_duplicates(["ilgili_ID", "stock_code", "kullanici_ID", "invoice_date", "quantity"]))


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_gold_aggregates_have_number_buffers(spark):
    b = decode(records(spark, _messages()), ingestion_time=F.lit(None).cast("timestamp"))
    p, c = (spark.createDataFrame(t.collect(), t.schema) for t in silver.silver_tables(b))
    for form in (gold.gold_features, gold.gold_features_joined):
        plan = _plan(form(p, c))
        assert "ObjectHashAggregate" not in plan and "mode(" not in plan and "HashAggregate" in plan


def test_task_bounds_are_set_once_and_leave_chosen_ones(spark):
    from tillflow import session

    other = spark.newSession()
    silver.survivor(other.createDataFrame([(1, 2)], "kullanici_ID long, x long"), ["kullanici_ID"])
    assert {k: other.conf.get(k) for k in session.TASK_BOUNDS} == session.TASK_BOUNDS
    chosen = spark.newSession()
    chosen.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "32m")
    session.bound_tasks(chosen)
    assert chosen.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "32m"
    assert chosen.conf.get("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold") in ("0b", "0")


def test_training_rows_are_gathered(spark):
    from tillflow.operators import ml

    wide = spark.range(0, 3000, numPartitions=60)
    assert ml.gathered(wide).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert ml.gathered(spark.range(0, 100, numPartitions=2)).rdd.getNumPartitions() == 2 and ml.gathered(wide).count() == 3000
