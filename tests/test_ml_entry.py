"""ML cross-checks and the driver contract."""

import os
import random
import tempfile

import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from conftest import SF
from tillflow.operators import ml
from tillflow.plans.pipeline import Layers


@pytest.fixture(scope="module")
def trained(spark):
    g = Layers(spark, "/root/testdata/sf0.01").gold()
    return ml.train_all(g, models=["LinearRegression", "GeneralizedLinear", "DecisionTree"])


def test_metrics_equal_evaluator(trained):
    ours = {r["model"]: r for r in ml.model_metrics(trained).collect()}
    for name in trained.models:
        pred = trained.predictions.filter(F.col("model") == name)
        for metric in ("rmse", "mae", "r2"):
            ev = RegressionEvaluator(labelCol=ml.TARGET, predictionCol="prediction", metricName=metric)
            assert ours[name][metric] == pytest.approx(ev.evaluate(pred), rel=1e-6)


def test_linear_equals_glm(trained):
    m = {r["model"]: r["rmse"] for r in ml.model_metrics(trained).collect()}
    assert m["LinearRegression"] == pytest.approx(m["GeneralizedLinear"], rel=1e-3)


def test_leaderboard_and_save_load(trained, spark):
    lb = ml.leaderboard(trained).collect()
    assert sum(r["is_best"] for r in lb) == 1 and lb[0]["is_best"]
    path = os.path.join(tempfile.mkdtemp(prefix="tillflow-model-"), "lr")
    ml.save_model(trained.models["LinearRegression"], path)
    from pyspark.ml.regression import LinearRegressionModel
    again = LinearRegressionModel.load(path)
    te = trained.prepared.filter(F.col("split") == "test")
    a = trained.models["LinearRegression"].transform(te).select("prediction").collect()
    b = again.transform(te).select("prediction").collect()
    assert a == b


def test_split_is_repeatable(spark):
    g = Layers(spark, SF).gold()
    a = ml.train_test_split(g).select("kullanici_ID", "split")
    b = ml.train_test_split(g.repartition(3)).select("kullanici_ID", "split")
    assert a.exceptAll(b).count() == 0
    r = ml.train_test_split(g, method="random")
    assert r.count() == g.count() and r.select("kullanici_ID").distinct().count() == g.count()


def test_entry_contract(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    lazy = Layers(spark, SF)
    assert df.columns == lazy.gold().columns and df.count() == lazy.gold().count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())


def test_jobs_write_layers_and_match_lazy_gold(spark):
    from tillflow.plans import jobs
    from tillflow.sources import store
    lake = tempfile.mkdtemp(prefix="tillflow-lake-")
    counts = jobs.run_all(spark, SF, lake)
    lazy = Layers(spark, SF)
    assert counts["silver_purchases"] == lazy.purchases().count()
    assert counts["gold"] == lazy.gold().count()
    written = store.read_layer(spark, lake, "gold")
    cols = written.columns
    a = written.select(*[F.round(c, 6) if t == "double" else F.col(c) for c, t in written.dtypes])
    b = lazy.gold().select(*cols)
    b = b.select(*[F.round(c, 6) if t == "double" else F.col(c) for c, t in b.dtypes])
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    hist = store.publish_history(spark, lake, "gold").collect()
    assert [r["version"] for r in hist] == [0]
    lc = {r["layer"]: r["row_count"] for r in store.layer_counts(spark, lake, [*jobs.LAYERS, "missing"]).collect()}
    assert set(lc) == set(jobs.LAYERS)


def test_schema_report(spark):
    from tillflow.sources import store
    g = Layers(spark, SF).gold()
    rows = store.schema_report(g, "gold").collect()
    assert [r["column_name"] for r in rows] == g.columns
    assert {r["column_name"]: r["data_type"] for r in rows}["recency_days"] == "int"


def test_gold_invariants_and_trim_options(spark):
    g = Layers(spark, SF).gold()
    bad = g.filter(F.abs(F.col("monetary") - F.col("frequency") * F.col("avg_basket_value")) > 1e-6 * F.abs("monetary"))
    assert bad.count() == 0
    exact = ml.outlier_trim(g)
    approx = ml.outlier_trim(g, exact=False)
    n = g.filter(F.col("future_spending") > 0).count()
    assert 0 < exact.count() <= n and 0 < approx.count() <= n
    only_target = ml.outlier_trim(g, trim_monetary=False)
    assert only_target.count() >= exact.count()


def test_bounded_stream_batches(spark):
    from tillflow.sources.tables import to_messages, transactions
    from tillflow.streaming import bronze as stream
    root = tempfile.mkdtemp(prefix="tillflow-bounded-")
    recs = stream.feed_records(to_messages(transactions(spark, SF)))
    for part in range(3):
        stream.write_feed(recs.filter(F.pmod(F.col("offset"), F.lit(3)) == part), os.path.join(root, "feed"))
    q = stream.start_ingest(stream.read_stream(spark, "files", os.path.join(root, "feed"), max_files_per_trigger=1),
                            os.path.join(root, "out"), os.path.join(root, "ckpt"))
    q.awaitTermination()
    batches = [p for p in q.recentProgress if p["numInputRows"] > 0]
    assert len(batches) >= 3
    assert spark.read.parquet(os.path.join(root, "out")).count() == recs.count()


def test_run_log_search(spark, trained):
    from tillflow.sources import store
    root = tempfile.mkdtemp(prefix="tillflow-runs-")
    assert store.search_runs(spark, root, ml.EXPERIMENT).count() == 0          # nothing logged yet
    metrics = [r.asDict() for r in ml.model_metrics(trained).collect()]
    store.log_runs(spark, root, ml.run_records(trained, metrics))
    runs = store.search_runs(spark, root, ml.EXPERIMENT).collect()
    assert {r["run_name"] for r in runs} == set(trained.models)          # importances are logged when a tree ensemble was fitted
    assert store.search_runs(spark, root, "other").count() == 0


def _plan_text(df):
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_plan_guards(spark):
    """Gold from written Silver has two joins at most, prunes columns, and the time bound reaches the scan."""
    from tillflow.operators import gold
    from tillflow.plans import jobs
    lake = tempfile.mkdtemp(prefix="tillflow-guard-")
    jobs.run_all(spark, SF, lake)
    p = jobs.read_silver(spark, lake, "silver_purchases")
    c = jobs.read_silver(spark, lake, "silver_cancellations")
    split = gold.split_column(p)
    plan = _plan_text(gold.gold_features(p, c, split))
    assert "LessThan(invoice_date" in plan
    assert "ReadSchema: struct<kullanici_ID:bigint,ilgili_ID:string,stock_code:string,country:string," in plan
    joined = _plan_text(gold.gold_features_joined(p, c, split)).split("\n\n")[0]
    assert joined.count("Join") == 2


def test_driver_tables_are_scanned_once_over_all_jobs(spark):
    import json
    import subprocess
    import sys
    names = ["gold_features", "gold_features_joined", "rfm", "temporal_split", "dashboard_kpis", "cancellation_summary",
             "cleaning_funnel", "layer_counts", "spend_boxplot", "publish_history", "describe_quartiles", "encode_messages", "publish_offsets"]
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run([sys.executable, "scripts/scan_count.py", SF, *names], cwd=root, capture_output=True, text=True, timeout=600)
    counts = json.loads(out.stdout.strip().splitlines()[-1])
    assert counts == dict.fromkeys(names, 5)          # lineitem, orders, part, customer, nation


def test_r2_is_stable_for_large_values(spark):
    rows = [(1, 1e9, 1e9 + 0.1), (2, 1e9 + 1, 1e9 + 1.1), (3, 1e9 + 2, 1e9 + 1.9)]
    pred = spark.createDataFrame(rows, f"kullanici_ID long, {ml.TARGET} double, prediction double")
    r2 = ml.regression_metrics(pred).collect()[0]["r2"]
    assert r2 == pytest.approx(0.985, abs=1e-6)
    flat = spark.createDataFrame([(1, 5.0, 4.0)], pred.schema)
    assert ml.regression_metrics(flat).collect()[0]["r2"] is None


def test_trees_find_a_planted_signal(spark):
    """The target follows one feature: importances sum to 1, that feature leads, and equal seeds give equal results."""
    rnd = random.Random(4)
    rows = []
    for i in range(400):
        x = {c: rnd.uniform(0, 100) for c in ml.NUMERIC_COLS}
        rows.append((i, *[x[c] for c in ml.NUMERIC_COLS], rnd.choice("ABC"), 50.0 + 7 * x["unique_products"] + rnd.uniform(0, 5)))
    schema = "kullanici_ID long, " + ", ".join(f"{c} double" for c in ml.NUMERIC_COLS) + f", country string, {ml.TARGET} double"
    gold = spark.createDataFrame(rows, schema)
    runs = [ml.train_all(gold, models=["RandomForest", "GBT"]) for _ in range(2)]
    tables = [sorted(tuple(r) for r in ml.feature_importance(t).collect()) for t in runs]
    assert tables[0] == tables[1]
    for name in ("RandomForest", "GBT"):
        imp = {f: v for m, f, v, *_ in tables[0] if m == name}
        assert sum(imp.values()) == pytest.approx(1.0) and max(imp, key=imp.get) == "unique_products"
    metrics = {r["model"]: r for r in ml.model_metrics(runs[0]).collect()}
    assert all(m["r2"] > 0.7 for m in metrics.values())
    stats = {r["model"]: r for r in ml.residual_stats(runs[0].predictions).collect()}
    assert all(stats[m]["n"] == metrics[m]["n_test"] and abs(stats[m]["mean_residual"]) < stats[m]["std_residual"] for m in metrics)
    records = ml.run_records(runs[0], [r.asDict() for r in ml.model_metrics(runs[0]).collect()])
    last = records[-1]
    assert last["run_name"] == "FeatureImportance" and sum(v for k, v in last["metrics"].items() if k.startswith("rf_")) == pytest.approx(1.0)


def test_linear_regression_equals_the_closed_form(spark):
    """Ridge on standardised inputs (the library's penalty), solved directly."""
    import numpy as np
    rnd = np.random.default_rng(3)
    x = rnd.normal(size=(300, len(ml.NUMERIC_COLS))) * np.arange(1, len(ml.NUMERIC_COLS) + 1) + 5
    y = np.abs(x @ rnd.normal(size=x.shape[1])) + 10 + rnd.normal(size=300)
    schema = "kullanici_ID long, " + ", ".join(f"{c} double" for c in ml.NUMERIC_COLS) + f", country string, {ml.TARGET} double"
    gold = spark.createDataFrame([(i, *map(float, r), "A", float(t)) for i, (r, t) in enumerate(zip(x, y))], schema)
    t = ml.train_all(gold, models=["LinearRegression"])
    rows = [(r["split"], r[ml.TARGET], r["features"]) for r in ml.features_frame(t).collect()]
    tr = [(v, f) for s, v, f in rows if s == "train"]
    a, b = np.array([f for _, f in tr])[:, :len(ml.NUMERIC_COLS)], np.array([v for v, _ in tr])
    sx, sy = a.std(axis=0, ddof=1), b.std(ddof=1)
    z, w = (a - a.mean(axis=0)) / sx, (b - b.mean()) / sy
    lam = ml.MODEL_PARAMS["LinearRegression"]["regParam"] / sy
    beta = np.linalg.solve(z.T @ z / len(b) + lam * np.eye(z.shape[1]), z.T @ w / len(b)) * sy / sx
    got = t.models["LinearRegression"].coefficients.toArray()[:len(beta)]
    assert np.allclose(got, beta, rtol=1e-3, atol=1e-6)


def test_layers_with_an_empty_side(spark):
    """Bronze without cancellations (and without anything): empty tables, no missing path."""
    from conftest import msg, records
    from tillflow.plans import jobs
    from tillflow.sources import store
    from tillflow.streaming.bronze import decode
    for messages in ([msg(invoice=str(i), when=f"2020-01-0{1 + i}T10:00:00") for i in range(5)], []):
        lake = tempfile.mkdtemp(prefix="tillflow-empty-")
        store.publish(decode(records(spark, messages)), lake, "bronze")
        counts = jobs.silver_job(spark, lake)
        assert counts == {"silver_purchases": len(messages), "silver_cancellations": 0}
        assert jobs.read_silver(spark, lake, "silver_cancellations").count() == 0
        assert jobs.gold_job(spark, lake) == (1 if messages else 0)


def test_log_times_do_not_depend_on_the_process_zone(spark):
    import datetime as dt
    import time
    from tillflow.sources import store
    root = tempfile.mkdtemp(prefix="tillflow-zone-")
    before = os.environ.get("TZ")
    os.environ["TZ"] = "America/New_York"
    time.tzset()
    try:
        store.publish(spark.range(3).toDF("x"), root, "t")
    finally:
        os.environ.pop("TZ") if before is None else os.environ.update(TZ=before)
        time.tzset()
    logged = store.publish_history(spark, root, "t").select(F.unix_timestamp("timestamp").alias("s")).collect()[0]["s"]
    assert abs(logged - dt.datetime.now(dt.timezone.utc).timestamp()) < 300


def test_jobs_command_on_a_feed(spark, capsys):
    """The command line: a feed folder ingested as a stream, Silver and Gold, and the saved models."""
    from tillflow.plans import jobs
    from tillflow.sources.tables import to_messages, transactions
    from tillflow.streaming import bronze as stream
    lake = tempfile.mkdtemp(prefix="tillflow-cli-")
    msgs = to_messages(transactions(spark, SF))
    stream.write_feed(stream.feed_records(msgs), os.path.join(lake, "feed"))
    for step in ("bronze", "silver", "gold"):
        jobs.main([SF, lake, step, "--source", "files", "--feed", os.path.join(lake, "feed"), "--duration", "8"], spark)
    said = capsys.readouterr().out
    assert f"bronze {msgs.count()}" in said
    assert spark.read.parquet(os.path.join(lake, "gold")).count() == Layers(spark, SF).gold().count()
    assert stream.progress_frame(spark, os.path.join(lake, "_progress", "bronze")).agg(F.sum("input_rows")).first()[0] == msgs.count()


def test_a_model_that_cannot_be_saved_is_a_warning(spark, monkeypatch, caplog):
    from tillflow.plans import jobs
    from tillflow.sources import store
    lake = tempfile.mkdtemp(prefix="tillflow-save-")
    store.publish(Layers(spark, "/root/testdata/sf0.01").gold(), lake, "gold")
    real = ml.train_all
    monkeypatch.setattr(jobs.ml, "train_all", lambda g: real(g, models=["LinearRegression"]))

    def broken(model, path):
        raise OSError("no space")

    good = ml.save_model
    monkeypatch.setattr(jobs.ml, "save_model", broken)
    assert len(jobs.train_job(spark, lake)) == 1 and "was not saved" in caplog.text
    assert store.search_runs(spark, lake, ml.EXPERIMENT).count() == 1
    monkeypatch.setattr(jobs.ml, "save_model", good)
    jobs.train_job(spark, lake)
    assert os.path.isdir(os.path.join(lake, "models", "LinearRegression"))
