"""Registered queries: Spark ML on the Gold table.

Queries over fitted models are rows-only (tree fits differ between engines);
the splits, vectors, metrics, run log and search have SQL, over deterministic
predictors where a model is needed.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.operators import fits, ml
from tillflow.plans import jobs
from tillflow.plans.pipeline import Layers, rounded
from tillflow.plans.registry import query
from tillflow.plans.sqlbase import q, register
from tillflow.session import scratch_path
from tillflow.sources import store

register("trim_pos", "SELECT * FROM gold WHERE future_spending > 0", ("gold",))
register("trim_t1", """
SELECT * FROM trim_pos WHERE future_spending <= (SELECT quantile_cont(future_spending, 0.99) FROM trim_pos)""",
         ("trim_pos",))


register("trimmed", "SELECT * FROM trim_t1 WHERE monetary <= (SELECT quantile_cont(monetary, 0.99) FROM trim_t1)", ("trim_t1",))
register("split_rows", f"""
SELECT *, CASE WHEN ('0x' || substr(md5(CAST(kullanici_ID AS VARCHAR) || ':{ml.SEED}'), 1, 8))::BIGINT % 100 < {ml.TRAIN_SHARE}
          THEN 'train' ELSE 'test' END AS split FROM trimmed""", ("trimmed",))
register("baseline", """
SELECT kullanici_ID, future_spending, 'TrainMean' AS model, (SELECT avg(future_spending) FROM split_rows WHERE split = 'train') AS prediction
FROM split_rows WHERE split = 'test'
UNION ALL
SELECT kullanici_ID, future_spending, 'PastSpend', monetary * (SELECT avg(future_spending) / avg(monetary) FROM split_rows WHERE split = 'train')
FROM split_rows WHERE split = 'test'""", ("split_rows",))
register("baseline_scores", """
SELECT model, count(*) AS n_test, sqrt(avg((prediction - future_spending) ** 2)) AS rmse, avg(abs(prediction - future_spending)) AS mae,
       1 - sum((prediction - future_spending) ** 2) / nullif(count(*) * var_pop(future_spending), 0) AS r2
FROM baseline GROUP BY model""", ("baseline",))


_TRAINED: dict = {}


def _inputs(spark, sf_dir) -> tuple:
    """(file, length, modification time) of the driver tables that Gold comes from."""
    sc, found = spark.sparkContext, []
    for table in ("lineitem", "orders", "part", "customer", "nation"):
        path = sc._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{table}.parquet")
        files = path.getFileSystem(sc._jsc.hadoopConfiguration()).listFiles(path, True)
        while files.hasNext():
            f = files.next()
            found.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return tuple(sorted(found))


def trained(spark, sf_dir) -> ml.Trained:
    """The five fitted models, shared by the queries of one application over unchanged input files."""
    key = (spark.sparkContext.applicationId, _inputs(spark, sf_dir))
    if key not in _TRAINED:
        _TRAINED.clear()
        _TRAINED[key] = ml.train_all(Layers(spark, sf_dir).gold_materialized())
    return _TRAINED[key]


def split_rows(spark, sf_dir):
    return ml.train_test_split(ml.outlier_trim(Layers(spark, sf_dir).gold_materialized()))


@query("outlier_trim", q("""
SELECT kullanici_ID, recency_days, frequency, round(monetary, 4) AS monetary,
       round(avg_basket_value, 4) AS avg_basket_value,
       round(avg_days_between_purchases, 4) AS avg_days_between_purchases, unique_products,
       cancellation_count, active_months, most_active_hour, country, round(future_spending, 4) AS future_spending
FROM trim_t1 WHERE monetary <= (SELECT quantile_cont(monetary, 0.99) FROM trim_t1)""", "trim_t1"))
def outlier_trim(spark, sf_dir):
    """M1/M2 with exact quantiles: positive target, target <= p99, monetary <= p99."""
    return rounded(ml.outlier_trim(Layers(spark, sf_dir).gold_materialized()))


@query("trim_funnel", q("""
SELECT 'gold' AS step, 0 AS position, count(*) AS row_count FROM gold
UNION ALL SELECT 'positive_target', 1, count(*) FROM trim_pos
UNION ALL SELECT 'target_trimmed', 2, count(*) FROM trim_t1
UNION ALL SELECT 'monetary_trimmed', 3, count(*) FROM trim_t1
  WHERE monetary <= (SELECT quantile_cont(monetary, 0.99) FROM trim_t1)""", "gold", "trim_t1"))
def trim_funnel(spark, sf_dir):
    """Rows after each step of the training-set trimming."""
    return ml.trim_funnel(Layers(spark, sf_dir).gold_materialized())


@query("outlier_trim_script", q("""
SELECT kullanici_ID, recency_days, frequency, round(monetary, 4) AS monetary,
       round(avg_basket_value, 4) AS avg_basket_value,
       round(avg_days_between_purchases, 4) AS avg_days_between_purchases, unique_products,
       cancellation_count, active_months, most_active_hour, country, round(future_spending, 4) AS future_spending
FROM gold WHERE future_spending <= (SELECT quantile_cont(future_spending, 0.99) FROM gold) AND future_spending > 0""",
                                   "gold"))
def outlier_trim_script(spark, sf_dir):
    """M1/M2 in the training script's order: target bound over all rows, then > 0 (exact quantile)."""
    g = Layers(spark, sf_dir).gold_materialized()
    return rounded(ml.outlier_trim(g, trim_monetary=False, bound_before_positive=True))


_GOLD = """kullanici_ID, recency_days, frequency, round(monetary, 4) AS monetary,
       round(avg_basket_value, 4) AS avg_basket_value, round(avg_days_between_purchases, 4) AS avg_days_between_purchases,
       unique_products, cancellation_count, active_months, most_active_hour, country, round(future_spending, 4) AS future_spending"""


@query("train_test_split", q(f"SELECT {_GOLD}, split FROM split_rows", "split_rows"))
def train_test_split(spark, sf_dir):
    """M3: trimmed Gold with a repeatable 80/20 hash split on the customer key."""
    return rounded(split_rows(spark, sf_dir))


def _features_sql() -> str:
    numbers = ", ".join(f"coalesce(round({c} / nullif((SELECT stddev_samp({c}) FROM tr), 0), 4), 0.0)" for c in ml.NUMERIC_COLS)
    return q(f"""
SELECT kullanici_ID, split, round(future_spending, 4) AS future_spending,
       list_concat([{numbers}], list_transform((SELECT list(struct_pack(c := country, sd := sd) ORDER BY n DESC, country) FROM slots),
                   lambda s: CASE WHEN s.c = country THEN coalesce(round(1 / nullif(s.sd, 0), 4), 0.0) ELSE 0.0 END)) AS features
FROM split_rows""", "slots")


register("tr", "SELECT * FROM split_rows WHERE split = 'train'", ("split_rows",))
register("slots", """
SELECT country, count(*) AS n, sqrt(count(*) * ((SELECT count(*) FROM tr) - count(*)) / ((SELECT count(*) FROM tr) * ((SELECT count(*) FROM tr) - 1.0))) AS sd
FROM tr GROUP BY country""", ("tr",))


@query("ml_features", _features_sql())
def ml_features(spark, sf_dir):
    """M4-M8: scaled feature vectors (as arrays) of every customer, pipeline fitted on train only."""
    rows = split_rows(spark, sf_dir)
    out = ml.feature_pipeline().fit(rows.filter(F.col("split") == "train")).transform(rows)
    return rounded(out.select("kullanici_ID", "split", ml.TARGET, F.transform(
        vector_to_array("features"), lambda x: F.round(x, 4)).alias("features")))


_SCORES = "model, n_test, round(rmse, 4) AS rmse, round(mae, 4) AS mae, round(r2, 6) AS r2"


def _baseline_metrics(spark, sf_dir):
    m = ml.regression_metrics(ml.baseline_predictions(split_rows(spark, sf_dir)), ["model"])
    return m.select("model", "n_test", F.round("rmse", 4).alias("rmse"), F.round("mae", 4).alias("mae"), F.round("r2", 6).alias("r2"))


@query("baseline_metrics", q(f"SELECT {_SCORES} FROM baseline_scores", "baseline_scores"))
def baseline_metrics(spark, sf_dir):
    """M14 over the deterministic predictors."""
    return _baseline_metrics(spark, sf_dir)


@query("baseline_leaderboard", q(f"SELECT {_SCORES}, row_number() OVER (ORDER BY rmse, model) = 1 AS is_best FROM baseline_scores",
                                 "baseline_scores"))
def baseline_leaderboard(spark, sf_dir):
    """M15 over the deterministic predictors."""
    return ml.ranked(_baseline_metrics(spark, sf_dir))


@query("baseline_residuals", q("""
SELECT model, count(*) AS n, round(avg(r), 4) AS mean_residual, round(stddev_samp(r), 4) AS std_residual,
       round(max(r), 4) AS max_residual, round(min(r), 4) AS min_residual
FROM (SELECT model, future_spending - prediction AS r FROM baseline) GROUP BY model""", "baseline"))
def baseline_residuals(spark, sf_dir):
    """M16 over the deterministic predictors, all test rows."""
    return rounded(ml.residual_stats(ml.baseline_predictions(split_rows(spark, sf_dir))))


def _logged_baselines(spark, sf_dir) -> str:
    rows = [r.asDict() for r in _baseline_metrics(spark, sf_dir).collect()]  # one row per predictor
    root = scratch_path(spark, f"runs-{uuid.uuid4().hex}")
    store.log_runs(spark, root, ml.baseline_records(rows))
    store.log_runs(spark, root, [{"experiment": "other", "run_name": "x", "model_type": "x"}])
    return root


@query("baseline_run_log", q(f"""
SELECT '{ml.EXPERIMENT}-baselines' AS experiment, model AS run_name, model AS model_type, unnest(['rmse', 'mae', 'r2']) AS metric,
       unnest([round(rmse, 4), round(mae, 4), round(r2, 6)]) AS value, '{ml.SEED}' AS seed, '{ml.TRAIN_SHARE}' AS train_share
FROM baseline_scores""", "baseline_scores"))
def baseline_run_log(spark, sf_dir):
    """K5: the predictors' runs as the run-log table holds them (metrics and parameters unfolded)."""
    runs = spark.read.parquet(f"{_logged_baselines(spark, sf_dir)}/runs").filter(F.col("experiment") != "other")
    return runs.select("experiment", "run_name", "model_type", F.explode("metrics").alias("metric", "value"),
                       F.col("params")["seed"].alias("seed"), F.col("params")["train_share"].alias("train_share"))


@query("baseline_run_search", q("SELECT model AS run_name, round(rmse, 4) AS rmse, round(mae, 4) AS mae, round(r2, 6) AS r2 FROM baseline_scores",
                                "baseline_scores"))
def baseline_run_search(spark, sf_dir):
    """The runs of one experiment among others, best first."""
    runs = store.search_runs(spark, _logged_baselines(spark, sf_dir), f"{ml.EXPERIMENT}-baselines")
    return runs.select("run_name", *[F.col("metrics")[m].alias(m) for m in ("rmse", "mae", "r2")]).orderBy("rmse", "run_name")


@query("model_metrics")
def model_metrics(spark, sf_dir):
    """RMSE / MAE / R^2 and fit time of the five regressors on the test split."""
    return ml.model_metrics(trained(spark, sf_dir))


@query("model_leaderboard")
def model_leaderboard(spark, sf_dir):
    """Models ordered by RMSE with the best one flagged."""
    return ml.leaderboard(trained(spark, sf_dir))


@query("residual_stats")
def residual_stats(spark, sf_dir):
    """Residual summary per model over every test row."""
    return ml.residual_stats(trained(spark, sf_dir).predictions)


@query("feature_importance")
def feature_importance(spark, sf_dir):
    """Random-forest and GBT importances by feature, country slots summed."""
    return ml.feature_importance(trained(spark, sf_dir))


# ------------------------------------------------------- what the fitted models must agree with
BINS = 16
_CUTS = ", ".join(f"{k / BINS}" for k in range(1, BINS))
register("cuts", " UNION ALL ".join(
    f"SELECT '{c}' AS feature, unnest(list_distinct(quantile_cont({c}::DOUBLE, [{_CUTS}]))) AS threshold FROM tr" for c in ml.NUMERIC_COLS), ("tr",))
register("candidates", " UNION ALL ".join(
    [f"SELECT feature, threshold, {c} <= threshold AS goes_left, future_spending AS y FROM tr JOIN cuts ON feature = '{c}'" for c in ml.NUMERIC_COLS]
    + ["SELECT 'country=' || s.country, 0.5, tr.country <> s.country, future_spending FROM tr, slots s"]), ("tr", "cuts", "slots"))


@query("tree_split_gain", q("""
SELECT feature, round(threshold, 4) AS threshold, n_left, n_right, round(mean_left, 4) AS mean_left, round(mean_right, 4) AS mean_right,
       round((v - (n_left * coalesce(v_left, 0) + n_right * coalesce(v_right, 0)) / n) / v, 8) AS gain_share
FROM (SELECT feature, threshold, count(*) AS n, count(*) FILTER (goes_left) AS n_left, count(*) FILTER (NOT goes_left) AS n_right,
             avg(y) FILTER (goes_left) AS mean_left, avg(y) FILTER (NOT goes_left) AS mean_right, var_pop(y) AS v,
             var_pop(y) FILTER (goes_left) AS v_left, var_pop(y) FILTER (NOT goes_left) AS v_right
      FROM candidates GROUP BY feature, threshold)""", "candidates"))
def tree_split_gain(spark, sf_dir):
    """The variance gain of every candidate split of the training rows (quantile bins, and each country)."""
    train = Layers(spark, sf_dir).write(split_rows(spark, sf_dir).filter(F.col("split") == "train"), "train")
    gains = fits.split_gains(train, ml.NUMERIC_COLS, ml.TARGET, fits.quantile_thresholds(train, ml.NUMERIC_COLS, BINS), ml.CATEGORICAL_COLS)
    places = {"gain_share": 8}
    return gains.drop("gain").select(*[F.round(c, places.get(c, 4)).alias(c) if t == "double" else F.col(c) for c, t in gains.drop("gain").dtypes])


_dense = {"1": "1.0", **{c: f"{c}::DOUBLE" for c in (*ml.NUMERIC_COLS, ml.TARGET)}}
register("gram_numbers", " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, avg({x} * {y}) AS value FROM tr" for a, x in _dense.items() for b, y in _dense.items()), ("tr",))
register("gram_slots", " UNION ALL ".join(
    f"SELECT '{a}' AS a, 'country=' || country AS b, sum({x}) / (SELECT count(*) FROM tr) AS value FROM tr GROUP BY country"
    for a, x in _dense.items()), ("tr",))
register("gram", """SELECT * FROM gram_numbers UNION ALL SELECT a, b, value FROM gram_slots UNION ALL SELECT b, a, value FROM gram_slots
UNION ALL SELECT b, b, value FROM gram_slots WHERE a = '1'""", ("gram_numbers", "gram_slots"))


@query("gram_matrix", q("""
SELECT g.a, g.b, round(g.value / sqrt(x.value * y.value), 8) AS cosine
FROM gram g JOIN gram x ON x.a = g.a AND x.b = g.a JOIN gram y ON y.a = g.b AND y.b = g.b WHERE x.value > 0 AND y.value > 0""", "gram"))
def gram_matrix(spark, sf_dir):
    """The Gram matrix of the training rows' columns, country slots, target and constant, each brought to length one."""
    train = split_rows(spark, sf_dir).filter(F.col("split") == "train")
    # (features + 2)^2 rows
    moments = Layers(spark, sf_dir).write(fits.cross_moments(train, ml.NUMERIC_COLS, "country", ml.TARGET), "gram")
    size = moments.filter("a = b and value > 0").select("a", F.col("value").alias("size"))
    return (moments.join(size, "a").join(size.toDF("b", "other"), "b")
            .select("a", "b", F.round(F.col("value") / F.sqrt(F.col("size") * F.col("other")), 8).alias("cosine")))


@query("lr_residual_moments", q(f"""
SELECT model, feature, round(with_target, 4) AS with_target, 0.0::DOUBLE AS gap, 0.0::DOUBLE AS solve_gap
FROM ({" UNION ALL ".join(f"SELECT '{c}' AS feature, coalesce(covar_pop({c} / nullif((SELECT stddev_samp({c}) FROM tr), 0), future_spending), 0) AS with_target FROM tr" for c in ml.NUMERIC_COLS)}
      UNION ALL SELECT '1', 0.0
      UNION ALL SELECT 'country=' || s.country, covar_pop(CASE WHEN tr.country = s.country THEN 1 / s.sd ELSE 0 END, future_spending) FROM tr, slots s GROUP BY s.country),
     (SELECT unnest(['LinearRegression', 'GeneralizedLinear']) AS model)""", "tr", "slots"))
def lr_residual_moments(spark, sf_dir):
    """The fitted linear models' first-order condition, and their distance from the Gram matrix's solution: both 0."""
    got = ml.linear_residuals(trained(spark, sf_dir))
    return got.select("model", "feature", F.round("with_target", 4).alias("with_target"),
                      *[(F.round(c, 4) + 0.0).alias(c) for c in ("gap", "solve_gap")])


@query("approx_trim_bounds", q(f"""
SELECT 'future_spending' AS column_name, count(*) AS n, {ml.TRIM_QUANTILE}::DOUBLE AS quantile, true AS within FROM trim_pos
UNION ALL SELECT 'monetary', count(monetary), {ml.TRIM_QUANTILE}::DOUBLE, true FROM trim_pos""", "trim_pos"))
def approx_trim_bounds(spark, sf_dir):
    """M2 with sketches: those of each country merged into one; the rank of each bound is counted and lies within 1 % of n."""
    rows = Layers(spark, sf_dir).gold_materialized().filter(F.col(ml.TARGET) > 0)
    sketches = fits.merged_sketch(fits.quantile_sketch(rows, [ml.TARGET, "monetary"], ["country"]))
    bounds = Layers(spark, sf_dir).write(sketches.select("column_name", fits.sketched_quantile(ml.TRIM_QUANTILE).alias("bound")), "bounds")
    parts = [fits.rank_check(rows, c, fits.literal_row(bounds.filter(F.col("column_name") == c).select("bound"))["bound"], ml.TRIM_QUANTILE, 0.01)
             for c in (ml.TARGET, "monetary")]
    return parts[0].unionByName(parts[1]).select("column_name", "n", F.lit(ml.TRIM_QUANTILE).alias("quantile"), "within")


@query("saved_tree_nodes")
def saved_tree_nodes(spark, sf_dir):
    """The saved tree models read back as tables of nodes, summed up per model."""
    t, parts = trained(spark, sf_dir), []
    for name in ("DecisionTree", "RandomForest", "GBT"):
        path = scratch_path(spark, f"model-{uuid.uuid4().hex}")
        ml.save_model(t.models[name], path)
        parts.append(fits.tree_nodes(spark, path).groupBy(F.lit(name).alias("model")).agg(
            F.count_distinct("tree").alias("trees"), F.count("*").alias("nodes"), F.count_if(F.col("gain").isNull()).alias("leaves"),
            F.sum(F.when(F.col("node") == 0, F.col("row_count"))).alias("rows_at_roots")))
    return reduce(DataFrame.unionByName, parts)


def _logged_runs(spark, sf_dir) -> str:
    """Append the trained models' runs to a fresh run-log table; return its root."""
    t = trained(spark, sf_dir)
    metrics = [r.asDict() for r in ml.model_metrics(t).collect()]  # one row per model
    root = scratch_path(spark, f"runs-{uuid.uuid4().hex}")
    store.log_runs(spark, root, ml.run_records(t, metrics))
    return root


@query("run_log")
def run_log(spark, sf_dir):
    """K5: the runs appended to a run-log table (params and metrics as maps)."""
    root = _logged_runs(spark, sf_dir)
    return store.search_runs(spark, root, ml.EXPERIMENT).select(
        "experiment", "run_name", "model_type", "params",
        F.map_filter("metrics", lambda k, v: k != "training_time_seconds").alias("metrics"))


@query("run_search")
def run_search(spark, sf_dir):
    """The runs of one experiment as a frame (model, RMSE, MAE, R^2), best first."""
    root = _logged_runs(spark, sf_dir)
    runs = store.search_runs(spark, root, ml.EXPERIMENT)
    return runs.select("run_name", "model_type", F.col("metrics")["rmse"].alias("rmse"),
                       F.col("metrics")["mae"].alias("mae"), F.col("metrics")["r2"].alias("r2")) \
               .orderBy("rmse", "run_name")


@query("publish_history", q("""
SELECT t.name AS "table", v.version, CASE WHEN v.version = 0 THEN 'WRITE' ELSE 'OVERWRITE' END AS operation, t.n AS num_output_rows
FROM (SELECT 'bronze' AS name, count(*) AS n FROM bronze UNION ALL SELECT 'silver_purchases', count(*) FROM purchases
      UNION ALL SELECT 'silver_cancellations', count(*) FROM cancellations UNION ALL SELECT 'gold', count(*) FROM gold) t,
     (SELECT unnest([0, 1])::BIGINT AS version) v
WHERE v.version = 0 OR t.name <> 'bronze'""", "bronze", "purchases", "cancellations", "gold"))
def publish_history(spark, sf_dir):
    """K3/K7: Bronze published once, Silver and Gold twice from the written layer below; the version log."""
    lake = scratch_path(spark, f"lake-{uuid.uuid4().hex}")
    jobs.run_all(spark, sf_dir, lake)
    jobs.silver_job(spark, lake)
    jobs.gold_job(spark, lake)
    logs = [store.publish_history(spark, lake, t) for t in jobs.LAYERS.values()]
    return reduce(DataFrame.unionByName, logs).select("table", "version", "operation", "num_output_rows")
