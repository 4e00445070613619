"""Spark ML on the Gold table: trimming, split, feature pipeline, five regressors,
metrics, leaderboard, residuals and feature importance (M1-M17).

Model fitting is MLlib's distributed training; metrics and residuals are
aggregates over the prediction frame, never pandas on the driver.
"""

from __future__ import annotations

import datetime as dt
import time
import uuid
from dataclasses import dataclass, field
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import (
    DecisionTreeRegressor, GBTRegressor, GeneralizedLinearRegression, LinearRegression,
    RandomForestRegressor,
)
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillflow.functions import literal_row
from tillflow.operators import fits
from tillflow.operators.profile import exact_quantiles
from tillflow.session import scratch_path
from tillflow.sources.schemas import CUSTOMER, GOLD_COLUMNS

# --- fixed values: model inputs and hyper-parameters of the training job ---
CATEGORICAL_COLS = ["country"]
TARGET = "future_spending"
SEED = 42
TRAIN_SHARE = 80  # percent
TRIM_QUANTILE = 0.99
EXPERIMENT = "customer-future-spending"
MODEL_PARAMS = {
    "LinearRegression": {"maxIter": 50, "regParam": 0.1, "elasticNetParam": 0.0},
    "DecisionTree": {"maxDepth": 8, "minInstancesPerNode": 5},
    "RandomForest": {"numTrees": 50, "maxDepth": 10, "seed": SEED},
    "GBT": {"maxIter": 50, "maxDepth": 6, "stepSize": 0.1, "seed": SEED},
    "GeneralizedLinear": {"family": "gaussian", "link": "identity", "maxIter": 50, "regParam": 0.1},
}
# --- end of fixed values ---

# The numeric model inputs are Gold's columns without the key, the categories and the target.
NUMERIC_COLS = [c for c in GOLD_COLUMNS if c not in (CUSTOMER, TARGET, *CATEGORICAL_COLS)]


def _estimator(name: str):
    p = MODEL_PARAMS[name]
    common = {"featuresCol": "features", "labelCol": TARGET, "predictionCol": "prediction"}
    cls = {"LinearRegression": LinearRegression, "DecisionTree": DecisionTreeRegressor,
           "RandomForest": RandomForestRegressor, "GBT": GBTRegressor,
           "GeneralizedLinear": GeneralizedLinearRegression}[name]
    return cls(**common, **p)


# ------------------------------------------------------------ preparation
def trim_bound(df: DataFrame, column: str, q: float = TRIM_QUANTILE, exact: bool = True) -> Column:
    """The q-quantile of a column as a literal (null for an empty column)."""
    if exact:
        return literal_row(exact_quantiles(df, column, [q], ["b"]))["b"]
    sketch = fits.quantile_sketch(df, [column])
    return literal_row(sketch.select(fits.sketched_quantile(q).alias("b")).agg(F.max("b").alias("b")))["b"]


def outlier_trim(gold: DataFrame, q: float = TRIM_QUANTILE, trim_monetary: bool = True,
                 exact: bool = True, bound_before_positive: bool = False) -> DataFrame:
    """M1/M2: positive targets, then target <= its q-quantile, then monetary <= its q-quantile.

    ``exact`` uses the distributed exact quantile (deterministic, oracle-equal);
    otherwise a mergeable quantile sketch whose rank is within 0.01 n, the error
    of the original job's ``approxQuantile``.
    ``bound_before_positive`` with ``trim_monetary=False`` is the training
    script's order: the target bound is taken over all rows, then both filters.
    """
    def bound(df: DataFrame, c: str) -> Column:
        return trim_bound(df, c, q, exact)

    if bound_before_positive:
        kept = gold.filter(F.col(TARGET) <= bound(gold, TARGET)).filter(F.col(TARGET) > 0)
        if trim_monetary:
            kept = kept.filter(F.col("monetary") <= bound(kept, "monetary"))
        return kept

    pos = gold.filter(F.col(TARGET) > 0)
    kept = pos.filter(F.col(TARGET) <= bound(pos, TARGET))
    if trim_monetary:
        kept = kept.filter(F.col("monetary") <= bound(kept, "monetary"))
    return kept


def trim_funnel(gold: DataFrame, q: float = TRIM_QUANTILE) -> DataFrame:
    """E17 (training part): rows after each trimming step, as (step, position, row_count)."""
    from tillflow.operators.reports import step_counts
    pos = gold.filter(F.col(TARGET) > 0)
    t1 = pos.filter(F.col(TARGET) <= literal_row(exact_quantiles(pos, TARGET, [q], ["b"]))["b"])
    t2 = t1.filter(F.col("monetary") <= literal_row(exact_quantiles(t1, "monetary", [q], ["b"]))["b"])
    return step_counts([("gold", gold), ("positive_target", pos), ("target_trimmed", t1),
                        ("monetary_trimmed", t2)])


def split_column(seed: int = SEED, train_share: int = TRAIN_SHARE) -> Column:
    """M3: hash split on the customer key (32 bits of an md5): repeatable whatever the partitioning or engine."""
    digest = F.md5(F.concat_ws(":", F.col(CUSTOMER).cast("string"), F.lit(str(seed))))
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    return F.when(h % 100 < train_share, F.lit("train")).otherwise(F.lit("test"))


def train_test_split(df: DataFrame, method: str = "hash") -> DataFrame:
    """M3: add ``split`` = train / test.

    ``hash`` (default) depends only on the customer key. ``random`` is the
    original ``randomSplit([0.8, 0.2], seed)``, whose result depends on the
    partitioning and row order of the input.
    """
    if method == "random":
        train, test = df.randomSplit([TRAIN_SHARE / 100, 1 - TRAIN_SHARE / 100], seed=SEED)
        return train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))
    return df.withColumn("split", split_column())


def feature_pipeline() -> Pipeline:
    """M4-M7 as one pipeline from Gold columns to ``features``.

    A category is numbered by falling frequency (ties alphabetical; values
    unseen in training get a slot of their own number, which the one-hot code
    drops, so they are all zeros). Numbers and codes form one vector, and each
    slot is divided by its training standard deviation without centring.
    """
    number_of = StringIndexer(inputCols=CATEGORICAL_COLS, outputCols=[f"{c}_number" for c in CATEGORICAL_COLS],
                              stringOrderType="frequencyDesc", handleInvalid="keep")
    slots = OneHotEncoder(inputCols=number_of.getOutputCols(), outputCols=[f"{c}_slots" for c in CATEGORICAL_COLS])
    joined = VectorAssembler(inputCols=[*NUMERIC_COLS, *slots.getOutputCols()], outputCol="unscaled", handleInvalid="keep")
    scaled = StandardScaler(inputCol=joined.getOutputCol(), outputCol="features", withMean=False, withStd=True)
    return Pipeline(stages=[number_of, slots, joined, scaled])


def regression_metrics(pred: DataFrame, group: list[str] | None = None) -> DataFrame:
    """RMSE, MAE and R^2 (1 - SS_res / SS_tot) in one aggregate (per model if grouped).

    SS_tot is n times the population variance, whose merging update is stable
    where the difference of sums of squares is not.
    """
    y, err = F.col(TARGET), F.col("prediction") - F.col(TARGET)
    n = F.count("*")
    return pred.groupBy(*(group or [])).agg(
        n.alias("n_test"), F.sqrt(F.avg(err * err)).alias("rmse"), F.avg(F.abs(err)).alias("mae"),
        (1 - F.try_divide(F.sum(err * err), n * F.var_pop(y))).alias("r2"))


# ------------------------------------------------- deterministic predictors
BASELINES = ("TrainMean", "PastSpend")


def baseline_predictions(split: DataFrame) -> DataFrame:
    """Test rows scored by two fixed rules: the training mean, and the past spend scaled to the training mean.

    Their figures are exact in any engine, so they check the metrics, the run
    log and its search; fitted models are compared against them.
    """
    train = split.filter(F.col("split") == "train")
    m = literal_row(train.agg(F.avg(TARGET).alias("y"), F.avg("monetary").alias("x")))
    rules = {"TrainMean": m["y"], "PastSpend": F.col("monetary") * F.try_divide(m["y"], m["x"])}
    rows = [F.struct(F.lit(name).alias("model"), rule.cast("double").alias("prediction")) for name, rule in rules.items()]
    return split.filter(F.col("split") == "test").select(CUSTOMER, TARGET, F.inline(F.array(*rows)))


def ranked(metrics: DataFrame) -> DataFrame:
    """Models by RMSE (ties: name) with the best one flagged (a window over one row per model)."""
    w = Window.partitionBy().orderBy("rmse", "model")
    return metrics.withColumn("is_best", F.row_number().over(w) == 1).orderBy("rmse", "model")


def residual_stats(pred: DataFrame) -> DataFrame:
    """Residual (actual - predicted) mean / sample std / max / min per model, all test rows."""
    r = F.col(TARGET) - F.col("prediction")
    return pred.groupBy("model").agg(F.count("*").alias("n"), F.avg(r).alias("mean_residual"),
                                     F.stddev_samp(r).alias("std_residual"), F.max(r).alias("max_residual"),
                                     F.min(r).alias("min_residual"))


# ------------------------------------------------------------ training
@dataclass
class Trained:
    prepared: DataFrame            # written: split and features
    predictions: DataFrame         # written: model, customer, target, prediction (test rows)
    pipeline: PipelineModel
    models: dict = field(default_factory=dict)
    fit_seconds: dict = field(default_factory=dict)
    started_at: dict = field(default_factory=dict)


# Partitions of the training vectors: as many as there are cores, more only beyond so many rows each.
ROWS_PER_PARTITION = 500_000


def gathered(train: DataFrame) -> DataFrame:
    """``train`` in few partitions.

    Every pass of a tree fit sends, per partition, a histogram of each open node and feature to be merged (a
    forest has tens of thousands of nodes), and starts a task; both grow with the partitions, not with the rows.
    """
    spark = train.sparkSession
    most = max(spark.sparkContext.defaultParallelism, -(-train.count() // ROWS_PER_PARTITION))
    return train.coalesce(most)


def train_all(gold: DataFrame, models: list[str] | None = None) -> Trained:
    """Trim, split, fit the feature pipeline on train only, fit every model.

    The split rows, the vectors and the predictions are each written once under
    the shared folder (lineage cut, survives executor loss). The iterative fits
    read the training vectors from a cache, which is released at the end.
    """
    spark = gold.sparkSession

    def written(df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    base = written(train_test_split(outlier_trim(gold)), "ml-split")
    pipe = feature_pipeline().fit(base.filter(F.col("split") == "train"))
    prepared = written(pipe.transform(base).select(CUSTOMER, TARGET, "split", "features"), "ml-vectors")
    train, test = (prepared.filter(F.col("split") == x) for x in ("train", "test"))
    train = gathered(train).persist()
    out = Trained(prepared=prepared, predictions=None, pipeline=pipe)
    scored = []
    for name in models or list(MODEL_PARAMS):
        out.started_at[name] = dt.datetime.now(dt.timezone.utc)
        began = time.time()
        out.models[name] = _estimator(name).fit(train)
        out.fit_seconds[name] = time.time() - began
        scored.append(out.models[name].transform(test).select(F.lit(name).alias("model"), CUSTOMER, TARGET, "prediction"))
    train.unpersist()
    out.predictions = written(reduce(DataFrame.unionByName, scored), "ml-predictions")
    return out


def fit_times(trained: Trained) -> DataFrame:
    spark = trained.prepared.sparkSession
    rows = [(k, float(v)) for k, v in trained.fit_seconds.items()]
    return spark.createDataFrame(rows, "model string, fit_seconds double")


def model_metrics(trained: Trained) -> DataFrame:
    """Metrics per model with fit time (five rows at most: broadcast is bounded)."""
    m = regression_metrics(trained.predictions, ["model"])
    return m.join(F.broadcast(fit_times(trained)), "model", "left")


def leaderboard(trained: Trained) -> DataFrame:
    """Models by RMSE (ties: name), with rank and the best model flagged."""
    return ranked(model_metrics(trained).select("model", "rmse", "mae", "r2", "fit_seconds"))


def slot_names(pipeline: PipelineModel) -> list[str]:
    """The name of every slot of ``features``: the numeric columns, then ``column=value`` for every category."""
    indexer = pipeline.stages[0]
    return [*NUMERIC_COLS, *[f"{c}={v}" for c, labels in zip(CATEGORICAL_COLS, indexer.labelsArray) for v in labels]]


def saved_importance(spark, path: str, model: str, pipeline: PipelineModel) -> DataFrame:
    """M17 of a saved tree ensemble, from its nodes: (feature, importance); the slots of a category add up."""
    names = [n.split("=", 1)[0] for n in slot_names(pipeline)]
    return fits.importance(fits.tree_nodes(spark, path), names, per_tree=model == "RandomForest")


def feature_importance(trained: Trained) -> DataFrame:
    """Tree-model importances by column (category slots summed), rank per model, read from the saved models' nodes."""
    spark = trained.prepared.sparkSession
    parts = []
    for name in ("RandomForest", "GBT"):
        if name in trained.models:
            path = scratch_path(spark, f"model-{uuid.uuid4().hex}")
            save_model(trained.models[name], path)
            parts.append(saved_importance(spark, path, name, trained.pipeline).select(F.lit(name).alias("model"), "feature", "importance"))
    df = reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], "model string, feature string, importance double")
    w = Window.partitionBy("model").orderBy(F.col("importance").desc(), "feature")
    return df.withColumn("rank", F.row_number().over(w)).withColumn("top3", F.col("rank") <= 3)


# both solvers penalise standardised columns, and a target divided by its deviation
LINEAR_MODELS = ("LinearRegression", "GeneralizedLinear")


def linear_residuals(trained: Trained) -> DataFrame:
    """The first-order condition of the fitted linear models on the training rows, a row per model and slot.

    ``with_target`` is the slot's covariance with the target, ``gap`` that with the residual less the
    penalty's pull, and ``solve_gap`` the difference of the coefficient from the one that follows
    from the training rows' Gram matrix, relative to its size.
    """
    train = trained.prepared.filter(F.col("split") == "train")
    names = slot_names(trained.pipeline)
    x = vector_to_array("features")
    flat = train.select(TARGET, *[x[i].alias(f"x{i}") for i in range(len(NUMERIC_COLS))],
                        F.coalesce(*[F.when(x[i] != 0, F.lit(i)) for i in range(len(NUMERIC_COLS), len(names))], F.lit(-1)).cast("string").alias("slot"))
    columns = [f"x{i}" for i in range(len(NUMERIC_COLS))]
    moments = fits.cross_moments(flat, columns, "slot", TARGET)
    slots = [*columns, *[f"slot={i}" for i in range(len(NUMERIC_COLS), len(names))]]
    # a slot's column holds 1 / deviation instead of 1: its products are scaled accordingly
    size = literal_row(train.agg(*[F.max(x[i]).alias(f"s{i}") for i in range(len(NUMERIC_COLS), len(names))]))
    scale = F.lit(1.0)
    for i in range(len(NUMERIC_COLS), len(names)):
        scale = F.when(F.col("name") == f"slot={i}", size[f"s{i}"]).otherwise(scale)
    for side in ("a", "b"):
        moments = moments.withColumn("name", F.col(side)).withColumn("value", F.col("value") * scale).drop("name")
    parts = []
    spark = trained.prepared.sparkSession
    for model in LINEAR_MODELS:
        if model not in trained.models:
            continue
        fitted = trained.models[model]
        weights = [float(v) for v in fitted.coefficients]
        penalty = MODEL_PARAMS[model]["regParam"]
        told = fits.residual_moments(fitted.transform(train), TARGET, names, weights, penalty, scaled=True)
        solved = fits.ridge(moments, slots, TARGET, penalty, scaled=True)
        pairs = [("1", float(fitted.intercept), solved["1"]), *[(n, w, solved[s]) for n, s, w in zip(names, slots, weights)]]
        gaps = [(n, (w - v) / (1 + abs(w))) for n, w, v in pairs]
        solve = F.broadcast(spark.createDataFrame(gaps, "feature string, solve_gap double"))  # one row per slot
        parts.append(told.join(solve, "feature").select(F.lit(model).alias("model"), "feature", "with_target", "gap", "solve_gap"))
    return reduce(DataFrame.unionByName, parts)


def features_frame(trained: Trained) -> DataFrame:
    """M8 output: scaled feature vectors as arrays, per customer and split."""
    return trained.prepared.select(CUSTOMER, "split", TARGET, vector_to_array("features").alias("features"))


def run_records(trained: Trained, metrics_rows: list) -> list[dict]:
    """K5 rows for the run log: one per model, and one with the tree models' feature importances."""
    by = {r["model"]: r for r in metrics_rows}
    runs = [{"experiment": EXPERIMENT, "run_name": name, "model_type": name,
             "started_at": trained.started_at.get(name), "params": MODEL_PARAMS[name],
             "metrics": {"rmse": by[name]["rmse"], "mae": by[name]["mae"], "r2": by[name]["r2"],
                         "training_time_seconds": trained.fit_seconds[name]}}
            for name in trained.models if name in by]
    prefix = {"RandomForest": "rf", "GBT": "gbt"}
    # at most a row per tree model and input
    weights = {f"{prefix[r['model']]}_importance_{r['feature']}": r["importance"] for r in feature_importance(trained).collect()}
    if weights:
        runs.append({"experiment": EXPERIMENT, "run_name": "FeatureImportance", "model_type": "FeatureImportance",
                     "started_at": dt.datetime.now(dt.timezone.utc), "params": {}, "metrics": weights})
    return runs


def baseline_records(metrics_rows: list) -> list[dict]:
    """K5 rows of the deterministic predictors."""
    return [{"experiment": f"{EXPERIMENT}-baselines", "run_name": r["model"], "model_type": r["model"],
             "started_at": dt.datetime.now(dt.timezone.utc), "params": {"train_share": TRAIN_SHARE, "seed": SEED},
             "metrics": {k: r[k] for k in ("rmse", "mae", "r2")}} for r in metrics_rows]


def save_model(model, path: str) -> None:
    """K6: persist a fitted model (or pipeline)."""
    model.write().overwrite().save(path)
