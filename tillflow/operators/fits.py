"""What a fitted model must agree with, computed from the rows it was fitted on.

* ``split_gains``: the table a regression tree chooses its root from.
* ``cross_moments`` / ``ridge``: the Gram matrix of the features, and the linear
  model that follows from it.
* ``residual_moments``: the first-order condition of a fitted linear model.
* ``tree_nodes`` / ``importance``: a saved tree ensemble as a table.
* ``quantile_sketch``: mergeable quantile sketches with a bound on the rank.

All of them are aggregates with map-side combination; what reaches the driver is as
large as the number of features (squared for ``ridge``), whatever the rows.
"""

from __future__ import annotations

import os

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillflow.functions import literal_row
from tillflow.operators.profile import exact_quantiles

# ------------------------------------------------------------------ split gains


def unpivoted(rows: DataFrame, features: list[str], *keep: Column) -> DataFrame:
    """One row per row and feature: ``feature, value`` (double) and ``keep``."""
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in features])
    return rows.select(*keep, F.inline(cells))


def quantile_thresholds(rows: DataFrame, features: list[str], bins: int = 16) -> DataFrame:
    """``(feature, thresholds)``: the distinct inner quantiles of each feature, ascending, at most ``bins - 1``."""
    probs = [k / bins for k in range(1, bins)]
    names = [f"t{k}" for k in range(1, bins)]
    got = exact_quantiles(unpivoted(rows, features), "value", probs, names, groups=["feature"])
    return got.select("feature", F.array_sort(F.array_distinct(F.array(*names))).alias("thresholds"))


def split_gains(rows: DataFrame, features: list[str], target: str, thresholds: DataFrame, categories: list[str] | None = None) -> DataFrame:
    """The variance gain of every candidate split of ``rows``: what a regression tree's root chooses from.

    ``thresholds`` ``(feature, thresholds)`` holds at most a row per numeric column of ``features``; a row goes left if its value is at
    most the threshold. A category column gives a split for each of its values
    (that value goes right). Every row adds (count, sum, sum of squares) of its centred target
    to one bin per feature: one exchange of at most features x bins rows per task. Running sums over a
    feature's bins give the left sides, the totals less those the right ones. Null values and null targets
    take no part. Returns ``feature, threshold, n_left, n_right, mean_left, mean_right, gain, gain_share``
    (``gain``: the variance less the weighted variances of both sides; a side may be empty, its mean is then null).
    """
    known = rows.filter(F.col(target).isNotNull())
    total = literal_row(known.agg(F.count("*").alias("n"), F.avg(target).alias("mean"), F.var_pop(target).alias("var")))
    y = (F.col(target) - total["mean"]).alias("y")
    # a row per feature: a proven bound for the broadcasts
    cuts = F.broadcast(thresholds)
    binned = (unpivoted(known, features, y).filter(F.col("value").isNotNull()).join(cuts, "feature")
              .select("feature", F.size(F.filter("thresholds", lambda t: t < F.col("value"))).alias("bin"), "y"))
    for c in categories or []:
        binned = binned.unionByName(known.filter(F.col(c).isNotNull()).select(F.concat(F.lit(f"{c}="), F.col(c)).alias("feature"), F.lit(-1).alias("bin"), y))
    cells = binned.groupBy("feature", "bin").agg(F.count("*").alias("n"), F.sum("y").alias("s"), F.sum(F.col("y") * F.col("y")).alias("ss"))

    axis = thresholds.select("feature", F.posexplode(F.concat("thresholds", F.array(F.lit(None).cast("double")))).alias("bin", "threshold"))
    of_feature = Window.partitionBy("feature")
    upto = of_feature.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    zero = [F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("n", "s", "ss")]
    filled = axis.join(cells.filter("bin >= 0"), ["feature", "bin"], "left").select("feature", "threshold", "bin", *zero)
    ordered = filled.select("feature", "threshold", *[F.sum(c).over(upto).alias(f"{c}_l") for c in ("n", "s", "ss")],
                            *[F.sum(c).over(of_feature).alias(c) for c in ("n", "s", "ss")])
    splits = ordered.filter(F.col("threshold").isNotNull()).select(
        "feature", "threshold", "n_l", "s_l", "ss_l", *[(F.col(c) - F.col(f"{c}_l")).alias(f"{c}_r") for c in ("n", "s", "ss")])
    if categories:
        whole = {"n": total["n"], "s": F.lit(0.0), "ss": total["n"] * total["var"]}
        own = cells.filter("bin < 0").select("feature", F.lit(0.5).alias("threshold"), *[(whole[c] - F.col(c)).alias(f"{c}_l") for c in whole],
                                             *[F.col(c).alias(f"{c}_r") for c in whole])
        splits = splits.unionByName(own)

    n = F.col("n_l") + F.col("n_r")
    inner = lambda side: F.col(f"ss_{side}") - F.coalesce(F.try_divide(F.col(f"s_{side}") * F.col(f"s_{side}"), F.col(f"n_{side}")), F.lit(0.0))
    spread = F.col("ss_l") + F.col("ss_r") - (F.col("s_l") + F.col("s_r")) * (F.col("s_l") + F.col("s_r")) / n
    gain = (spread - inner("l") - inner("r")) / n
    mean = lambda side: total["mean"] + F.try_divide(F.col(f"s_{side}"), F.col(f"n_{side}"))
    return splits.filter(n > 0).select("feature", "threshold", F.col("n_l").cast("long").alias("n_left"), F.col("n_r").cast("long").alias("n_right"),
                                       mean("l").alias("mean_left"), mean("r").alias("mean_right"), gain.alias("gain"),
                                       F.try_divide(gain, spread / n).alias("gain_share"))


# ------------------------------------------------------------------ linear models

def cross_moments(rows: DataFrame, numeric: list[str], category: str, target: str) -> DataFrame:
    """The Gram matrix of (1, numbers, one slot per category, target), divided by n, in long form ``(a, b, value)``.

    One grouping by category sums the products of the numbers; a slot's products are
    its category's sums and the whole matrix the sum over categories, so
    the category's one-hot columns are never formed. Both triangles are returned; slots are named
    ``column=value``, the constant ``1``. Rows with a null category have no slot; rows with a null number or target take no part.
    """
    names = ["1", *numeric, target]
    cell = {"1": F.lit(1.0), **{c: F.col(c).cast("double") for c in (*numeric, target)}}
    whole = rows.dropna(subset=[*numeric, target])
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i:]]
    sums = whole.groupBy(category).agg(*[F.sum(cell[a] * cell[b]).alias(f"m{i}") for i, (a, b) in enumerate(pairs)])
    both = F.array(*[F.struct(F.lit(x).alias("a"), F.lit(y).alias("b"), F.col(f"m{i}").alias("value"))
                     for i, (a, b) in enumerate(pairs) for x, y in ({(a, b), (b, a)})])
    dense = sums.select(category, F.inline(both))
    numbers = dense.groupBy("a", "b").agg(F.sum("value").alias("value"))
    slot = F.concat(F.lit(f"{category}="), F.col(category))
    of_slot = dense.filter(F.col(category).isNotNull() & (F.col("a") == "1"))
    crossed = of_slot.select(F.explode(F.array(F.struct(slot.alias("a"), F.col("b").alias("b")), F.struct(F.col("b").alias("a"), slot.alias("b")))).alias("x"), "value") \
                     .select("x.*", "value")
    own = of_slot.filter(F.col("b") == "1").select(slot.alias("a"), slot.alias("b"), "value")
    n = literal_row(numbers.filter("a = '1' and b = '1'").select(F.max("value").alias("n")))["n"]
    return numbers.unionByName(crossed).unionByName(own).select("a", "b", F.try_divide(F.col("value"), n).alias("value"))


def ridge(moments: DataFrame, features: list[str], target: str, penalty: float, scaled: bool) -> dict[str, float]:
    """Coefficients (and the intercept ``1``) of the penalised least-squares fit that follows from ``cross_moments``.

    The k x k system of the centred moments is solved on the driver. With ``scaled`` the penalty applies to
    standardised features and target (divided by the target's deviation), otherwise to the features as they are.
    """
    import numpy as np

    at = {x: i for i, x in enumerate(["1", *features, target])}
    m = np.zeros((len(at), len(at)))
    for r in moments.collect():  # (features + 2)^2 rows
        if r["a"] in at and r["b"] in at:
            m[at[r["a"]], at[r["b"]]] = r["value"]
    mean = m[0]
    cov = m - np.outer(mean, mean)
    k = len(features)
    x, xy = cov[1:k + 1, 1:k + 1], cov[1:k + 1, k + 1]
    weight = np.diag(x) / np.sqrt(cov[k + 1, k + 1]) if scaled else np.ones(k)
    beta = np.linalg.lstsq(x + penalty * np.diag(weight), xy, rcond=None)[0]
    return {"1": float(mean[k + 1] - mean[1:k + 1] @ beta), **{f: float(b) for f, b in zip(features, beta)}}


def residual_moments(scored: DataFrame, target: str, names: list[str], coefficients: list[float], penalty: float, scaled: bool) -> DataFrame:
    """A linear model's first-order condition on its training rows: ``(feature, covariance, shrinkage, gap)``.

    At the optimum the covariance of a feature with the residual equals the penalty's pull on
    its coefficient: ``penalty * b``, times ``var(x) / sd(y)`` where the library penalises standardised columns.
    ``scored`` holds ``features`` (a vector), the target and ``prediction``; a row for the intercept
    (``1``) holds the mean residual. One aggregate.
    """
    x = vector_to_array("features")
    flat = scored.select(x.alias("x"), F.col(target).alias("y"), (F.col(target) - F.col("prediction")).alias("r"))
    aggs = [F.avg("r").alias("r"), F.stddev_pop("y").alias("sd")]
    for i in range(len(names)):
        aggs += [F.covar_pop(F.col("x")[i], F.col("r")).alias(f"c{i}"), F.var_pop(F.col("x")[i]).alias(f"v{i}"), F.covar_pop(F.col("x")[i], F.col("y")).alias(f"y{i}")]
    row = flat.agg(*aggs)

    def pull(i: int, b: float) -> Column:
        return F.lit(penalty * b) * (F.col(f"v{i}") / F.col("sd") if scaled else F.lit(1.0))

    none = F.lit(0.0)
    cells = [F.struct(F.lit("1").alias("feature"), none.alias("with_target"), F.col("r").alias("covariance"), none.alias("shrinkage"))]
    cells += [F.struct(F.lit(f).alias("feature"), F.col(f"y{i}").alias("with_target"), F.col(f"c{i}").alias("covariance"), pull(i, b).alias("shrinkage"))
              for i, (f, b) in enumerate(zip(names, coefficients))]
    return row.select(F.inline(F.array(*cells))).withColumn("gap", F.col("covariance") - F.col("shrinkage"))


# ------------------------------------------------------------------ tree ensembles

def tree_nodes(spark: SparkSession, path: str) -> DataFrame:
    """The nodes of a saved tree or ensemble: ``tree, node, feature_index, threshold, gain, impurity, row_count, prediction, left, right``.

    Leaves have a null feature and gain. ``row_count`` is the weight of the training
    rows at the node (in a forest, of the tree's bootstrap sample).
    """
    data = spark.read.parquet(os.path.join(path, "data"))
    if "nodeData" in data.columns:
        data = data.select(F.col("treeID").cast("int").alias("tree"), "nodeData.*")
    else:
        data = data.withColumn("tree", F.lit(0))
    inner = F.col("leftChild") >= 0
    return data.select("tree", F.col("id").alias("node"), F.when(inner, F.col("split.featureIndex")).alias("feature_index"),
                       F.when(inner, F.get("split.leftCategoriesOrThreshold", F.lit(0))).alias("threshold"),
                       F.when(inner, F.col("gain")).alias("gain"), "impurity", F.get("impurityStats", F.lit(0)).alias("row_count"), "prediction",
                       F.when(inner, F.col("leftChild")).alias("left"), F.when(inner, F.col("rightChild")).alias("right"))


def importance(nodes: DataFrame, names: list[str], per_tree: bool) -> DataFrame:
    """``(feature, importance)`` from ``tree_nodes``: gain times rows, summed per feature and normalised to one.

    ``per_tree`` first brings each tree's sums to one, as forests do (boosted trees weigh their trees by
    their gains). Features without a split have importance 0; ``names`` maps a vector slot to its name, and slots of one name add up.
    """
    gains = nodes.filter(F.col("gain").isNotNull()).groupBy("tree", "feature_index").agg(F.sum(F.col("gain") * F.col("row_count")).alias("g"))
    if per_tree:
        gains = gains.withColumn("g", F.try_divide(F.col("g"), F.sum("g").over(Window.partitionBy("tree"))))
    slots = gains.groupBy("feature_index").agg(F.sum("g").alias("g"))
    # one row per vector slot
    axis = F.broadcast(nodes.sparkSession.createDataFrame(list(enumerate(names)), "feature_index int, feature string"))
    by_name = axis.join(slots, "feature_index", "left").groupBy("feature").agg(F.sum(F.coalesce("g", F.lit(0.0))).alias("g"))
    total = literal_row(by_name.agg(F.sum("g").alias("g")))["g"]
    return by_name.select("feature", F.coalesce(F.try_divide(F.col("g"), total), F.lit(0.0)).alias("importance"))


# ------------------------------------------------------------------ quantile sketches

SKETCH_K = 1000  # a normalised rank error of about 0.35 % for one sketch, however many are merged


def quantile_sketch(rows: DataFrame, columns: list[str], groups: list[str] | None = None) -> DataFrame:
    """``(*groups, column_name, sketch, least, most)``: a KLL sketch of each column, as a value that can be stored.

    A sketch holds some thousand values whatever the rows, and sketches of parts (days, files, countries)
    merge into one of the whole with the same bound. Nulls and NaN take no part.
    """
    cells = unpivoted(rows, columns, *[F.col(g) for g in groups or []]).filter(F.col("value").isNotNull() & ~F.isnan("value"))
    return cells.groupBy(*(groups or []), F.col("feature").alias("column_name")).agg(
        F.kll_sketch_agg_double("value", SKETCH_K).alias("sketch"), F.min("value").alias("least"), F.max("value").alias("most"))


def merged_sketch(sketches: DataFrame) -> DataFrame:
    """One sketch per column from the sketches of its parts."""
    return sketches.groupBy("column_name").agg(F.kll_merge_agg_double("sketch", SKETCH_K).alias("sketch"),
                                               F.min("least").alias("least"), F.max("most").alias("most"))


def sketched_quantile(q: float) -> Column:
    """The quantile of a row's ``sketch``: a value of the column whose rank lies within the sketch's error of q n."""
    return F.kll_sketch_get_quantile_double("sketch", F.lit(q))


def rank_check(rows: DataFrame, column: str, bound: Column, q: float, error: float) -> DataFrame:
    """``(column_name, n, below, up_to, within)``: how many rows lie below and up to ``bound``, and whether q n lies within ``error`` n of these ranks."""
    c = F.col(column)
    flags = rows.filter(c.isNotNull()).select((c < bound).alias("lt"), (c <= bound).alias("le"))
    got = flags.agg(F.count("*").alias("n"), F.count_if("lt").alias("below"), F.count_if("le").alias("up_to"))
    want, slack = F.col("n") * q, F.col("n") * error
    return got.select(F.lit(column).alias("column_name"), "n", "below", "up_to", ((F.col("below") <= want + slack) & (F.col("up_to") >= want - slack)).alias("within"))
