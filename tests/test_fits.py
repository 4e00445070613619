"""Fitted models against tables computed from their training rows."""

import os
import random
import tempfile

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressionModel, GBTRegressor, RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import functions as F

from tillflow.functions import literal_row
from tillflow.operators import fits, ml

COLUMNS = ["a", "b", "c"]


def rows_of(n, seed=1):
    rnd = random.Random(seed)
    out = []
    for _ in range(n):
        a, b, c = rnd.randrange(12), rnd.randrange(20) - 10, rnd.choice([0, 1])
        out.append((float(a), float(b), float(c), rnd.choice("xyz"), 30.0 * (a > 6) + 4.0 * b + rnd.gauss(0, 3)))
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, "a double, b double, c double, kind string, y double")


def midpoints(spark, df):
    rows = []
    for c in COLUMNS:
        v = sorted({r[0] for r in df.select(c).collect() if r[0] is not None})
        rows.append((c, [(x + y) / 2 for x, y in zip(v, v[1:])]))
    return spark.createDataFrame(rows, "feature string, thresholds array<double>")


def brute_gain(rows, right):
    y = np.array([r[4] for r in rows])
    sides = [y[~right], y[right]]
    return y.var() - sum(len(s) * s.var() for s in sides if len(s)) / len(y)


def test_a_stump_splits_at_the_best_row(spark):
    for seed in (1, 2, 3):
        rows = rows_of(300, seed)
        df = frame(spark, rows)
        table = fits.split_gains(df, COLUMNS, "y", midpoints(spark, df)).collect()
        best = max(table, key=lambda r: r["gain"])
        vectors = VectorAssembler(inputCols=COLUMNS, outputCol="features").transform(df)
        model = DecisionTreeRegressor(maxDepth=1, maxBins=64, labelCol="y").fit(vectors)
        path = os.path.join(tempfile.mkdtemp(prefix="tillflow-stump-"), "m")
        ml.save_model(model, path)
        root = fits.tree_nodes(spark, path).filter("node = 0").collect()[0]
        assert COLUMNS[root["feature_index"]] == best["feature"] and root["threshold"] == pytest.approx(best["threshold"])
        assert root["gain"] == pytest.approx(best["gain"], rel=1e-9) and root["row_count"] == best["n_left"] + best["n_right"]


def test_gains_equal_brute_force(spark):
    rows = rows_of(200, 5)
    table = {(r["feature"], r["threshold"]): r for r in
             fits.split_gains(frame(spark, rows), COLUMNS, "y", fits.quantile_thresholds(frame(spark, rows), COLUMNS, 8), ["kind"]).collect()}
    assert {f for f, _ in table} == {*COLUMNS, "kind=x", "kind=y", "kind=z"}
    for (feature, threshold), r in table.items():
        right = np.array([x[3] == feature[-1] if "=" in feature else x[COLUMNS.index(feature)] > threshold for x in rows])
        assert (r["n_left"], r["n_right"]) == ((~right).sum(), right.sum())
        assert r["gain"] == pytest.approx(brute_gain(rows, right), abs=1e-9)
        y = np.array([x[4] for x in rows])
        assert r["mean_left"] == (pytest.approx(y[~right].mean()) if (~right).any() else None)
        assert r["gain_share"] == pytest.approx(r["gain"] / y.var())


def test_gains_with_nulls_a_constant_and_no_rows(spark):
    rows = [(1.0, None, 5.0, None, 2.0), (2.0, None, 5.0, "x", 4.0), (3.0, 7.0, 5.0, "x", None), (None, None, None, None, 6.0)]
    table = fits.split_gains(frame(spark, rows), COLUMNS, "y", fits.quantile_thresholds(frame(spark, rows), COLUMNS, 4), ["kind"]).collect()
    by = {}
    for r in table:
        by.setdefault(r["feature"], []).append(r)
    assert all(r["n_left"] + r["n_right"] == 2 for r in by["a"]) and "b" not in by        # b has no row with a target
    assert [(r["threshold"], r["n_left"], r["n_right"], r["gain"]) for r in by["c"]] == [(5.0, 2, 0, 0.0)]
    assert [(r["n_left"], r["n_right"]) for r in by["kind=x"]] == [(2, 1)]
    empty = frame(spark, [])
    assert fits.split_gains(empty, COLUMNS, "y", fits.quantile_thresholds(empty, COLUMNS, 4), ["kind"]).collect() == []


def test_cross_moments_and_ridge(spark):
    rows = rows_of(250, 7)
    df = frame(spark, rows)
    moments = fits.cross_moments(df, COLUMNS, "kind", "y")
    got = {(r["a"], r["b"]): r["value"] for r in moments.collect()}
    names = ["1", *COLUMNS, *[f"kind={k}" for k in "xyz"], "y"]
    x = np.array([[1, r[0], r[1], r[2], *[float(r[3] == k) for k in "xyz"], r[4]] for r in rows])
    gram = x.T @ x / len(x)
    for i, a in enumerate(names):
        for j, b in enumerate(names):
            assert got.get((a, b), 0.0) == pytest.approx(gram[i, j], abs=1e-9)
    assert len(got) == len(names) ** 2 - 6                                                # two slots of one column never meet
    features = names[1:-1]
    for scaled in (True, False):
        solved = fits.ridge(moments, features, "y", 0.5, scaled)
        z, y = x[:, 1:-1], x[:, -1]
        cz, cy = z - z.mean(axis=0), y - y.mean()
        beta = np.array([solved[f] for f in features])
        pull = 0.5 * beta * (cz.var(axis=0) / y.std() if scaled else 1.0)
        assert np.allclose(cz.T @ (cy - cz @ beta) / len(y), pull, atol=1e-8)
        assert solved["1"] == pytest.approx(y.mean() - z.mean(axis=0) @ beta)


def test_importance_from_a_reloaded_model(spark):
    df = VectorAssembler(inputCols=COLUMNS, outputCol="features").transform(frame(spark, rows_of(300, 9)))
    root = tempfile.mkdtemp(prefix="tillflow-trees-")
    for name, est, cls in (("forest", RandomForestRegressor(labelCol="y", numTrees=7, seed=3), RandomForestRegressionModel),
                           ("boosted", GBTRegressor(labelCol="y", maxIter=6, seed=3), GBTRegressionModel)):
        path = os.path.join(root, name)
        ml.save_model(est.fit(df), path)
        loaded = cls.load(path)
        got = {r["feature"]: r["importance"] for r in fits.importance(fits.tree_nodes(spark, path), COLUMNS, name == "forest").collect()}
        assert all(abs(got[c] - v) < 1e-9 for c, v in zip(COLUMNS, loaded.featureImportances.toArray()))
        summed = {r["feature"]: r["importance"] for r in fits.importance(fits.tree_nodes(spark, path), ["p", "q", "p"], name == "forest").collect()}
        assert summed["p"] == pytest.approx(got["a"] + got["c"])
        assert fits.tree_nodes(spark, path).select("tree").distinct().count() == loaded.getNumTrees


def test_sketches_merge_within_their_bound(spark):
    df = spark.range(200000).select((F.pow(F.rand(5), 4) * 1e6).alias("v"), (F.col("id") % 3).alias("part"), F.when(F.col("id") % 3 == 0, 7.0).alias("w"))
    df = df.withColumn("v", F.when(F.col("part") == 1, 12.5).otherwise(F.col("v")))        # one value holds a third of the rows
    df.write.parquet(path := os.path.join(tempfile.mkdtemp(prefix="tillflow-sketch-"), "t"))
    df = spark.read.parquet(path)
    parts = fits.quantile_sketch(df, ["v", "w"], ["part"])
    whole = fits.merged_sketch(parts)
    for q in (0.01, 0.25, 0.5, 0.75, 0.99):
        for column in ("v", "w"):
            bound = literal_row(whole.filter(F.col("column_name") == column).select(fits.sketched_quantile(q).alias("b")))["b"]
            assert fits.rank_check(df, column, bound, q, 0.01).collect()[0]["within"]
    ends = whole.filter("column_name = 'v'").collect()[0]
    assert (ends["least"], ends["most"]) == tuple(df.agg(F.min("v"), F.max("v")).first())
    assert len(ends["sketch"]) < 100_000
    assert fits.quantile_sketch(df.filter("false"), ["v"]).collect() == []


def test_approximate_trim_is_within_one_percent(spark):
    df = spark.range(5000).select(F.col("id").alias("kullanici_ID"), (F.col("id") + 1.0).alias(ml.TARGET), (5000.0 - F.col("id")).alias("monetary"))
    kept = ml.outlier_trim(df, exact=False, trim_monetary=False).count()
    assert abs(kept - 4950) <= 50
    both = ml.outlier_trim(df, exact=False).count()
    assert abs(both - 4900) <= 100
    assert ml.outlier_trim(df.filter("false"), exact=False).count() == 0
