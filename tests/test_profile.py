"""Profiles, quantiles and reports on literal rows and on the small fixture."""

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from tillflow.operators import profile, reports


def _q(spark, values, probs):
    df = spark.createDataFrame([(float(v),) for v in values], "x double") if values else \
        spark.createDataFrame([], "x double")
    r = profile.exact_quantiles(df, "x", probs, [f"p{i}" for i in range(len(probs))]).collect()[0]
    return [r[f"p{i}"] for i in range(len(probs))]


@pytest.mark.parametrize("values", [
    [1, 2, 3, 4], [5], [0, 0, 0, 1e9], [-3.5, -1, 0, 2, 2, 2, 7.25], list(range(1000)),
    [1e-300, 1e300, -1e-300, 0.0], [7.0] * 50 + [1.0],
])
def test_exact_quantiles_match_numpy(spark, values):
    probs = [0.0, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = _q(spark, values, probs)
    want = np.quantile(np.array(values, dtype=float), probs)
    assert np.allclose(got, want, rtol=1e-12, atol=0)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(-50, 50), min_size=1, max_size=60))
def test_exact_quantiles_property(spark, values):
    got = _q(spark, values, [0.1, 0.5, 0.9])
    assert np.allclose(got, np.quantile(np.array(values, dtype=float), [0.1, 0.5, 0.9]))


def test_empty_quantiles_are_null(spark):
    assert _q(spark, [], [0.5]) == [None]


def test_constant_column_correlation_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0), (1.0, 5.0)], "a double, b double")
    r = {(x["feature_a"], x["feature_b"]): x["corr"] for x in profile.correlation_matrix(df, ["a", "b"]).collect()}
    assert r[("a", "b")] is None and r[("b", "b")] == pytest.approx(1.0)
    assert len(r) == 4


def test_histogram_counts_sum_to_rows_and_last_bin_closed(spark):
    vals = [0.0, 1.0, 2.5, 10.0, 10.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    h = profile.histograms(df, {"x": 5}).orderBy("bin").collect()
    assert len(h) == 5 and sum(r["count"] for r in h) == len(vals)
    assert h[-1]["count"] == 2
    counts, _ = np.histogram(vals, bins=5)
    assert [r["count"] for r in h] == list(counts)


def test_skewness_matches_pandas(spark):
    import pandas as pd
    vals = [1.0, 2.0, 2.0, 3.0, 10.0, 40.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = profile.skew_summary(df, "x").collect()[0]["skewness"]
    assert got == pytest.approx(pd.Series(vals).skew())


def test_home_country_absent_share_zero(spark):
    df = spark.createDataFrame([("A", 1.0), ("B", 2.0)], "country string, total_price double")
    r = reports.home_vs_others(df, "HOME").collect()[0]
    assert r["home_rows"] == 0 and r["home_sales_pct"] == 0.0 and r["other_sales"] == 3.0


def test_single_and_multi_histogram_agree(spark):
    vals = [3.0, 3.5, 7.25, 9.0, 12.0, 12.0, -1.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    one = [(r["bin"], r["count"]) for r in profile.histogram(df, "x", 4).orderBy("bin").collect()]
    many = [(r["bin"], r["count"]) for r in profile.histograms(df, {"x": 4}).orderBy("bin").collect()]
    assert one == many
    counts, _ = np.histogram(vals, bins=4)
    assert [c for _, c in one] == list(counts)
    const = spark.createDataFrame([(5.0,), (5.0,)], "x double")
    assert sum(r["count"] for r in profile.histogram(const, "x", 3).collect()) == 2


def test_exact_quantiles_crowded_band(spark):
    # many distinct values inside one 0.3 % band of magnitude (one coarse bucket)
    vals = [100.0 + i * 1e-7 for i in range(3000)] + [-5.0, 0.0, 1e6]
    got = _q(spark, vals, [0.01, 0.5, 0.9, 0.999])
    want = np.quantile(np.array(vals), [0.01, 0.5, 0.9, 0.999])
    assert np.allclose(got, want, rtol=1e-13, atol=0)


def test_grouped_quantiles(spark):
    rows = [("a", float(i)) for i in range(11)] + [("b", float(i * i)) for i in range(7)] + [("c", None)]
    df = spark.createDataFrame(rows, "k string, x double")
    got = {r["k"]: r["m"] for r in profile.exact_quantiles(df, "x", [0.5], ["m"], groups=["k"]).collect()}
    assert got == {"a": 5.0, "b": 9.0}


def test_infinities_are_end_values(spark):
    inf = float("inf")
    assert _q(spark, [1, 2, 3, inf], [0.0, 0.5, 1.0]) == [1.0, 2.5, inf]
    assert _q(spark, [-inf, -inf, 5, inf], [0.0, 0.25, 1.0]) == [-inf, -inf, inf]
    assert _q(spark, [float("nan"), 4.0], [0.5]) == [4.0]


def test_correlation_uses_rows_with_both_values(spark):
    rows = [(1.0, 2.0, 9), (2.0, 4.0, 7), (3.0, 6.0, None), (4.0, 8.0, 1), (None, 100.0, 4)]
    df = spark.createDataFrame(rows, "a double, b double, c int")
    r = {(x["feature_a"], x["feature_b"]): x["corr"] for x in profile.correlation_matrix(df, ["a", "b", "c"]).collect()}
    import pandas as pd
    want = pd.DataFrame(rows, columns=["a", "b", "c"]).astype(float).corr()
    for (x, y), v in r.items():
        assert v == pytest.approx(want.loc[x, y]), (x, y)
    assert r["a", "b"] == pytest.approx(1.0) and r["a", "a"] == 1.0
    target = profile.target_correlation(df, ["a", "b", "c"], "c").collect()
    assert [t["feature"] for t in target] == sorted(["a", "b"], key=lambda f: -want.loc[f, "c"])


def test_quantile_plan_ranks_only_wanted_buckets(spark):
    """The windows over values sit above the join with the wanted buckets."""
    df = spark.range(1000).selectExpr("cast(id as double) as x")
    plan = profile.exact_quantiles(df, "x", [0.5], ["m"])._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert any("_b" in w for w in windows) and "Join Inner" in plan
