"""Data-quality profiles and descriptive statistics.

Each profile is one scan with many aggregates, reshaped with ``inline`` of an
array of structs; none pulls rows to the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillflow.functions import bias_corrected_skew, literal_row, pct


# --------------------------------------------------------------- quantiles
# Buckets per doubling of magnitude in the order-preserving value key, and
# sub-buckets inside one bucket.
KEY_STEPS_PER_OCTAVE = 256
SUB_STEPS = 1 << 20
_KEY_SHIFT = 1_000_000  # > 256 * 2098 (the binary exponent range of a double)


def _log_steps(v: Column) -> Column:
    return F.log2(F.abs(v)) * KEY_STEPS_PER_OCTAVE


def order_key(v: Column) -> Column:
    """A coarse bucket id that is monotone in ``v``: sign and ``floor(256 * log2|v|)``.

    Each bucket spans about 0.3 % of relative magnitude; there are at most
    about 1.07 million non-empty buckets whatever the data size.
    """
    mag = F.floor(_log_steps(v))
    return (F.when(v == float("inf"), F.lit(2 * _KEY_SHIFT)).when(v == float("-inf"), F.lit(-2 * _KEY_SHIFT))
             .when(v > 0, F.lit(_KEY_SHIFT) + mag)
             .when(v < 0, F.lit(-_KEY_SHIFT) - mag)
             .otherwise(F.lit(0))).cast("long")


def sub_key(v: Column) -> Column:
    """A finer id inside an ``order_key`` bucket (the next 20 bits of ``log2|v|``), monotone in ``v``.

    ``log`` is semi-monotonic, so both keys never invert the order of values.
    """
    frac = _log_steps(v) - F.floor(_log_steps(v))
    step = F.least(F.floor(frac * SUB_STEPS), F.lit(SUB_STEPS - 1))
    return (F.when(F.abs(v) == float("inf"), F.lit(0)).when(v > 0, step).when(v < 0, F.lit(SUB_STEPS - 1) - step).otherwise(F.lit(0))).cast("long")


def exact_quantiles(df: DataFrame, column: str | Column, probs: list[float],
                    names: list[str] | None = None, groups: list[str] | None = None) -> DataFrame:
    """Exact quantiles with linear interpolation (pandas / ``percentile`` semantics).

    Distributed selection in two looks at the input (give a written table):

    1. rows are counted per order-preserving bucket (``order_key``: ~0.3 % of
       magnitude, at most ~1.07M per group, combined map-side); prefix sums over
       the buckets of a group tell the buckets that hold the wanted ranks, at
       most two per probability;
    2. only the values in those buckets are counted, ranked inside sub-buckets
       (``sub_key``, 2^20 per bucket) with prefix sums over the sub-buckets of a
       bucket, and the rows that cover a wanted rank are interpolated.

    So no window holds more than a bounded number of buckets, or the values of
    one sub-bucket, and nothing is sorted that lies outside the wanted buckets.
    A value held by a third of the rows is one row after the counting.
    Infinities are the end buckets; interpolating next to one gives infinity.
    Returns one row per group (one row, null values, for an empty input
    without groups).
    """
    names = names or [f"q{int(round(p * 100))}" for p in probs]
    g = list(groups or [])
    c = F.col(column) if isinstance(column, str) else column
    vals = df.select(*g, c.cast("double").alias("v")).filter(F.col("v").isNotNull() & ~F.isnan("v")) \
             .withColumn("_b", order_key(F.col("v")))
    buckets = vals.groupBy(*g, "_b").agg(F.count("*").alias("_bc"))
    before = Window.partitionBy(*g).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    spans = buckets.select(*g, "_b", F.coalesce(F.sum("_bc").over(before), F.lit(0)).alias("_boff"), "_bc",
                           F.sum("_bc").over(Window.partitionBy(*g)).alias("_n"))
    holds = F.lit(False)
    for p in probs:
        for rank in (F.floor(F.lit(p) * (F.col("_n") - 1)), F.ceil(F.lit(p) * (F.col("_n") - 1))):
            holds = holds | ((F.col("_boff") <= rank) & (rank < F.col("_boff") + F.col("_bc")))
    wanted = spans.filter(holds).select(*g, "_b", "_boff", "_n")
    counts = (vals.join(wanted, g + ["_b"]).groupBy(*g, "_b", "_boff", "_n", "v").agg(F.count("*").alias("c"))
                  .withColumn("_s", sub_key(F.col("v"))))
    run = Window.partitionBy(*g, "_b", "_s").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    keyed = counts.withColumn("_run", F.sum("c").over(run))
    sub_totals = counts.groupBy(*g, "_b", "_s").agg(F.sum("c").alias("_sc"))
    in_bucket = Window.partitionBy(*g, "_b").orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    sub_off = sub_totals.select(*g, "_b", "_s", F.coalesce(F.sum("_sc").over(in_bucket), F.lit(0)).alias("_soff"))
    # each row covers the 0-based ranks [_start, _end)
    end = F.col("_boff") + F.col("_soff") + F.col("_run")
    pos = keyed.join(sub_off, g + ["_b", "_s"]).select(*g, "v", "_n", (end - F.col("c")).alias("_start"), end.alias("_end"))
    h = [F.lit(p) * (F.col("_n") - 1) for p in probs]
    lo = [F.floor(x) for x in h]
    hi = [F.ceil(x) for x in h]

    def covers(r: Column) -> Column:
        return (F.col("_start") <= r) & (r < F.col("_end"))

    keep = None
    for r in lo + hi:
        keep = covers(r) if keep is None else keep | covers(r)
    aggs = [F.max("_n").alias("_n")]
    for i, (a, b) in enumerate(zip(lo, hi)):
        aggs += [F.max(F.when(covers(a), F.col("v"))).alias(f"_a{i}"),
                 F.max(F.when(covers(b), F.col("v"))).alias(f"_b{i}")]
    picked = pos.filter(keep).groupBy(*g).agg(*aggs)
    out = []
    for i, (p, name) in enumerate(zip(probs, names)):
        x = F.lit(p) * (F.col("_n") - 1)
        va, vb = F.col(f"_a{i}"), F.col(f"_b{i}")
        step = (x - F.floor(x)) * (vb - va)  # not a number between equal infinities, or off a rank at an infinity
        out.append(F.when((va == vb) | (x == F.floor(x)), va).otherwise(va + step).alias(name))
    return picked.select(*g, *out)


# ------------------------------------------------------------------ profiles
def describe_numeric(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, mean, sample stddev, min, max per column, typed (not strings)."""
    structs = [F.struct(F.lit(c).alias("column_name"), F.count(c).alias("count"),
                        F.avg(c).cast("double").alias("mean"),
                        F.stddev_samp(c).cast("double").alias("stddev"),
                        F.min(c).cast("double").alias("min"), F.max(c).cast("double").alias("max"))
               for c in columns]
    return df.agg(F.array(*structs).alias("_r")).select(F.inline("_r"))


def describe_quartiles(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pandas-style describe (count, mean, std, min, 25/50/75 %, max) of several columns.

    The columns are unpivoted to (column_name, value) once, so the moments and
    the grouped exact quantiles of all columns come from one scan.
    """
    long = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"),
                                                 F.col(c).cast("double").alias("value")) for c in columns])))
    stats = long.groupBy("column_name").agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"))
    qs = exact_quantiles(long, "value", [0.25, 0.5, 0.75], ["p25", "p50", "p75"], groups=["column_name"])
    # one row per described column on both sides
    return stats.join(qs, "column_name", "left")


def null_profile(df: DataFrame) -> DataFrame:
    """One row, the null count of every column under its own name."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])


def missing_report(df: DataFrame) -> DataFrame:
    """Columns with nulls, count and percent (2 places), most missing first."""
    structs = [F.struct(F.lit(c).alias("column_name"), F.count_if(F.col(c).isNull()).alias("null_count"))
               for c in df.columns]
    r = df.agg(F.count("*").alias("_n"), F.array(*structs).alias("_r"))
    return (r.select("_n", F.inline("_r"))
             .filter(F.col("null_count") > 0)
             .select("column_name", "null_count",
                     F.round(pct(F.col("null_count"), F.col("_n")), 2).alias("null_pct"))
             .orderBy(F.col("null_count").desc(), "column_name"))


def fill_profile(df: DataFrame) -> DataFrame:
    """Filled / null / fill percent of every column in one scan, lowest fill first."""
    structs = [F.struct(F.lit(c).alias("column_name"), F.count(F.col(c)).alias("filled")) for c in df.columns]
    r = df.agg(F.count("*").alias("_n"), F.array(*structs).alias("_r"))
    return (r.select("_n", F.inline("_r"))
             .select("column_name", "filled", (F.col("_n") - F.col("filled")).alias("null_count"),
                     pct(F.col("filled"), F.col("_n")).alias("fill_pct"))
             .orderBy("fill_pct", "column_name"))


def histogram(df: DataFrame, column: str | Column, bins: int, label: str | None = None) -> DataFrame:
    """``bins`` equal-width bins over [min, max], last bin closed; empty bins kept.

    A constant column is widened by 0.5 on both sides, as numpy does.
    """
    c = F.col(column) if isinstance(column, str) else column
    vals = df.select(c.cast("double").alias("x")).filter(F.col("x").isNotNull())
    rng = vals.agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    rng = rng.select(F.when(F.col("lo") == F.col("hi"), F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
                     F.when(F.col("lo") == F.col("hi"), F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"))
    r = literal_row(rng)
    lo, hi = r["lo"], r["hi"]
    idx = F.least(F.floor((F.col("x") - lo) * F.lit(bins) / (hi - lo)).cast("int"), F.lit(bins - 1))
    counts = vals.select(idx.alias("bin")).groupBy("bin").agg(F.count("*").alias("count"))
    # the bin axis has exactly `bins` rows: a proven bound for the broadcast
    axis = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    out = F.broadcast(axis).join(counts, "bin", "left").select(
        "bin",
        (lo + F.col("bin") * (hi - lo) / F.lit(bins)).alias("bin_start"),
        (lo + (F.col("bin") + 1) * (hi - lo) / F.lit(bins)).alias("bin_end"),
        F.coalesce(F.col("count"), F.lit(0)).cast("long").alias("count"))
    out = out.filter(lo.isNotNull())
    if label is not None:
        out = out.select(F.lit(label).alias("feature"), "*")
    return out


def histograms(df: DataFrame, spec: dict[str, int]) -> DataFrame:
    """E7 for several columns in one scan: (feature, bin, bin_start, bin_end, count).

    One aggregate finds every range, each row is expanded into one
    (feature, bin) pair per column, and one grouped count follows.
    """
    names = list(spec)
    rng = df.agg(*[F.struct(F.min(F.col(c).cast("double")).alias("lo"),
                            F.max(F.col(c).cast("double")).alias("hi")).alias(c) for c in names])
    widened = rng.select(*[F.struct(
        F.when(F.col(f"{c}.lo") == F.col(f"{c}.hi"), F.col(f"{c}.lo") - 0.5).otherwise(F.col(f"{c}.lo")).alias("lo"),
        F.when(F.col(f"{c}.lo") == F.col(f"{c}.hi"), F.col(f"{c}.hi") + 0.5).otherwise(F.col(f"{c}.hi")).alias("hi"),
    ).alias(c) for c in names])
    r = literal_row(widened)

    def idx(c: str) -> Column:
        lo, hi, k = r[c]["lo"], r[c]["hi"], spec[c]
        x = F.col(c).cast("double")
        return F.least(F.floor((x - lo) * F.lit(k) / (hi - lo)).cast("int"), F.lit(k - 1))

    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), idx(c).alias("bin")) for c in names])
    counts = (df.select(F.inline(pairs)).filter(F.col("bin").isNotNull())
                .groupBy("feature", "bin").agg(F.count("*").alias("count")))
    # the axis holds sum(bins) rows: a proven bound for the broadcast
    axis = df.sparkSession.range(1).select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.lit(spec[c]).alias("k")) for c in names])))
    axis = axis.select("feature", "k", F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("bin"))
    lo = F.lit(None).cast("double")
    hi = F.lit(None).cast("double")
    for c in names:
        lo = F.when(F.col("feature") == c, r[c]["lo"]).otherwise(lo)
        hi = F.when(F.col("feature") == c, r[c]["hi"]).otherwise(hi)
    out = F.broadcast(axis).join(counts, ["feature", "bin"], "left").select(
        "feature", "bin",
        (lo + F.col("bin") * (hi - lo) / F.col("k")).alias("bin_start"),
        (lo + (F.col("bin") + 1) * (hi - lo) / F.col("k")).alias("bin_end"),
        F.coalesce(F.col("count"), F.lit(0)).cast("long").alias("count"))
    return out.filter(lo.isNotNull())


def spend_summary(values: DataFrame, column: str) -> DataFrame:
    """E5: median, mean, sample std and max of one column."""
    med = exact_quantiles(values, column, [0.5], ["median"])
    return values.agg(F.count(column).alias("count"), F.avg(column).alias("mean"),
                      F.stddev_samp(column).alias("std"), F.max(column).alias("max")) \
                 .select("count", literal_row(med)["median"].alias("median"), "mean", "std", "max")


def skew_summary(df: DataFrame, column: str) -> DataFrame:
    """N, mean and bias-corrected skewness (pandas ``Series.skew``)."""
    return df.agg(F.count(column).alias("n"), F.avg(column).alias("mean"),
                  bias_corrected_skew(column).alias("skewness"))


def boxplot_stats(df: DataFrame, column: str) -> DataFrame:
    """Quartiles, IQR, 1.5*IQR fences, whisker ends and outlier count."""
    q = exact_quantiles(df, column, [0.25, 0.5, 0.75], ["q1", "median", "q3"])
    s = literal_row(q)
    q1, med, q3 = (s[x] for x in ("q1", "median", "q3"))
    iqr = q3 - q1
    lo_f, hi_f = q1 - 1.5 * iqr, q3 + 1.5 * iqr
    x = F.col(column)
    # fence tests are projected first: the quantile subquery may not sit inside an aggregate
    flagged = df.select(x.alias("x"), (x >= lo_f).alias("_ge_lo"), (x <= hi_f).alias("_le_hi"))
    inside_lo, inside_hi = F.col("_ge_lo"), F.col("_le_hi")
    return flagged.agg(
        F.min(F.when(inside_lo, F.col("x"))).alias("whisker_low"),
        F.max(F.when(inside_hi, F.col("x"))).alias("whisker_high"),
        F.count_if(~inside_lo | ~inside_hi).alias("outliers"),
    ).select(q1.alias("q1"), med.alias("median"), q3.alias("q3"), iqr.alias("iqr"),
             lo_f.alias("lower_fence"), hi_f.alias("upper_fence"), "whisker_low", "whisker_high", "outliers")


def _pair_correlation(a: str, b: str) -> Column:
    """Pearson correlation over the rows where both columns are present (aggregate).

    Null instead of an ANSI divide error when either is constant there.
    """
    sd = [F.stddev_samp(F.when(F.col(y).isNotNull(), F.col(x).cast("double"))) for x, y in ((a, b), (b, a))]
    if a == b:
        return F.when(sd[0] > 0, F.lit(1.0))
    return F.try_divide(F.covar_samp(F.col(a).cast("double"), F.col(b).cast("double")), sd[0] * sd[1]).cast("double")


def correlation_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson correlation of every pair in one aggregate, long form (pairwise complete rows)."""
    structs = []
    for i, a in enumerate(columns):
        for b in columns[i:]:
            r = _pair_correlation(a, b)
            pairs = [(a, b)] if a == b else [(a, b), (b, a)]
            # both orders share one set of aggregate buffers (Catalyst de-duplicates them)
            structs += [F.struct(F.lit(x).alias("feature_a"), F.lit(y).alias("feature_b"), r.alias("corr"))
                        for x, y in pairs]
    return df.agg(F.array(*structs).alias("_r")).select(F.inline("_r"))


def target_correlation(df: DataFrame, columns: list[str], target: str) -> DataFrame:
    """(feature, corr) of every other column with the target, in one aggregate, highest first."""
    structs = [F.struct(F.lit(c).alias("feature"), _pair_correlation(c, target).alias("corr")) for c in columns if c != target]
    return df.agg(F.array(*structs).alias("_r")).select(F.inline("_r")).orderBy(F.col("corr").desc_nulls_last(), "feature")
