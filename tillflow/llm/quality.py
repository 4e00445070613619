"""Quality classifier: Bradley-Terry ranking of documents from preference pairs.

A document's strength is linear in text features; a pair (better, worse) is
won with the logistic of the difference of strengths, so fitting is logistic
regression on feature differences without an intercept. Every eligible labelled
row takes part: each row of the larger label is paired with ``pairs_per_doc`` of
the other one, round robin in hash order, so that the rows of the smaller label
come up equally often. The loss is minimised over all pairs by Newton steps, a
pass over the written pairs each, until it can fall no further; a few pairs only give
the point it starts at, from which steps that run off are halved.
The cut is an exact quantile of all training strengths: the share of label 0
among the eligible labelled rows. A strength maps to a score by the logistic,
placed so that the cut has the score ``cut_score``.

Only the text feeds a score. Sums are of integers (fixed point) or decimals, so
the model does not depend on the order or the partitions of the rows. The
features of labelled rows are shuffled, no text is.

Edge cases: null or empty text has features of its own and is scored like any
text. Labels that are null or not 0/1, or whose doc_id is null or missing from
the documents, are unused; repeated labels count once, contradicting ones of one doc_id both; a labelled
doc_id's equal rows count once, its different texts each. ``not_held_out`` is null for a null doc_id. With
labels of one kind only, or none, no pair exists: all strengths are 0 and every
row gets ``cut_score``. Repeated rows get equal scores. Extra columns are
ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillflow.llm import arrays
from tillflow.llm.rules import base_measures, row_sums
from tillflow.llm.runtime import drop_scratch, hits, key_bitmap, scratch_table, ship, slices, text_buffer


@dataclass(frozen=True)
class Ranking:
    """``pairs_per_doc``: pairs of each row of the larger label; ``sample_docs``: rows of it whose pairs give the first guess of the weights."""

    sample_docs: int = 4000
    pairs_per_doc: int = 6
    ridge: float = 1e-2
    cut_score: float = 0.7
    steps: int = 30


def _linear(x: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """``x @ weight``, by columns: a row's result does not depend on the rows beside it."""
    out = np.zeros(len(x))
    for column, w in zip(x.T, weight):
        out += column * w
    return out


@dataclass(frozen=True)
class RankModel:
    mean: np.ndarray
    scale: np.ndarray
    weight: np.ndarray
    cut: float
    cut_score: float

    def strength(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return _linear(z, self.weight)

    def score(self, x: np.ndarray) -> np.ndarray:
        z = self.strength(x) - self.cut + np.log(self.cut_score / (1 - self.cut_score))
        out = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
        # rounding must not move a row that is on the cut
        return np.where(self.strength(x) >= self.cut, np.maximum(out, self.cut_score), np.minimum(out, np.nextafter(self.cut_score, 0)))


def _bytes_in(chars: bytes) -> np.ndarray:
    t = np.zeros(256, bool)
    t[list(chars)] = True
    return t


def features(batch: pa.RecordBatch) -> np.ndarray:
    """Rows x features of a slice's texts."""
    buf, offs = text_buffer(batch.column("text"))
    w = arrays.words(buf, offs)
    m = base_measures(buf, offs, w)
    n = m["n_words"].astype(float)
    chars = np.maximum(m["word_chars"], 1).astype(float)
    some = np.maximum(n, 1)
    share = lambda table: row_sums(table[buf], offs) / chars
    upper, lower = _bytes_in(bytes(range(65, 91))), _bytes_in(bytes(range(97, 123)))
    up, low = row_sums(upper[buf], offs), row_sums(lower[buf], offs)
    same = np.zeros(len(w.starts), bool)
    if len(same):
        same[1:] = w.hashes[1:] == w.hashes[:-1]
        same[w.first[:-1][w.first[:-1] < len(same)]] = False
    repeat = m["n_repeat_words"] / some
    bare = np.zeros(len(w.starts), bool)
    if len(bare):
        letters = np.zeros(len(buf) + 1, np.int64)
        np.cumsum((upper | lower)[buf] | (buf >= 0x80), out=letters[1:])
        bare = letters[w.ends] == letters[w.starts]
    cols = [np.log1p(n), np.log1p(m["word_chars"] / some), np.sqrt(share(_bytes_in(b"#*$%&|<>"))), np.sqrt(share(_bytes_in(b"!"))),
            up / np.maximum(up + low, 1), share(_bytes_in(b"0123456789")), share(_bytes_in(b".,;:")),
            row_sums(same, w.first) / some, repeat, np.minimum(repeat, 0.2), (repeat > 0.5).astype(float),
            m["n_dup_lines"] / some, row_sums(bare, w.first) / some, share(_bytes_in(b"|")), (n < 50).astype(float),
            row_sums((buf == 10), offs) / some]
    return np.column_stack(cols)


N_FEATURES = 16


FEATURES = [f"f{i}" for i in range(N_FEATURES)]


def _matrix(batch: pa.RecordBatch, names: list[str] = FEATURES) -> np.ndarray:
    return np.column_stack([batch.column(n).to_numpy(zero_copy_only=False) for n in names])


def _feature_batches(labelled: tuple[bytes, int] | None):
    """Features of the rows whose doc_id may be among the bitmap's, or of all.

    One function: a stage of two would hold two Python workers for each task, which Spark keeps for all later stages.
    """
    def run(batches):
        for whole in batches:
            if labelled:
                whole = whole.filter(pa.array(hits(*labelled, whole.column("doc_id"))))
            for batch in slices(whole):
                x = features(batch)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("pick"), *[pa.array(c, pa.float64()) for c in x.T]],
                                                 ["doc_id", "pick", *FEATURES])
    return run


def _descend(slope, w: np.ndarray, steps: int) -> tuple[np.ndarray, bool]:
    """From ``w`` to where the gradient vanishes, and whether it got there; ``slope(w)`` is (gradient, Hessian) of a strictly convex function.

    Newton steps, halved until the gradient shrinks: whole ones may run off from a start far from the minimum.
    """
    g, h = slope(w)
    for _ in range(steps):
        step = np.linalg.solve(h, g)
        if np.abs(step).max() < 1e-8:
            return w - step, True
        share, steep = 1.0, np.linalg.norm(g)
        while True:
            g, h = slope(w - share * step)
            if np.linalg.norm(g) <= (1 - share / 4) * steep or share < 1e-6:
                break
            share /= 2
        w = w - share * step
    return w, False


def _newton(d: np.ndarray, ridge: float, steps: int) -> np.ndarray:
    """Minimise the mean logistic loss of differences ``d`` (each a win) plus a ridge."""
    def slope(w):
        p = 1 / (1 + np.exp(np.clip(d @ w, -500, 500)))
        return -(d * p[:, None]).mean(axis=0) + ridge * w, (d * (p * (1 - p))[:, None]).T @ d / len(d) + ridge * np.eye(len(w))

    return _descend(slope, np.zeros(d.shape[1]), steps)[0]


def _labelled(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """``(quality, pick, *FEATURES)``: every labelled text once per label, written."""
    some = docs.select("doc_id", "text").filter(F.col("doc_id").isNotNull())
    # spares the other rows their features; the join below is exact
    whole_ids = all(dict(d.dtypes)["doc_id"] in ("tinyint", "smallint", "int", "bigint") for d in (some, rows))
    labelled = key_bitmap(rows.select("doc_id").distinct(), "doc_id") if whole_ids else None
    picked = some.withColumn("pick", F.xxhash64("doc_id", "text"))
    kinds = ", ".join(f"{f} double" for f in FEATURES)
    x = picked.mapInArrow(_feature_batches(labelled), f"doc_id {dict(some.dtypes)['doc_id']}, pick long, {kinds}").dropDuplicates(["doc_id", "pick"])
    return scratch_table(x.join(rows, "doc_id").select("quality", "pick", *FEATURES), "quality-rows")


def _moments(data: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Mean and deviation of every feature (1 where it does not vary), by sums of decimals: exact in any order."""
    exact = lambda c: F.sum(c.cast("decimal(38,12)"))
    got = data.agg(F.count(F.lit(1)).alias("n"), *[exact(F.col(f)).alias(f) for f in FEATURES]).first()
    mean = np.array([float(got[f] / got["n"]) for f in FEATURES])
    off = data.agg(*[exact((F.col(f) - F.lit(float(m))) * (F.col(f) - F.lit(float(m)))).alias(f) for f, m in zip(FEATURES, mean)]).first()
    scale = np.sqrt([float(off[f] / got["n"]) for f in FEATURES])
    return mean, np.where(scale > 1e-6, scale, 1.0)


def _ranked(data: DataFrame, n: int) -> DataFrame:
    """``data`` with ``rank``, from 0 within each label, in the order of a hash.

    Hash buckets of some thousand rows are numbered by prefix sums over the buckets and a window inside each.
    """
    h = data.withColumn("_h", F.xxhash64("pick", F.lit(18))).withColumn("_bucket", F.pmod("_h", F.lit(max(1, n // 4096))))
    earlier = Window.partitionBy("quality").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    begins = h.groupBy("quality", "_bucket").agg(F.count(F.lit(1)).alias("_n")) \
              .select("quality", "_bucket", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_begin"))
    local = F.row_number().over(Window.partitionBy("quality", "_bucket").orderBy("_h", "pick", *FEATURES)) - 1
    return h.withColumn("_local", local).join(begins, ["quality", "_bucket"]) \
            .select("quality", (F.col("_begin") + F.col("_local")).alias("rank"), *FEATURES)


def _pairs(data: DataFrame, sizes: dict, mean: np.ndarray, scale: np.ndarray, per_doc: int) -> DataFrame:
    """``(rank, turn, *FEATURES)``: the scaled differences, better less worse; ``rank`` is that of the larger label's row."""
    ranked = scratch_table(_ranked(data.select("quality", "pick", *[
        F.least(F.greatest((F.col(f) - F.lit(float(m))) / F.lit(float(s)), F.lit(-8.0)), F.lit(8.0)).alias(f)
        for f, m, s in zip(FEATURES, mean, scale)]), sum(sizes.values())), "quality-ranks")
    large = int(sizes[1] >= sizes[0])
    more = ranked.filter(F.col("quality") == large).withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(per_doc - 1)))) \
                 .withColumn("_other", F.pmod(F.col("rank") * per_doc + F.col("turn"), F.lit(sizes[1 - large])))
    less = ranked.filter(F.col("quality") == 1 - large).select(F.col("rank").alias("_other"), *[F.col(f).alias(f"_{f}") for f in FEATURES])
    sign = 1.0 if large == 1 else -1.0
    out = scratch_table(more.join(less, "_other").select("rank", "turn", *[((F.col(f) - F.col(f"_{f}")) * sign).alias(f) for f in FEATURES]), "quality-pairs")
    drop_scratch(ranked)
    return out


UNIT = float(1 << 40)
_UPPER = np.triu_indices(N_FEATURES)


def _slope(pairs: DataFrame, w: np.ndarray, ridge: float) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and Hessian of the mean logistic loss of all pairs plus the ridge; a task returns its sums, in units of 2^-40."""
    def run(batches):
        total = [0] * (1 + N_FEATURES + len(_UPPER[0]))
        for batch in batches:
            d = _matrix(batch)
            p = 1 / (1 + np.exp(np.clip(_linear(d, w), -500, 500)))
            parts = [d * -p[:, None], d[:, _UPPER[0]] * d[:, _UPPER[1]] * (p * (1 - p))[:, None]]
            sums = [len(d), *(int(v) for x in parts for v in np.rint(x * UNIT).astype(np.int64).sum(axis=0))]
            total = [a + b for a, b in zip(total, sums)]
        yield pa.RecordBatch.from_arrays([pa.array([[Decimal(t) for t in total]], pa.list_(pa.decimal128(38, 0)))], ["sums"])

    got = pairs.select(*FEATURES).mapInArrow(run, "sums array<decimal(38,0)>").collect()  # one row per task
    n, *sums = (sum(int(v) for v in column) for column in zip(*(r["sums"] for r in got)))
    means = np.array([float(Fraction(v, n)) for v in sums]) / UNIT
    h = np.zeros((N_FEATURES, N_FEATURES))
    h[_UPPER] = means[N_FEATURES:]
    h = h + np.triu(h, 1).T
    return means[:N_FEATURES] + ridge * w, h + ridge * np.eye(N_FEATURES)


def _minimise(pairs: DataFrame, w: np.ndarray, ridge: float, steps: int) -> np.ndarray:
    """The weights of least loss over all pairs, by Newton steps from ``w``; the minimum is one point, whatever ``w``."""
    w, there = _descend(lambda v: _slope(pairs, v, ridge), w, steps)
    if not there:
        raise ArithmeticError(f"{steps} steps do not reach the least loss over all pairs")
    return w


CUT_BINS = 4096


def _cut(strengths: DataFrame, weight: dict, level: Fraction) -> float:
    """Between the row at which the weights' running sum in order of ``s`` (equal ones: label 0 first) reaches ``level``, and the next.

    Exact: the bin of that row is divided again until it holds one value; at most CUT_BINS rows reach the driver at a time.
    """
    ends = strengths.agg(F.min("s").alias("lo"), F.max("s").alias("hi")).first()
    lo, hi, below, above = ends["lo"], ends["hi"], Fraction(0), None
    while True:
        part = strengths.filter(F.col("s").between(lo, hi))
        # half of each end: their difference may be infinite
        place = F.lit(0) if lo == hi else F.least(F.floor((F.col("s") / 2 - lo / 2) / (hi / 2 - lo / 2) * CUT_BINS), F.lit(CUT_BINS - 1))
        bins = part.groupBy(place.alias("bin")).agg(F.count_if(F.col("quality") == 0).alias("n0"), F.count_if(F.col("quality") == 1).alias("n1"),
                                                    F.min("s").alias("lo"), F.max("s").alias("hi")).orderBy("bin").collect()
        for i, b in enumerate(bins):
            mass = weight[0] * b["n0"] + weight[1] * b["n1"]
            if below + mass >= level or i == len(bins) - 1:
                break
            below += mass
        above = bins[i + 1]["lo"] if i + 1 < len(bins) else above
        lo, hi = b["lo"], b["hi"]
        if lo == hi:
            break
    if below + mass - weight[1 if b["n1"] else 0] >= level:
        return lo  # the next row has the same strength
    if above is None:
        above, lo = (r["s"] for r in strengths.orderBy(F.desc("s")).limit(2).collect())
    return (lo + above) / 2


def fit(docs: DataFrame, labels: DataFrame, eligible, p: Ranking = Ranking()) -> RankModel:
    """Fit on all labelled rows of ``labels`` (doc_id, quality) that ``eligible`` (a column) admits."""
    ship(docs.sparkSession)
    rows = labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & eligible).select("doc_id", F.col("quality").cast("long").alias("quality")).distinct()
    counts = {r["quality"]: r["n"] for r in rows.groupBy("quality").agg(F.count(F.lit(1)).alias("n")).collect()}
    flat = RankModel(np.zeros(N_FEATURES), np.ones(N_FEATURES), np.zeros(N_FEATURES), 0.0, p.cut_score)
    if len(counts) < 2:
        return flat
    data = _labelled(docs, rows)
    sizes = {r["quality"]: r["n"] for r in data.groupBy("quality").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(sizes) < 2:
        drop_scratch(data)
        return flat
    mean, scale = _moments(data)
    pairs = _pairs(data, sizes, mean, scale, p.pairs_per_doc)
    # a first guess from a few pairs saves passes over all of them; the minimum, which is reached from any, does not depend on it
    few = pairs.filter(F.col("rank") < p.sample_docs).orderBy("rank", "turn").select(*FEATURES).collect()
    guess = _newton(np.array([tuple(r) for r in few], float), p.ridge, p.steps)
    model = RankModel(mean, scale, _minimise(pairs, guess, p.ridge, p.steps), 0.0, p.cut_score)

    def strengths(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("quality"), pa.array(model.strength(_matrix(batch)), pa.float64())], ["quality", "s"])

    s = scratch_table(data.mapInArrow(strengths, "quality long, s double"), "quality-strengths")
    # texts of a label stand for all its eligible rows, also those without a document; the weights sum up to counts[0] + counts[1]
    cut = _cut(s, {q: Fraction(counts[q], sizes[q]) for q in (0, 1)}, Fraction(counts[0]))
    drop_scratch(data, pairs, s)
    return RankModel(mean, scale, model.weight, float(cut), p.cut_score)


def score_documents(docs: DataFrame, model: RankModel) -> DataFrame:
    """All columns of ``docs`` plus ``quality_score`` (0 to 1), which replaces a column of that name."""
    ship(docs.sparkSession)
    docs = docs.drop("quality_score")

    def run(batches):
        for whole in batches:
            for batch in slices(whole):
                s = model.score(features(batch))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(s, pa.float64())],
                                                 [*batch.schema.names, "quality_score"])

    return docs.mapInArrow(run, docs.withColumn("quality_score", F.lit(0.0)).schema)


def keep_documents(docs: DataFrame, model: RankModel) -> DataFrame:
    """The rows of ``docs`` whose score reaches the cut; same columns."""
    ship(docs.sparkSession)

    def run(batches):
        for whole in batches:
            for batch in slices(whole):
                yield batch.filter(pa.array(model.score(features(batch)) >= model.cut_score))

    return docs.mapInArrow(run, docs.schema)


def not_held_out(column: str = "doc_id"):
    """Rows whose crc32 of the id as text, modulo 4, is not 2."""
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(4)) != 2
