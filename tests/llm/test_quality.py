import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import documents, prose
from tillflow.llm.quality import N_FEATURES, Ranking, _newton, fit, keep_documents, not_held_out, score_documents


def junk(rng, n):
    kind = rng.randrange(4)
    words = prose(rng, n).split()
    if kind == 0:
        return " ".join(w.upper() + "!!" for w in words)
    if kind == 1:
        return " | ".join(words)
    if kind == 2:
        return " ".join(w for w in words[:max(1, n // 20)] for _ in range(20))
    return " ".join(w + rng.choice(["###", "%%%", "***"]) for w in words)


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(5)
    rows, labels = [], []
    for k in range(500):
        good = rng.random() < 0.7
        n = rng.randint(60, 400)
        rows.append((k, prose(rng, n) if good else junk(rng, n)))
        labels.append((k, int(good)))
    labels += [(3, None), (None, 1), (99_999, 0), (4, 7)]
    return documents(spark, rows, clash=True), spark.createDataFrame(labels, "doc_id long, quality int"), dict(labels[:500])


def test_held_out_accuracy(spark, corpus):
    docs, labels, truth = corpus
    model = fit(docs, labels, not_held_out())
    got = {r.doc_id: r.quality_score for r in score_documents(docs, model).collect()}
    held = {r.doc_id for r in docs.filter(~not_held_out()).select("doc_id").collect()}
    right = [(got[k] >= 0.7) == (truth[k] == 1) for k in held]
    assert len(right) > 60 and np.mean(right) >= 0.97 and all(0 <= x <= 1 for x in got.values())
    kept = keep_documents(docs, model)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {k for k, x in got.items() if x >= 0.7}
    again = fit(docs.repartition(7), labels, not_held_out())      # the order of arrival does not matter
    assert np.array_equal(model.weight, again.weight) and model.cut == again.cut


def test_pairwise_fit_equals_gradient_descent():
    rng = np.random.default_rng(0)
    d = rng.normal(0.4, 1, (300, 3))
    w = _newton(d, 1e-2, 50)
    v = np.zeros(3)
    for _ in range(20_000):
        v -= 0.5 * (-(d / (1 + np.exp(d @ v))[:, None]).mean(axis=0) + 1e-2 * v)
    assert np.allclose(w, v, atol=1e-6)


def test_no_pairs_and_edge_texts(spark, corpus):
    docs, labels, _ = corpus
    for few in (labels.filter("quality = 1"), labels.filter("false")):
        flat = fit(docs, few, F.lit(True))
        assert not flat.weight.any() and len(flat.weight) == N_FEATURES
        assert {r.quality_score for r in score_documents(docs, flat).collect()} == {0.7}
    model = fit(docs, labels, not_held_out(), Ranking(sample_docs=40))
    rng = random.Random(1)
    odd = documents(spark, [(1, None), (2, ""), (3, " \n "), (3, " \n "), (None, "x"), (4, "é" * 50_000), (5, prose(rng, 40_000))])
    got = [(r.doc_id, r.quality_score) for r in score_documents(odd.withColumn("quality_score", F.lit(5)), model).collect()]
    assert len(got) == 7 and all(0 <= x <= 1 for _, x in got)
    assert len({x for d, x in got if d in (1, 2)}) == 1 and len({x for d, x in got if d == 3}) == 1
    assert score_documents(documents(spark, []), model).collect() == []


def test_an_id_on_a_third_of_the_rows_stays_within_the_sample(spark, corpus, monkeypatch):
    docs, labels, _ = corpus
    rng = random.Random(4)
    hot = documents(spark, [(7, "one text for all of them")] * 200 + [(8, junk(rng, 60)) for _ in range(200)])
    more = docs.select("doc_id", "text").unionByName(hot.select("doc_id", "text"))
    twice = labels.unionByName(spark.createDataFrame([(7, 0), (7, 0), (8, 0)] * 50, "doc_id long, quality int"))
    seen = []
    monkeypatch.setattr("tillflow.llm.quality._newton", lambda d, *a: seen.append(len(d)) or np.zeros(d.shape[1]))
    model = fit(more, twice, F.lit(True), Ranking(sample_docs=20, pairs_per_doc=1))
    assert 0 < seen[0] <= 4 * 20 and np.isfinite(model.cut)


def test_every_labelled_row_feeds_the_model(spark, corpus):
    docs, labels, _ = corpus
    few = Ranking(sample_docs=5, pairs_per_doc=2)
    whole = fit(docs, labels, F.lit(True), few)
    other = fit(docs, labels, F.lit(True), Ranking(sample_docs=400, pairs_per_doc=2))
    # the rows of the first guess do not matter
    assert np.allclose(whole.weight, other.weight, atol=1e-6) and abs(whole.cut - other.cut) < 1e-5 and np.array_equal(whole.mean, other.mean)

    import pyarrow as pa
    from tillflow.llm.quality import features

    held = docs.join(labels.filter("quality in (0, 1)").dropna(), "doc_id").select("text", "quality").collect()
    x = features(pa.RecordBatch.from_pydict({"text": [r.text for r in held]}))
    y = np.array([r.quality for r in held])
    assert np.allclose(whole.mean, x.mean(axis=0), atol=1e-9) and np.allclose(whole.scale[x.std(axis=0) > 1e-5], x.std(axis=0)[x.std(axis=0) > 1e-5], rtol=1e-5)
    s = np.sort(whole.strength(x))
    k = int((y == 0).sum())  # the share of label 0 lies below the cut
    assert s[k - 1] <= whole.cut <= s[k] and abs(whole.cut - (s[k - 1] + s[k]) / 2) < 1e-9


def test_cut_is_an_exact_weighted_quantile(spark):
    from fractions import Fraction

    from tillflow.llm.quality import _cut

    rng = random.Random(2)
    for trial in range(4):
        rows = [(rng.randrange(2), rng.choice([rng.gauss(0, 1e-9), 5.0, rng.gauss(0, 100)]) if trial else 1.0) for _ in range(60)]
        w = {0: Fraction(3, 2), 1: Fraction(1, 3)}
        level = sum(w[q] for q, _ in rows) * Fraction(trial + 1, 5)
        order = sorted(rows, key=lambda r: (r[1], r[0]))
        run, k = Fraction(0), 0
        for k, (q, _) in enumerate(order):
            run += w[q]
            if run >= level:
                break
        k = min(k, len(order) - 2)
        assert _cut(spark.createDataFrame(rows, "quality long, s double"), w, level) == (order[k][1] + order[k + 1][1]) / 2


def test_a_misleading_first_guess_does_not_change_the_model(spark, corpus, monkeypatch):
    from tillflow.llm import quality

    docs, labels, _ = corpus
    last, slope = [], quality._slope
    monkeypatch.setattr(quality, "_slope", lambda pairs, w, ridge: (last.append(slope(pairs, w, ridge)), last[-1])[1])
    models = []
    for guess in (0.0, -8.0, 30.0):
        monkeypatch.setattr(quality, "_newton", lambda d, *a, g=guess: np.full(d.shape[1], g))
        models.append(fit(docs, labels, not_held_out()))
        assert np.abs(last[-1][0]).max() < 1e-6  # over all pairs the loss falls no further
    for m in models[1:]:
        assert np.allclose(m.weight, models[0].weight, atol=1e-6) and abs(m.cut - models[0].cut) < 1e-5
    with pytest.raises(ArithmeticError):
        fit(docs, labels, not_held_out(), Ranking(steps=1))


def test_descent_from_the_pairs_of_mislabelled_rows():
    from tillflow.llm.quality import _descend

    rng = np.random.default_rng(1)
    d = np.clip(rng.normal(rng.normal(0, 1, 16), 3, (2000, 16)), -16, 16)

    def slope(w):
        p = 1 / (1 + np.exp(np.clip(d @ w, -500, 500)))
        return -(d * p[:, None]).mean(axis=0) + 1e-2 * w, (d * (p * (1 - p))[:, None]).T @ d / len(d) + 1e-2 * np.eye(16)

    want, there = _descend(slope, np.zeros(16), 30)
    assert there and np.abs(slope(want)[0]).max() < 1e-9
    got, there = _descend(slope, _newton(-d[:6], 1e-2, 30), 30)
    assert there and np.allclose(got, want, atol=1e-6)
