import collections

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillflow.llm.vectors import PStable, near_vectors

SCHEMA = "vec_id long, embedding array<float>, label int"


def corpus():
    rng = np.random.default_rng(0)
    rows, n = [], 0
    for label in (1, 2, 3):
        for _ in range(12):
            base = rng.normal(size=32)
            for k in range(10):
                v = base if k < 2 else base + rng.normal(size=32) * rng.choice([0.03, 0.08, 0.12, 0.2])
                rows.append((n, (v * (1 if k != 1 else 2.5)).tolist(), label))
                n += 1
    same = rng.normal(size=32).tolist()
    for _ in range(40):
        rows.append((n, same, 2))
        n += 1
    nan, inf = float("nan"), float("inf")
    rows += [(n, None, 1), (n + 1, [0.0] * 32, 1), (n + 2, [nan] + [1.0] * 31, 1), (n + 3, [inf] + [1.0] * 31, 1), (n + 4, same, None),
             (n + 5, [], 1), (n + 6, [1.0, 2.0], 1), (n + 7, [2.0, 4.0], 1), (n + 8, [1.0] + [None] * 31, 1), (n + 9, [-0.0, 1.0], 3), (n + 10, [0.0, 1.0], 3)]
    return rows


def brute(rows, cosine=0.98):
    ids = [r[0] for r in rows]
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    vec = {}
    for i, e, label in rows:
        if e and label is not None and None not in e:
            v = np.array(e, np.float32).astype(np.float64)
            if np.isfinite(v).all() and np.linalg.norm(v) > 0:
                vec[i] = (label, v / np.linalg.norm(v))
    links = collections.Counter()
    keys = sorted(vec)
    for x, i in enumerate(keys):
        for j in keys[:x]:
            (la, a), (lb, b) = vec[i], vec[j]
            if la == lb and len(a) == len(b) and a @ b >= cosine:
                links[i] += 1
                links[j] += 1
                p, q = find(i), find(j)
                parent[max(p, q)] = min(p, q)
    return {i: (links[i], find(i), find(i) == i) for i in ids}


@pytest.mark.parametrize("p", [PStable(), PStable(unit_rows=6)])
def test_links_and_components_equal_brute_force(spark, p):
    rows = corpus()
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(1) for c in ("cls", "keys", "n", "rep", "bucket", "vec")})
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in near_vectors(df, p).collect()}
    want = brute(rows)
    found, total = sum(g[0] for g in got.values()), sum(w[0] for w in want.values())
    assert all(got[i][0] <= want[i][0] for i in want) and found >= 0.999 * total
    assert got == want


def test_nulls_repeats_empty(spark):
    v = [1.0, 2.0, 3.0]
    rows = [(4, v, 1), (4, v, 1), (None, v, 1), (9, v, 1), (2, v, 2)]
    got = sorted([tuple(r) for r in near_vectors(spark.createDataFrame(rows, SCHEMA)).collect()], key=str)
    assert got == sorted([(4, 1, 4, True), (4, 1, 4, True), (None, 0, None, True), (9, 1, 4, False), (2, 0, 2, True)], key=str)
    assert near_vectors(spark.createDataFrame([], SCHEMA)).collect() == []
