import collections
import random

import numpy as np
import pytest

from tests.llm.helpers import documents, edit, prose
from tillflow.llm import arrays, minhash
from tillflow.llm.graph import components
from tillflow.llm.minhash import NearDup, drop_near_duplicates, exact_forest, near_duplicates, sketch

LOWER = {i: i + 32 for i in range(65, 91)}


def word_list(text):
    return (text or "").translate(LOWER).encode().split()


def shingle_set(text, size=4):
    w = word_list(text)
    return {tuple(w[i:i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()


def brute(rows, size=4, percent=80):
    """{doc_id: (n_shingles, component)} by comparing all pairs."""
    sets = {d: shingle_set(t, size) for d, t in rows if d is not None}
    ids = sorted(sets)
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, i in enumerate(ids):
        for j in ids[:k]:
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in ids}


def corpus():
    rng = random.Random(4)
    rows, n = [], 0
    for _ in range(6):
        base = prose(rng, rng.randint(40, 300))
        for k in range(12):
            rows.append((n, base if k < 3 else edit(rng, base, rng.choice([0.005, 0.02, 0.04, 0.08]))))
            n += 1
    for _ in range(40):
        rows.append((n, prose(rng, rng.randint(1, 200))))
        n += 1
    for text in (None, "", " \n\t ", "one", "One", "one two three", "ONE  two\nthree", "é É", "É é"):
        rows.append((n, text))
        n += 1
    return rows


@pytest.mark.parametrize("p", [NearDup(), NearDup(unit_rows=4, unit_shingles=600), NearDup(words=5)])
def test_components_equal_brute_force(spark, p):
    rows = corpus()
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_duplicates(documents(spark, rows, clash=True), p).collect()}
    want = brute(rows, p.words)
    assert got == {d: (n, c, c == d) for d, (n, c) in want.items()}


def test_nulls_repeats_and_empty_table(spark):
    text = prose(random.Random(1), 60)
    rows = [(5, text), (5, text), (None, text), (7, text), (None, None), (9, None), (9, None)]
    got = sorted([tuple(r) for r in near_duplicates(documents(spark, rows)).select("doc_id", "component_id", "kept").collect()], key=str)
    assert got == sorted([(5, 5, True), (5, 5, True), (None, None, True), (7, 5, False), (None, None, True),
                          (9, 9, True), (9, 9, True)], key=str)
    assert near_duplicates(documents(spark, [])).collect() == []


def test_an_id_with_several_texts_has_the_links_of_all(spark):
    rng = random.Random(12)
    a, b = prose(rng, 90), prose(rng, 90)
    rows = [(1, a), (1, b), (2, edit(rng, a, 0.02)), (3, edit(rng, b, 0.02)), (4, prose(rng, 90)), (4, None), (5, b)]
    for p in (NearDup(), NearDup(unit_rows=2, unit_shingles=100)):
        got = {r.doc_id: r.component_id for r in near_duplicates(documents(spark, rows), p).collect()}
        assert got == {1: 1, 2: 1, 3: 1, 4: 4, 5: 1}


def test_drop_keeps_one_row_of_each_class(spark):
    rng = random.Random(8)
    text = prose(rng, 80)
    rows = [(3, text), (3, text), (1, text), (2, edit(rng, text, 0.01)), (8, prose(rng, 50)), (8, "other"), (None, text), (4, None)]
    df = documents(spark, rows, clash=True)
    out = drop_near_duplicates(df)
    assert out.columns == df.columns
    assert sorted(str(r.doc_id) for r in out.collect()) == ["1", "4", "8", "None"]


def test_very_long_text(spark):
    rng = random.Random(2)
    long = prose(rng, 60_000)
    rows = [(1, long), (2, long + " tail"), (3, "x" * 300_000), (4, "x" * 300_000 + " y")]
    got = {r.doc_id: r.component_id for r in near_duplicates(documents(spark, rows)).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 4}


def test_sketch_fills_and_agrees_as_jaccard():
    rng = np.random.default_rng(0)
    agree = []
    for _ in range(60):
        common, x, y = (rng.integers(0, 2**63, n).astype(np.uint64) for n in (160, 20, 20))
        a, b = np.concatenate([common, x]), np.concatenate([common, y])
        sk = sketch(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]), 128)
        assert (sk != minhash.EMPTY).all()
        agree.append((sk[0] == sk[1]).mean())
    assert abs(np.mean(agree) - 0.8) < 0.02 and np.std(agree) < 0.05
    single = sketch(np.array([12345], np.uint64), np.array([0, 1]), 128)
    assert (single != minhash.EMPTY).all()


def test_exact_forest_links_at_the_threshold_only():
    s = lambda *x: np.array(sorted(x), np.uint64)
    assert exact_forest([s(1, 2, 3, 4), s(1, 2, 3, 4, 5)], 80).tolist() == [0, 0]      # 4/5 is linked
    assert exact_forest([s(1, 2, 3, 4, 6), s(1, 2, 3, 4, 5)], 80).tolist() == [0, 1]   # 4/6 is not
    assert exact_forest([s(), s()], 80).tolist() == [0, 1]


def test_array_words_and_shingles_equal_python():
    texts = ["a B  c\td\x0be", "", "  ", "é ß x", "one", "a a a a a"]
    data = [t.encode() for t in texts]
    buf = np.frombuffer(b"".join(data), np.uint8)
    offs = np.cumsum([0, *map(len, data)])
    w = arrays.words(buf, offs, arrays.lower_table())
    assert np.diff(w.first).tolist() == [len(word_list(t)) for t in texts]
    by_word = collections.defaultdict(set)
    for h, word in zip(w.hashes.tolist(), [x for t in texts for x in word_list(t)]):
        by_word[word].add(h)
    assert all(len(v) == 1 for v in by_word.values()) and len(set.union(*by_word.values())) == len(by_word)
    h, at = arrays.shingles(w, 4)
    sets, at = arrays.distinct_sets(h, at)
    assert np.diff(at).tolist() == [len(shingle_set(t)) for t in texts]


def test_components_of_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 180)] + [(200, 200), (300, 301), (301, 302), (302, 300)]
    random.Random(3).shuffle(edges)
    got = {r.id: r.component_id for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {i: 0 for i in range(61)} | {i: 100 for i in range(100, 180)} | {300: 300, 301: 300, 302: 300}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
