import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import CLASH, documents, prose
from tillflow.llm import periods
from tillflow.llm.periods import Periods

BLANK = b" \t\n\v\f\r"


def words_of(text):
    out, cur = [], b""
    for b in (text or "").encode():
        if b in BLANK:
            out, cur = (out + [cur] if cur else out), b""
        else:
            cur += bytes([b])
    return out + [cur] if cur else out


def plant(doc, words):
    if doc is None:
        return words
    h = zlib.crc32(str(doc).encode())
    if h % 10 or not words:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def brute_runs(w):
    """(start, length, period) by trying every period; a stretch's smallest period is its shortest border's."""
    n, out = len(w), set()
    for p in range(1, n // 4 + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and w[j] == w[j + p]:
                j += 1
            if j > i and j - i + p >= max(6, 4 * p):
                block = w[i:j + p]
                if not any(all(block[k] == block[k + q] for k in range(len(block) - q)) for q in range(1, p)):
                    out.add((i, j - i + p, p))
            i = j + 1 if j == i else j
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute(doc, text, change=True):
    w = plant(doc, words_of(text)) if change else words_of(text)
    runs = brute_runs(w)
    drop = {k for s, n, q in runs for k in range(s + q, s + n)}
    lead = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (doc, len(runs), *lead, 1000 * lead[1] // lead[2] if runs else None,
            sha("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()), sha(b" ".join(x for k, x in enumerate(w) if k not in drop)))


def rough(rng, n):
    """Words of a small alphabet with powers of powers in them."""
    out = []
    while len(out) < n:
        kind = rng.randrange(4)
        block = [rng.choice("abc") for _ in range(rng.choice([1, 2, 3, 5, 7, 12, 20]))]
        if kind == 0:
            block = block * rng.randint(1, 3) + block[:rng.randint(0, len(block))]
        out += block * rng.randint(1, 9) + block[:rng.randint(0, len(block))]
    return out[:n]


def test_fragments_give_all_runs_and_no_others():
    rng = random.Random(3)
    for trial in range(400):
        w = rough(rng, rng.randint(0, 160))
        got = [(a, b - a + p, p) for p, a, b in periods.fragments(periods.numbers([x.encode() for x in w])) if b - a + p >= max(6, 4 * p)]
        assert sorted(got, key=lambda r: (r[0], r[2])) == brute_runs(w), w


def test_spans_cover_every_cut_of_every_octave():
    for n, size in ((1, 16), (100, 16), (1000, 16), (5000, 64), (3, 8)):
        steps = {}
        for a, b, lo, hi, first, last in periods.spans_of(n, size):
            step = first
            while step <= last:
                steps.setdefault(step, set()).update(range(a + lo, a + hi))
                step *= 2
        step = 1
        while 4 * step <= n:
            assert steps[step] == set(range(n))
            step *= 2


def test_z_function():
    rng = random.Random(2)
    for _ in range(100):
        s = [rng.randrange(2) for _ in range(rng.randrange(30))]
        want = [next((k for k in range(len(s) - i) if s[k] != s[i + k]), len(s) - i) for i in range(len(s))]
        assert periods.z_function(s) == want


@pytest.mark.parametrize("p", [Periods(), Periods(span_words=16)])
def test_equals_brute_force(spark, p):
    rng = random.Random(5)
    rows = [(k, " ".join(rough(rng, rng.randint(0, 150)))) for k in range(40)]
    rows += [(100 + k, prose(rng, rng.randint(1, 120))) for k in range(60)]
    rows += [(300, None), (301, ""), (302, " \n\t"), (303, "a " * 700), (None, "x y " * 9), (None, None), (303, "a " * 700), (305, "é é " * 8)]
    df = documents(spark, rows).select("*", *[F.lit(1).alias(c) for c in (*CLASH, "row", "parts", "runs", "period")])
    changed = df.withColumn("text", periods.planted(F.col("text"), F.col("doc_id")))
    got = [tuple(r) for r in periods.digest_runs(changed, p).collect()]
    assert sorted(got, key=str) == sorted((brute(d, t) for d, t in rows), key=str)


def test_a_long_text_with_one_hot_word_and_an_empty_table(spark):
    text = "go " * 60000 + "stop " + "la li " * 20000
    got = periods.digest_runs(documents(spark, [(1, text)]), Periods(span_words=4096)).collect()[0]
    assert (got.n_runs, got.start, got.length, got.period, got.exponent_milli) == (2, 0, 60000, 1, 60000000)
    assert got.collapsed_sha256 == hashlib.sha256(b"go stop la li").hexdigest()
    assert periods.digest_runs(documents(spark, [])).collect() == []
