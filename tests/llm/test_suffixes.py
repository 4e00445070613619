import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import CLASH, documents, edit, prose
from tillflow.llm import suffixes
from tillflow.llm.suffixes import LoserTree, Passages, anchors, common, decode, front_code, repeated_passages

SMALL = Passages(length=40, spread=24, part_rows=50, run_rows=30)


def brute(rows, length):
    data = [(t or "").encode() for _, t in rows]
    seen = Counter(d[i:i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for (doc, _), d in zip(rows, data):
        gone = [False] * len(d)
        for i in range(len(d) - length + 1):
            if seen[d[i:i + length]] > 1:
                gone[i:i + length] = [True] * length
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((doc, len(d), sum(gone), spans, hashlib.sha256(bytes(b for b, g in zip(d, gone) if not g)).hexdigest()))
    return sorted(out, key=str)


def run(spark, rows, p, clash=False):
    df = documents(spark, rows, clash=clash)
    if clash:
        df = df.select("*", *[F.lit(1).alias(c) for c in ("t1", "t2", "near", "x", "id")])
    got = repeated_passages(df, p)
    return sorted(map(tuple, got.select("doc_id", "n_bytes", "n_removed", F.size("spans").alias("s"), "kept_sha256").collect()), key=str)


def corpus(seed, length):
    rng = random.Random(seed)
    rows = []
    passages = [prose(rng, rng.randint(length // 8, length)) for _ in range(4)]
    for k in range(50):
        text = prose(rng, rng.randint(0, length // 2))
        for _ in range(rng.randrange(3)):
            cut = rng.choice(passages)
            a = rng.randrange(len(cut) // 2)
            text += cut[a:a + rng.randint(length // 2, 3 * length)] + prose(rng, rng.randint(0, 6))
        rows.append((k, text))
    for k in range(12):
        rows.append((100 + k, edit(rng, rows[k][1], 0.03)))
    rows += [(200, rows[0][1]), (201, None), (202, ""), (203, "x"), (204, "ab" * length), (205, "é" * length), (206, "a" * (length + 3)),
             (3, rows[3][1]), (3, rows[3][1]), (None, rows[5][1]), (None, None), (207, "a" * length)]
    return rows


@pytest.mark.parametrize("seed,p", [(1, SMALL), (2, Passages(length=40, spread=24, cluster_rows=3, ranges=3)), (3, Passages(length=100, spread=64, part_rows=40))])
def test_equals_brute_force(spark, seed, p):
    rows = corpus(seed, p.length)
    assert run(spark, rows, p, clash=seed == 1) == brute(rows, p.length)


def test_production_parameters_and_empty_table(spark):
    rng = random.Random(9)
    passage = prose(rng, 120)
    assert len(passage) > 500
    rows = [(k, prose(rng, 90) + passage[k:k + 420] + prose(rng, 90)) for k in range(5)] + [(9, prose(rng, 300)), (10, passage[:399]), (11, passage * 3)]
    rows.append((12, "long " * 30000))
    assert run(spark, rows, Passages()) == brute(rows, 400)
    assert repeated_passages(documents(spark, [])).collect() == []


def test_equal_windows_have_their_anchors_at_equal_distances(monkeypatch):
    monkeypatch.setattr(suffixes, "CHUNK", 500)
    rng = random.Random(4)
    p = Passages(length=40, spread=24)
    texts = [("".join(rng.choice("ab") for _ in range(rng.randint(0, 700)))).encode() for _ in range(30)]
    offs = np.cumsum([0, *map(len, texts)])
    found = anchors(np.frombuffer(b"".join(texts), np.uint8), offs, p)
    at = {}
    covered = Counter()
    for t, x, dlo, dhi, _, _ in found.tolist():
        for d in range(dlo, dhi + 1):
            window = texts[t][x - d:x - d + 40]
            assert len(window) == 40 and at.setdefault(window, d) == d
            covered[t, x - d] += 1
    assert covered == {(t, s): 1 for t, text in enumerate(texts) for s in range(len(text) - 39)}


def test_loser_tree_merges_and_never_reads_a_known_prefix_again():
    rng = random.Random(7)
    for k in (1, 2, 3, 7, 16):
        items = [bytes(rng.choice(b"ab") for _ in range(rng.randrange(30))) for _ in range(200)]
        runs = [sorted((s, i, 0, 0, b"") for i, s in enumerate(items) if i % k == r) for r in range(k)]
        tree = LoserTree([decode(front_code(r)) for r in runs])
        got = list(tree)
        want = sorted(items)
        assert [x[1] for _, x in got] == want
        assert [n for n, _ in got] == [common(a, b, 0) for a, b in zip([b"", *want], want)]
    # all suffixes share 300 bytes: they are read once for each run, not once for each comparison
    items = sorted(b"s" * 300 + bytes([rng.randrange(256) for _ in range(4)]) for _ in range(400))
    tree = LoserTree([decode(front_code([(s, i, 0, 0, b"") for i, s in enumerate(items[r::8])])) for r in range(8)])
    assert [x[1] for _, x in tree] == items
    assert tree.compared < 8 * 300 + 400 * 8
