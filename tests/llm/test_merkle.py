import hashlib
import random
import zlib

import numpy as np
import pytest

from tests.llm.helpers import CLASH
from tillflow.llm import merkle

FIELDS = "doc_id long, text string, lang string, source string, n_chars long"


def h(data: str) -> str:
    return hashlib.sha256(data.encode()).hexdigest()


def leaf_of(row):
    doc, text, lang, source, n = row
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc, source, lang, n, text)))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h("".join(out[-1][i:i + 8])) for i in range(0, len(out[-1]), 8)])
    return out


def climb(tree, pos, digest):
    sib = ""
    for level in tree[:-1]:
        run = level[pos // 8 * 8:pos // 8 * 8 + 8]
        sib += "".join(x for j, x in enumerate(run) if j != pos % 8)
        digest = h("".join(digest if j == pos % 8 else x for j, x in enumerate(run)))
        pos //= 8
    return sib, digest


def brute(rows):
    """Result tuples by hashing every run anew."""
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        mine = sorted([(r[0] is not None, r[0] or 0, leaf_of(r), i) for i, r in enumerate(rows) if r[2] == lang])
        trees[lang] = (levels([m[2] for m in mine]), {m[3]: p for p, m in enumerate(mine)})
    top = levels([trees[x][0][-1][0] for x in langs]) if langs else []
    out = []
    for i, r in enumerate(rows):
        doc, text, lang, source, n = r
        tree, at = trees[lang]
        lower = None if text is None else "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
        hit = doc is not None and zlib.crc32(str(doc).encode()) % 3 == 0
        start = leaf_of((doc, lower, lang, source, n)) if hit else leaf_of(r)
        s1, sub = climb(tree, at[i], start)
        s2, root = climb(top, langs.index(lang), sub)
        out.append((doc, leaf_of(r), tree[-1][0], top[-1][0], h(s1 + s2), root, root == top[-1][0]))
    return out


def run(spark, rows, clash=False):
    df = spark.createDataFrame(rows, FIELDS)
    if clash:
        from pyspark.sql import functions as F
        df = df.select("*", *[F.lit(i).alias(c) for i, c in enumerate((*CLASH, "tree", "pos", "row", "leaf", "tile", "digest"))])
    return sorted(map(tuple, merkle.fold(merkle.manifest(df, merkle.tampered())).collect()), key=str)


def rows_of(n, langs, seed=1):
    rng = random.Random(seed)
    words = ["Alpha", "beta", "Größe", "été", "X"]
    return [(d, " ".join(rng.choice(words) for _ in range(rng.randrange(6))), rng.choice(langs), f"s{d % 3}", d) for d in rng.sample(range(10 * n), n)]


def test_compress_equals_the_library():
    rng = np.random.default_rng(0)
    for n in (0, 1, 2, 9):
        data = [bytes(rng.integers(0, 256, 64 * n, np.uint8)) for _ in range(5)]
        state = merkle.start(5)
        for k in range(n):
            block = np.stack([np.frombuffer(x[64 * k:64 * k + 64], ">u4") for x in data]).astype(np.uint32).T
            state = merkle.compress(state, block)
        assert merkle.texts_of(merkle.finish(state, np.full(5, n))) == [hashlib.sha256(x).hexdigest() for x in data]


@pytest.mark.parametrize("n,langs", [(700, ["en", "de", None, "é", "z"]), (1, ["en"]), (64, [None]), (30, [f"l{i}" for i in range(20)])])
def test_equals_brute_force(spark, n, langs):
    rows = rows_of(n, langs)
    assert run(spark, rows, clash=n == 64) == sorted(brute(rows), key=str)


def test_tiles_of_several_steps(spark, monkeypatch):
    """More leaves than a tile holds: two steps, and paths above the tiles."""
    rows = rows_of(4700, ["en", "en", "en", "en", "en", "en", "en", "en", "de"])
    assert run(spark, rows) == sorted(brute(rows), key=str)


def test_nulls_repeats_and_empty_table(spark):
    text = "Long " * 40000
    rows = [(5, "A", "en", "s", 1), (5, "A", "en", "s", 1), (5, "B", "en", "s", 1), (None, "A", "en", "s", 1), (None, None, None, None, None),
            (7, "", None, "", 0), (7, None, None, "", 0), (8, text, "en", "s", None)]
    assert run(spark, rows) == sorted(brute(rows), key=str)
    assert merkle.fold(merkle.manifest(spark.createDataFrame([], FIELDS), merkle.tampered())).collect() == []


def test_folding_skips_left_siblings(monkeypatch):
    """A fold compresses the replacement, the right siblings and the padding: nothing left of the slot."""
    blocks = merkle.blocks_of(type("L", (), {"to_pylist": lambda self: [h(str(i)) for i in range(8)]})())
    digest, kept, count = merkle.parents(blocks)
    done = []
    inner = merkle.compress
    monkeypatch.setattr(merkle, "compress", lambda s, b: done.append(s.shape[1]) or inner(s, b))
    for slot in range(8):
        done.clear()
        state = merkle.compress(kept[slot], blocks[:, slot:slot + 1])
        for j in range(slot + 1, 8):
            state = merkle.compress(state, blocks[:, j:j + 1])
        assert merkle.texts_of(merkle.finish(state, count)) == merkle.texts_of(digest)
        assert len(done) == 8 - slot + 1
