import random
import re

import pytest

from tests.llm.helpers import documents, edit, prose
from tillflow.llm import pii
from tillflow.llm.pii import Disclosure, base_spans, find, max_disclosure, replace_spans, sanitise

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def digits(s):
    return re.sub("[^0-9]", "", s)


def luhn(s):
    total = 0
    for k, c in enumerate(reversed(s)):
        v = int(c) * (1 + k % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def plain(text):
    """The patterns as stated, one after the other."""
    out = [(0, m.start(), m.end()) for m in EMAIL.finditer(text)]
    out += [(1, m.start(), m.end()) for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [(2, m.start(), m.end()) for m in CARD.finditer(text) if 16 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    return out + [(3, m.start(), m.end()) for m in PHONE.finditer(text) if 8 <= len(digits(m[0])) <= 15]


CASES = ["", "a@b", "a@b.c", "x@@y.z a@b@c.d", "@a.b", "é.a@b.co.uk. next", "a@b..c", "a@b.c@d.e", "..@-.-", "1.2.3.4", "1.2.3.4.5.6.7.8",
         "256.1.1.1 1.2.3.0256 001.002.003.004 1.2.3", "12.34.56.78901", "4539 1488 0343 6467 x 4539-1488-0343-6467", "45391488034364670000",
         "4539 1488 0343 6467 1", "+1 (555) 123-4567.", "+1", "+12345678", "+1234567890123456", "+1 2 + 3 4", "++49 30 123456", "é+49 30 1234567é",
         "12 4539148803436467 34", "a+b@c.d +1.2.3.4.5.6.7.8"]


def test_base_spans_equal_the_plain_patterns():
    rng = random.Random(0)
    texts = CASES + ["".join(rng.choice("a1.2@ +-(5)\n%é0") for _ in range(50)) for _ in range(3000)]
    texts += [" ".join(rng.choice(["a@b.c", "1.2.3.4", "+49 30 1234567", "4539148803436467", "x", "7", "@", ".", "-"]) for _ in range(12))
              for _ in range(500)]
    for t in texts:
        assert base_spans(t) == plain(t), repr(t)


def test_long_runs_take_linear_time():
    for t in ("a" * 200_000, "1" * 200_000, "a" * 200_000 + "@", "1." * 100_000, "+" * 100_000, "1 " * 100_000, "a@" * 50_000, "+1((" * 20_000):
        base_spans(t)


def linked_rows():
    """Word `orchid` goes with one address in different texts; `the` is everywhere; copies repeat one text."""
    rng = random.Random(3)
    rows, n = [], 0
    for _ in range(6):
        rows.append((n, f"{prose(rng, 20)} Orchid writes to me.you@mail.example today {prose(rng, 20)}"))
        n += 1
    copy = f"{prose(rng, 20)} violet asks 10.1.2.3 now {prose(rng, 20)}"
    for _ in range(8):
        rows.append((n, copy))
        n += 1
    for _ in range(60):
        rows.append((n, prose(rng, 40)))
        n += 1
    return rows


def test_terms_that_reveal_an_entity(spark):
    rows = linked_rows() + [(900, None), (901, ""), (None, "x me.you@mail.example")]
    got = {r.doc_id: r for r in find(documents(spark, rows, clash=True)).collect()}
    texts = dict(rows)
    for doc, r in got.items():
        text = texts[doc] or ""
        assert list(zip(r.kinds, r.starts, r.ends)) == plain(text)
        words = {text[t.start:t.end].lower() for t in r.terms}
        if doc is not None and doc < 6:
            assert "orchid" in words and "writes" in words and all(t.disclosure >= 0.75 for t in r.terms)
        else:
            assert not words      # copies of one passage are one context
    # orchid is in the six texts only; the address is in seven of all
    want = max_disclosure(len(rows), 7, 6, 6)
    assert [t.disclosure for t in got[0].terms if texts[0][t.start:t.end] == "Orchid"] == [pytest.approx(want)]


def test_fixed_signatures_and_copies(spark):
    rng = random.Random(7)
    left, right = "regards from the desk of quillon marbeck senior", "clerk of accounts room nine third floor east"
    rows = [(k, f"{prose(rng, 60)} {left} q.m@mail.example {right} {prose(rng, 60)}") for k in range(30)]
    passage = f"{prose(rng, 80)} ask Zorbane at z@post.example now {prose(rng, 80)}"
    rows += [(100 + k, passage if k == 0 else edit(rng, passage, 0.01)) for k in range(60)]
    rows += [(200 + k, f"{prose(rng, 60)} then Zorbane got z@post.example back {prose(rng, 60)}") for k in range(5)]
    other = f"{prose(rng, 80)} orchard Zorbane {prose(rng, 80)}"
    rows += [(300 + k, other if k % 2 else f"{other} {k}") for k in range(8)]    # the name without the address, copied
    rows += [(400 + k, prose(rng, 60)) for k in range(40)]
    texts = dict(rows)
    got = {r.doc_id: {texts[r.doc_id][t.start:t.end]: t.disclosure for t in r.terms} for r in find(documents(spark, rows)).collect()}
    for k in range(30):
        assert {"quillon", "marbeck", "clerk"} <= set(got[k])
    # documents: 30, the passage and 5, the other, 40; the address is in 6 of them, the name in 7
    want = max_disclosure(30 + 1 + 5 + 1 + 40, 6, 7, 6)
    for k in (100, 200, 204):
        assert got[k]["Zorbane"] == pytest.approx(want)
    assert not any(got[k] for k in got if k >= 300)


def test_sanitise_replaces_and_keeps_the_rest(spark):
    rows = linked_rows() + [(900, None), (901, "no data"), (901, "no data")]
    df = documents(spark, rows, clash=True)
    out = sanitise(df)
    assert out.columns == df.columns
    got = out.collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r.text for r in got}
    assert by[900] is None and by[901] == "no data"
    assert not any(plain(t or "") for t in by.values())
    assert "<EMAIL>" in by[0] and "Orchid" not in by[0] and "<IP>" in by[7] and "violet" in by[7]
    for doc, text in rows:
        if text and not plain(text):
            assert by[doc] == text


def test_replace_spans_merges_overlaps():
    assert replace_spans("abcdef", [(1, 3, "<X>"), (2, 5, "<Y>")]) == "a<X>f"
    assert replace_spans("abc", [(0, 1, ""), (2, 3, "<Z>")]) == "b<Z>"


def test_bitmap_and_empty_table(spark):
    terms = spark.createDataFrame([(t,) for t in (0, 1, 31, 32, -1, 2**40 + 7)], "term long")
    bits = pii.bitmap_of(terms)
    is_set = lambda t: bits[(t % pii.BITMAP_BITS) >> 3] >> (t % 8) & 1
    assert all(is_set(t) for t in (0, 1, 31, 32, -1, 2**40 + 7)) and sum(bin(b).count("1") for b in bits) == 6
    assert find(documents(spark, []), Disclosure()).collect() == []
