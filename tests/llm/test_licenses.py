import difflib
import random

import pytest

from tests.llm.helpers import documents, prose
from tillflow.llm.licenses import TEMPLATES, LicenseScan, Scanner, Template, align, increasing, read_templates, scan_documents, standing, words_of


def test_increasing_is_longest():
    rng = random.Random(1)
    for _ in range(200):
        pairs = list(enumerate(rng.sample(range(30), 9)))
        best = 0
        for mask in range(1 << 9):
            ys = [y for k, (_, y) in enumerate(pairs) if mask >> k & 1]
            if ys == sorted(ys):
                best = max(best, len(ys))
        got = increasing(pairs)
        assert len(got) == best and all(a < c and b < d for (a, b), (c, d) in zip(got, got[1:]))


def test_alignment_matches_equal_words_in_order():
    rng = random.Random(2)
    for _ in range(200):
        a = [rng.choice("abcdefgh") for _ in range(12)]
        b = [rng.choice("abcdefgh") for _ in range(10)]
        got = align(a, b)
        assert all(a[i] == b[j] for i, j in got) and all(x < u and y < v for (x, y), (u, v) in zip(got, got[1:]))
    words = prose(random.Random(3), 200).split()
    assert len(align(words, words)) == len(words)
    other = [w for k, w in enumerate(words) if k % 10]
    same = sum(b.size for b in difflib.SequenceMatcher(None, words, other, autojunk=False).get_matching_blocks())
    assert len(align(words, other)) >= 0.95 * same


def test_every_template_is_found_alone_and_inside_text():
    scan = Scanner(LicenseScan()).scan
    rng = random.Random(4)
    for t in TEMPLATES:
        for body in (t.text, f"{prose(rng, 30)}\n * {t.text.upper()}.\n{prose(rng, 500)}", t.text.replace(" ", "\n// ")):
            found = scan(body)
            assert [x[0] for x in found] == [t.license], (t, body[:80], found)
            assert found[0][1] == 1.0
            assert words_of(body[found[0][2]:found[0][3]]) == words_of(t.text)


@pytest.mark.parametrize("notice, license_", [
    ("This work is licensed under the GNU Lesser General Public License, version 3", "LGPL-3.0"),
    ("GNU Affero General Public License, version 3", "AGPL-3.0"),
    ("This work is licensed under the GNU Affero General Public License version 3.", "AGPL-3.0"),
    ("This work is licensed under the GNU General Public License, version 2", "GPL-2.0"),
    ("under the terms of the GNU General Public License v2.0 or later", "GPL-2.0"),
    ("GNU Lesser General Public License v2.1", "LGPL-2.1"),
    ("This work is licensed under the GNU General Public License, version 3", "GPL-3.0"),
    ("Licensed under the MIT License", "MIT"),
    ("Licensed under the Apache License 2.0", "Apache-2.0"),
    ("Mozilla Public License Version 2.0", "MPL-2.0"),
    ("// SPDX-License-Identifier: LGPL-3.0-or-later", "LGPL-3.0"),
    ("// SPDX-License-Identifier: BSD-3-Clause", "BSD-3-Clause"),
    ("Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License", "CC-BY-NC-SA-4.0"),
    ("Licensed under CC BY-SA 4.0", "CC-BY-SA-4.0"),
])
def test_usual_wordings_and_families(notice, license_):
    scan = Scanner(LicenseScan()).scan
    assert [x[0] for x in scan(notice)] == [license_]
    assert [x[0] for x in scan(f"{prose(random.Random(6), 50)} {notice} {prose(random.Random(7), 50)}")] == [license_]


def test_whole_texts_are_told_from_their_parts():
    scan = Scanner(LicenseScan()).scan
    texts = {(t.license, len(t.text)): t.text for t in TEMPLATES}
    three, two = (max((n, t) for (name, n), t in texts.items() if name == f"BSD-{k}-Clause")[1] for k in (3, 2))
    assert [x[0] for x in scan(three)] == ["BSD-3-Clause"] and [x[0] for x in scan(two)] == ["BSD-2-Clause"]
    assert [x[0] for x in scan(f"{three}\n\n{three}\n\n{two}")] == ["BSD-2-Clause", "BSD-3-Clause"]
    rng = random.Random(8)
    cut = " ".join(w for w in three.split() if w.lower() not in ("neither", "endorse", "redistributions", "binary") and rng.random() > 0.05 or "ither" in w or
                   w in ("endorse", "Redistributions", "binary"))
    (name, share, _, _), = scan(cut)
    assert name == "BSD-3-Clause" and 0.9 <= share < 1


def test_near_texts_and_clean_texts():
    scan = Scanner(LicenseScan()).scan
    for t in ("the license is under review and all rights are reserved for version 2", "Released under the terms", "", "license " * 500,
              "licensed under cc by nc 4 and 0", "all all all rights rights", "the GNU General Public License", "Apache License, Version 1.1",
              "GNU General Public License, version 4", "we submit under the commit license"):
        assert scan(t) == [], t


def test_repeated_notices_between_stray_words():
    scan = Scanner(LicenseScan()).scan
    text = "The library is released under the MIT License. The docs are released under the MIT License. See the LICENSE file."
    (name, share, lo, hi), = scan(text)
    assert (name, share, text[lo:hi]) == ("MIT", 1.0, "released under the MIT License")
    for t in TEMPLATES:
        notice, stray = t.text, t.text.split()
        for body in (f"{stray[-1]} x {notice} y {notice} {stray[0]}", f"{stray[1]} {' or '.join([notice] * 5)} {stray[0]} {stray[1]}"):
            got = {x[0]: x for x in scan(body)}
            assert got[t.license][1] == 1.0 and words_of(body[got[t.license][2]:got[t.license][3]]) == words_of(notice)


def brute(text: str, p: LicenseScan) -> list[tuple]:
    """Every stretch of words against every template."""
    words, matches = words_of(text), []
    for t in p.templates:
        want = words_of(t.text)
        need = min(-int(-len(want) * p.coverage // 1), len(want) - t.slack)
        for lo in range(len(words)):
            for hi in range(lo + need, min(len(words), lo + int(len(want) / p.coverage + 1e-9)) + 1):
                got = align(words[lo:hi], want)
                if (len(got) >= need and got[0][0] == 0 and got[-1][0] == hi - lo - 1 and len(got) >= p.coverage * (hi - lo)
                        and {want[j] for _, j in got} >= set(t.must) and not set(t.bars) & set(words[lo:hi])):
                    matches.append((-len(got), -len(got) / len(want), hi - 1 - lo, lo, t.license, hi - 1))
    out = {}
    for _, share, _, lo, name, hi in standing(sorted(matches)):
        out.setdefault(name, (-share, lo, hi))
    return [(name, *out[name]) for name in sorted(out)]


def test_scan_equals_brute_force():
    rng = random.Random(9)
    short = tuple(t for t in TEMPLATES if len(t.text) < 90)
    p, some = LicenseScan(templates=short), 0
    scanner = Scanner(p)
    for trial in range(120):
        parts = []
        for _ in range(rng.randrange(1, 4)):
            w = rng.choice(short).text.split()
            for _ in range(rng.choice((0, 0, 1, 2))):
                k = rng.randrange(len(w))
                w[k:k + 1] = rng.choice(([], [w[k], "word"], ["word"], [rng.choice(w)]))
            parts += [" ".join(w), prose(rng, rng.randrange(0, 6))]
        text = " ".join(parts)
        places = words_of(text)
        at = [0]
        for w in places:
            at.append(text.lower().index(w, at[-1]) + len(w))
        got = [(name, share, at.index(hi)) for name, share, _, hi in scanner.scan(text)]
        want = [(name, share, hi + 1) for name, share, _, hi in brute(text, p)]
        assert got == want, text
        some += bool(want)
    assert some > 80


def test_templates_from_a_folder(tmp_path):
    rng = random.Random(10)
    one = prose(rng, 300)
    (tmp_path / "Own-1.0.txt").write_text(one)
    (tmp_path / "Void.txt").write_text("")
    p = LicenseScan(templates=read_templates(str(tmp_path)))
    assert [t.license for t in p.templates] == ["Own-1.0", "Void"] and p.templates[0] == Template("Own-1.0", one)
    assert [x[0] for x in Scanner(p).scan(f"x y {one} z")] == ["Own-1.0"] and Scanner(p).scan(prose(rng, 300)) == []


def test_repeated_notices_with_missing_words():
    rng = random.Random(5)
    template = prose(rng, 200).replace(".", "").split()
    p = LicenseScan(templates=(("long", " ".join(template)),))
    for trial in range(20):
        gone = set(rng.sample(range(200), 15))
        near = " ".join(w for k, w in enumerate(template) if k not in gone)
        far = " ".join(w for k, w in enumerate(template) if k % 4)
        body = f"{template[9]} {far} x {near} and {far} {template[3]}"
        (_, share, lo, hi), = Scanner(p).scan(body)
        assert share >= 0.92 and abs(lo - body.index(near)) < 60


def test_documents(spark):
    mit, reserved, gpl = "Released under the MIT License", "All rights reserved", "This work is licensed under the GNU General Public License, version 3"
    both = f"{mit}.\n{mit}.\n{reserved}."
    rows = [(1, both), (2, None), (3, ""), (4, "clean"), (None, reserved), (1, both), (5, prose(random.Random(1), 30_000) + " " + gpl)]
    got = sorted(((r.doc_id, tuple(r.licenses)) for r in scan_documents(documents(spark, rows, clash=True)).collect()), key=str)
    assert got == sorted([(1, ("MIT", "reserved")), (2, ()), (3, ()), (4, ()), (None, ("reserved",)), (1, ("MIT", "reserved")), (5, ("GPL-3.0",))], key=str)
    assert scan_documents(documents(spark, [])).collect() == []
