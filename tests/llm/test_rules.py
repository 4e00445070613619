import collections
import random
import re

from tests.llm.helpers import documents, edit, prose
from tillflow.llm.rules import LineRules, apply_rules, judge

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def measures(text):
    text = text or ""
    w = WORD.findall(text)
    tri = collections.Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    covered = {i + k for i in range(len(w) - 2) if tri[tuple(w[i:i + 3])] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(covered))


def test_base_measures_equal_brute_force(spark):
    rng = random.Random(1)
    odd = [None, "", " ", "\n\n", "a", "a b a b a b", "a b c a b c", "x\nx\nx \n\nx", "é ß\n中 中 中 中", "a\r\nb\r\na\r\n", "#*$%&|<> <a>", "a b c", "\n a\n"]
    rows = list(enumerate(odd + [" ".join(rng.choice("ab c\n d") for _ in range(60)) for _ in range(200)] + [prose(rng, 300), prose(rng, 40_000)]))
    for r in judge(documents(spark, rows, clash=True)).collect():
        want = measures(rows[r.doc_id][1])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want, rows[r.doc_id]
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])


def line_of(rng, n):
    return " ".join(prose(rng, n).split())


def corpus():
    rng = random.Random(2)
    boiler = line_of(rng, 14)
    long_boiler = [line_of(rng, 40) for _ in range(3)]
    rows, n = [], 0
    for _ in range(15):      # boilerplate in different documents of host a, in other letters and digits
        rows.append((n, f"{boiler.upper()} {100 + n}\n" + "\n".join(line_of(rng, 30) for _ in range(4)), "a"))
        n += 1
    for _ in range(15):      # documents that are little but boilerplate
        rows.append((n, "\n".join(long_boiler) + "\n" + line_of(rng, 20), "b"))
        n += 1
    one = "\n".join(line_of(rng, 30) for _ in range(5))
    for k in range(30):      # copies and edited copies of one document
        rows.append((n, one if k % 2 else edit(rng, one, 0.01), "c"))
        n += 1
    for _ in range(15):      # the same boilerplate, spread thinly over hosts
        rows.append((n, f"{boiler}\n" + "\n".join(line_of(rng, 30) for _ in range(4)), f"h{n}"))
        n += 1
    return rows, boiler, long_boiler


def brute(rows, p):
    """Removed lines per row, with sets of whole documents instead of sketches (copies share a sketch)."""
    norm = lambda line: " ".join(re.sub("[0-9]", "0", w.translate({i: i + 32 for i in range(65, 91)})) for w in WORD.findall(line))
    hosts, holds = collections.Counter(h for _, _, h in rows), collections.defaultdict(set)
    for k, (_, text, host) in enumerate(rows):
        for line in text.split("\n"):
            if WORD.search(line):
                holds[host, norm(line)].add(k)
    over = {x for x, docs in holds.items() if len({rows[k][1] for k in docs}) > max(p.line_docs, p.line_share * hosts[x[0]])}
    return [[i for i, line in enumerate(text.split("\n")) if (host, norm(line)) in over] for _, text, host in rows], over


def test_boilerplate_goes_and_copies_stay(spark):
    rows, boiler, long_boiler = corpus()
    p = LineRules()
    got = {r.doc_id: r for r in judge(documents(spark, rows, clash=True), p).collect()}
    want, _ = brute(rows, p)
    for k, (doc, text, host) in enumerate(rows):
        r = got[doc]
        if host == "c":
            assert r.removed is None and r.kept
        else:
            # boilerplate at line 0 keeps its own number apart: the number is part of the line and normalised
            assert (r.removed or []) == want[k], (host, r.removed, want[k])
            words = [len(WORD.findall(line)) for line in text.split("\n")]
            assert r.removed_words == sum(words[i] for i in want[k])
            assert r.kept == (not r.base_failed and 100 * r.removed_words <= p.depleted_percent * sum(words))
    assert {d for d, r in got.items() if not r.kept} == {d for d, _, h in rows if h == "b"}


def test_apply_keeps_columns_and_strips_lines(spark):
    rows, boiler, _ = corpus()
    rng = random.Random(3)
    good = "\n".join(line_of(rng, 30) for _ in range(3))
    rows += [(900, None, "a"), (901, "too short", "a"), (902, good, None), (902, good, None), (None, good + " x", "a")]
    df = documents(spark, rows, clash=True)
    out = apply_rules(df)
    assert out.columns == df.columns
    got = out.collect()
    by = {r.doc_id: r for r in got}
    assert 900 not in by and 901 not in by and sum(r.doc_id == 902 for r in got) == 2 and by[None].text == good + " x"
    assert by[0].text == rows[0][1].split("\n", 1)[1] and by[0].n_chars == len(by[0].text)
    assert all(boiler not in r.text.lower() for r in got if r.source == "a")


def edited(rng, text, n):
    """``text`` with n words replaced."""
    parts = re.split(r"(\s+)", text)
    for k in rng.sample(range(0, len(parts), 2), n):
        parts[k] = "zz" + str(rng.randrange(10**6))
    return "".join(parts)


def test_edited_copies_in_short_lines_stay(spark):
    rng = random.Random(4)
    rows = []
    for host, words in (("six", 6), ("ten", 10), ("fifteen", 15)):
        one = "\n".join(line_of(rng, words) for _ in range(200 // words))
        rows += [(len(rows) + k, one if k == 0 else edited(rng, one, 1 + k % 4), host) for k in range(300 if words == 6 else 30)]
    for r in judge(documents(spark, rows)).collect():
        assert r.kept and r.removed is None


def test_boilerplate_goes_beside_many_copies(spark):
    rng = random.Random(5)
    banner = line_of(rng, 14)
    one = "\n".join(line_of(rng, 20) for _ in range(10))
    rows = [(k, f"{banner}\n" + "\n".join(line_of(rng, 30) for _ in range(4)), "a") for k in range(40)]
    rows += [(100 + k, f"{banner}\n{edited(rng, one, 1 + k % 3)}", "a") for k in range(300)]
    for r in judge(documents(spark, rows)).collect():
        assert r.kept and r.removed == [0]


def test_empty_table(spark):
    assert judge(documents(spark, [])).collect() == [] and apply_rules(documents(spark, [])).collect() == []
