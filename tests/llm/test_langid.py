import random

import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import documents, prose
from tillflow.llm.langid import LangParams, Parser, fold, identify, normal_codes, sample_labelled, suffix_automaton

TONGUES = {"xa": ["an", "ter", "the", "on", "sh"], "xb": ["ée", "ou", "que", "la", "ça"], "xc": ["ung", "ß", "der", "ich", "ö"]}


def brute_phrases(text, train):
    """Greedy parse: longest substring of ``train`` from each position; an unseen character is a phrase."""
    n = i = 0
    while i < len(text):
        k = 1
        while i + k <= len(text) and text[i:i + k] in train:
            k += 1
        i += max(1, k - 1)
        n += 1
    return n


def test_automaton_accepts_exactly_the_substrings():
    text = "abcbcabba"
    nxt = suffix_automaton([ord(c) for c in text])

    def accepts(s):
        at = 0
        for c in s:
            at = nxt[at].get(ord(c))
            if at is None:
                return False
        return True

    parts = {text[i:j] for i in range(len(text)) for j in range(i, len(text) + 1)}
    assert all(accepts(s) for s in parts)
    rng = random.Random(0)
    for _ in range(500):
        s = "".join(rng.choice("abc") for _ in range(rng.randint(1, 5)))
        assert accepts(s) == (s in parts)


def test_phrase_counts_equal_a_brute_force_parse():
    rng = random.Random(1)
    samples = {k: [prose(rng, 80, s) for _ in range(3)] for k, s in TONGUES.items()}
    p = LangParams(block=10_000)
    parser = Parser(samples, p)
    trains = {k: "".join("".join(map(chr, normal_codes(t))) + "\0" for t in samples[k])[:p.train_chars] for k in parser.langs}
    for _ in range(30):
        text = "".join(map(chr, normal_codes(prose(rng, 40, rng.choice(list(TONGUES.values()))) + rng.choice(["", " xyz", "qq", "日"]))))
        counts = parser.phrases([parser.code_class[[ord(c) for c in text]]])[:, 0]
        assert counts.tolist() == [brute_phrases(text, trains[k]) for k in parser.langs]


def test_normalisation():
    show = lambda s: "".join(map(chr, normal_codes(s))).replace("\0", "_")
    assert show("  Ab,, 1 c\n") == "ab_c_" and show("123 !") == "" and show("") == "" and show("É") == "é"


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(2)
    rows = []
    for k in range(240):
        lang = rng.choice(list(TONGUES))
        rows.append((k, prose(rng, rng.choice([6, 30, 400]), TONGUES[lang]), "s", lang))
    rows += [(900, None, "s", "xa"), (901, "", "s", "xa"), (902, "12 --", "s", "xb"), (903, prose(rng, 30_000, TONGUES["xb"]), "s", None),
             (None, prose(rng, 50, TONGUES["xc"]), "s", "xc"), (5, rows[5][1], "s", rows[5][3])]
    return rows


def test_held_out_accuracy_and_edge_cases(spark, corpus):
    df = documents(spark, corpus, clash=True)
    got = identify(df, df.filter(fold() != 0)).collect()
    truth = {r[0]: r[3] for r in corpus}
    held = {r.doc_id for r in df.filter(fold() == 0).select("doc_id").collect()}
    right = [r.lang_pred == truth[r.doc_id] for r in got if r.doc_id in held and r.doc_id < 900]
    assert len(right) > 20 and sum(right) >= 0.98 * len(right)
    by = {r.doc_id: r for r in got}
    assert [by[k].lang_pred for k in (900, 901, 902)] == ["und"] * 3 and by[900].score == 0.0
    assert by[903].lang_pred == "xb" and by[None].lang_pred == "xc"
    assert len(got) == len(corpus) and all(0 <= r.score <= 1 for r in got)


def test_no_labels_one_language_empty_table(spark, corpus):
    df = documents(spark, corpus[:20])
    none = identify(df, df.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in none.collect()} == {"und"}
    one = identify(df, df.withColumn("lang", F.lit("xq")))
    assert {(r.lang_pred, r.score) for r in one.collect()} == {("xq", 1.0)}
    assert identify(documents(spark, []), df).collect() == []


def test_an_id_on_a_third_of_the_rows_stays_within_the_sample(spark, corpus):
    rng = random.Random(5)
    hot = [(7, "gleich", "s", "xc")] * 200 + [(8, prose(rng, 12, TONGUES["xa"]), "s", "xa") for _ in range(200)]
    got = sample_labelled(documents(spark, corpus + hot), LangParams(sample_rows=10))
    assert set(got) == set(TONGUES) and sum(map(len, got.values())) <= 4 * 10 * 3
    assert all(len(set(v)) == len(v) for v in got.values())
