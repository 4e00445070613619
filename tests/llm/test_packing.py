import collections
import random
import zlib

import numpy as np
import public_tokenizers
import pytest

from tests.llm.helpers import documents, prose
from tillflow.llm.packing import OpenSequences, Packing, best_fit_decreasing, pack
from tillflow.llm.wordbpe import tokenizer

PATH = public_tokenizers.path("word_bpe_49k.json")


def brute_best_fit(lengths, capacity):
    """Fills by scanning every open sequence for the tightest."""
    free = []
    for need in sorted(lengths, reverse=True):
        fits = [f for f in free if f >= need]
        best = min(fits, default=capacity)
        if fits:
            free.remove(best)
        free.append(best - need)
    return sorted(free)


@pytest.mark.parametrize("seed", range(4))
def test_best_fit_equals_a_scan_of_all_sequences(seed):
    rng = random.Random(seed)
    lengths = sorted((rng.randint(1, 100) for _ in range(400)), reverse=True)
    sequence, offset = best_fit_decreasing(np.array(lengths), 100)
    used = collections.Counter()
    for s, o, n in sorted(zip(sequence.tolist(), offset.tolist(), lengths)):
        assert o == used[s]          # gapless from 0
        used[s] += n
    assert sorted(100 - u for u in used.values()) == brute_best_fit(lengths, 100)


def test_open_sequences_give_the_tightest():
    t = OpenSequences(4096)
    assert t.tightest(1) == -1
    for k, free in enumerate((5, 4095, 5, 17)):
        t.add(k, free)
    assert t.tightest(5) == 5 and t.tightest(6) == 17 and t.tightest(18) == 4095 and t.tightest(4096) == -1
    assert {t.take(5), t.take(5)} == {0, 2}
    assert t.tightest(1) == 17


def reference_ids(texts):
    from tokenizers import Tokenizer
    lib = Tokenizer.from_file(PATH)
    return [lib.encode(t, add_special_tokens=False).ids for t in texts]


def test_ids_equal_the_library():
    rng = random.Random(5)
    odd = ["", " ", "a", "It's DON'T we've", "x²y 3½ ª º µm", "naïve Ünï ÇA İstanbul ẞ Σίσυφος ΟΔΟΣ", "中文 mixed 日本語", "a\x1cb\x1fc d",
           "tab\tnl\nvt\x0b ff\x0c nbsp x y\x85z", "<|endoftext|> x<|startoftext|>y", "é combining ä", "12345 1,234.5 ٣",
           "snake_case __x__ a_1", "emoji 😀😀 👩‍👩‍👧", "-- ... !!! $$$", "'s 's'll 'S", "ŀ Ǆ ǅ ǳ ȿ ɐ", "$Ɠǒ #Ⱥ -Ⱦ1 .Ʌ", "x" * 3000, "soft­hyphen zero​width"]
    texts = odd + [prose(rng, 60) for _ in range(20)] + [
        "".join(rng.choice("aB1'_ .\néß²İ中́😀 ") for _ in range(60)) for _ in range(300)]
    tok = tokenizer(PATH)
    for text, want in zip(texts, reference_ids(texts)):
        assert np.frombuffer(tok.ids(text), "<u4").tolist() == want, repr(text)


def corpus():
    rng = random.Random(9)
    rows = [(k, prose(rng, rng.choice([1, 5, 60, 300, 900]))) for k in range(150)]
    return rows + [(900, None), (901, ""), (902, prose(rng, 4000)), (None, "no id"), (5, "again"), (5, "again")]


@pytest.mark.parametrize("p", [Packing(), Packing(capacity=256, group_pieces=64)])
def test_every_token_is_packed_once(spark, p):
    rows = corpus()
    got = pack(documents(spark, rows, clash=True), PATH, p).collect()
    ids = {k: w + [p.end_id] for k, w in enumerate(reference_ids([t or "" for _, t in rows]))}
    want = collections.Counter()
    for k, (doc, _) in enumerate(rows):
        for piece, start in enumerate(range(0, len(ids[k]), p.capacity)):
            cut = ids[k][start:start + p.capacity]
            want[doc, piece, start, len(cut), zlib.crc32(np.array(cut, "<u4").tobytes())] += 1
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    by = collections.defaultdict(list)
    for r in got:
        by[r.sequence_id].append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= p.capacity
    total = sum(r.length for r in got)
    # small groups waste more: each leaves about one sequence open
    assert len(by) <= -(-total // p.capacity) * (1.01 if p.group_pieces > 1000 else 1.15) + 2, (len(by), total / p.capacity)


def test_empty_table(spark):
    assert pack(documents(spark, []), PATH).collect() == []


def test_equal_rows_without_ids_spread_over_the_groups(spark, tmp_path):
    p = Packing(group_pieces=100)
    rows = spark.range(0, 4000, 1, 4).selectExpr("cast(null as long) as doc_id", "'the same few words' as text")
    got = pack(rows, PATH, p).collect()
    assert len(got) == 4000
    length, per = got[0].length, collections.Counter(r.sequence_id for r in got)
    groups = collections.Counter()
    for s, n in per.items():
        groups[s >> 24] += n
    assert max(groups.values()) < 200 or len(per) <= -(-4000 * length // p.capacity) + 1
    assert all(n * length <= p.capacity for n in per.values())
    assert {(r.sequence_id, r.offset) for r in got} == {(s, k * length) for s, n in per.items() for k in range(n)}
