"""Personal data: base patterns, and information-theoretic sanitisation of revealing terms.

Base entities are e-mail addresses, IP addresses, card numbers and phone
numbers, found by fixed patterns. Each distinct value is a protected entity e.
A term t (a word, A-Z lower-cased) near an entity reveals it as far as the
corpus ties the two together: with N documents, n(e) and n(t) of which hold e
and t, and n(e, t) of which hold t within ``window`` words of e,

    PMI(e; t) = log2(N n(e, t) / (n(e) n(t))),   IC(e) = log2(N / n(e)),

and the disclosure PMI / IC is 1 when t occurs with e only. Terms at or above
``generalise`` become a placeholder, at or above ``remove`` they are taken out.
Exact and edited copies of one document are one document in all of these counts
(the classes of ``minhash``, on whole documents), and only pairs seen in at least
``support`` documents count.

Jobs: one scan finds entities and the words near them; pair counts are
aggregations with map-side combination; n(t) is counted over all documents in a
second scan that keeps only words hitting a bitmap of the candidate terms (a
fixed 1 MB whatever their number), then joined exactly. Classes of copies are
found only if some pair is in enough rows. The same scan counts the rows that are
surely no copies, a lower bound of n(t): only for terms that the bound does not rule out a
third scan lists the copies that hold them, to count a term once per class. No text is shuffled for it. ``sanitise`` joins the spans of affected rows back
to the texts.

Edge cases: null or empty text has no spans. Repeated rows get equal spans.
Rows with a null doc_id are handled like others. Entities that are in every
document disclose nothing (IC 0). Extra columns are ignored by ``find`` and kept
by ``sanitise``. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillflow.llm import arrays
from tillflow.llm.minhash import copy_classes, row_key
from tillflow.llm.runtime import drop_scratch, fresh, hits, key_bitmap, scratch_table, ship, slices, text_buffer

KINDS = ("email", "ip", "card", "phone")
TERM = 4  # the kind number of a revealing term, listed behind the base kinds


@dataclass(frozen=True)
class Disclosure:
    window: int = 8
    support: int = 3
    generalise: float = 0.75
    remove: float = 0.95
    merge_copies: bool = True  # False where near copies have been taken out before


_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a run of digits either starts a match at its first digit or at none, so later starts are skipped
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def emails(text: str):
    at, free = text.find("@"), 0
    while at >= 0:
        before = text[free:at]
        name = len(before) - len(before.rstrip(_LOCAL))
        m = _DOMAIN.match(text, at + 1) if name else None
        if m:
            yield at - name, m.end()
            free = m.end()
        else:
            free = at + 1
        at = text.find("@", free)


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    even = sum(d * 2 - 9 * (d > 4) for d in map(int, digits[-2::-2]))
    return (odd + even) % 10 == 0


def digits_of(s: str) -> str:
    return "".join(_DIGIT.findall(s))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) in code points, by kind, then start."""
    out = [(0, a, b) for a, b in emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or "0") <= 255 for x in m[0].split(".")):
                out.append((1, m.start(), m.end()))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 16 and 16 <= len(d := digits_of(m[0])) <= 19 and luhn(d):
                out.append((2, m.start(), m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 8 <= len(digits_of(m[0])) <= 15:
                    out.append((3, m.start(), m.end()))
    return out


def _hash(value: str) -> int:
    return int.from_bytes(hashlib.blake2b(value.encode(), digest_size=8).digest(), "little", signed=True)


def entity_of(kind: int, value: str) -> int:
    return _hash(f"{kind}:{value.lower() if kind == 0 else value if kind == 1 else digits_of(value)}")


_LOWER = {i: i + 32 for i in range(65, 91)}


def term_hash(words: list[str]) -> list[int]:
    """The hashes that ``arrays.words`` gives these words after lower-casing A-Z."""
    data = [w.translate(_LOWER).encode() for w in words]
    buf = np.frombuffer(b" ".join(data) + b" ", np.uint8)
    return arrays.words(buf, np.array([0, len(buf)])).hashes.view(np.int64).tolist()


def nearby(text: str, spans: list[tuple[int, int, int]], window: int) -> list[tuple[int, int, int, int]]:
    """(entity, term, start, end) of the words within ``window`` words of each span."""
    out = []
    for kind, a, b in spans:
        right = []
        for m in _WORD.finditer(text, b):
            right.append((m.start(), m.end()))
            if len(right) > window:
                break
        # to the left: enough characters for the window, widened until it holds it
        reach = 16 * (window + 1)
        while True:
            lo = max(0, a - reach)
            left = [(m.start(), m.end()) for m in _WORD.finditer(text, lo, a)]
            if lo == 0 or len(left) > window + 1:
                break
            reach *= 4
        if lo:
            left = left[1:]  # may begin in the middle of a word
        around = left[-window:] + right[:window]
        around = [(s, e) for s, e in around if not any(s < y and x < e for _, x, y in spans)
                  and not (e == a and text[a - 1:a] not in _BLANK) and not (s == b and text[b:b + 1] not in _BLANK)]
        if not around:
            continue
        terms = term_hash([text[s:e] for s, e in around])
        entity = entity_of(kind, text[a:b])
        out += [(entity, t, s, e) for t, (s, e) in zip(terms, around)]
    return out


_BLANK = frozenset(" \t\n\v\f\r") | {""}
_FOUND = ("doc_id long, text_key long, kinds array<int>, starts array<int>, ends array<int>, entities array<long>, "
          "near array<struct<entity:long,term:long,start:int,end:int>>")


def _find_batches(p: Disclosure):
    near_type = pa.list_(pa.struct([("entity", pa.int64()), ("term", pa.int64()), ("start", pa.int32()),
                                    ("end", pa.int32())]))

    def run(batches):
        for batch in batches:
            spans = [base_spans(t) if t else [] for t in batch.column("text").to_pylist()]
            texts = batch.column("text")
            near, ents = [], []  # of the few rows that have spans
            for i, s in enumerate(spans):
                text = texts[i].as_py() if s else ""
                ents.append([entity_of(k, text[a:b]) for k, a, b in s])
                near.append([dict(zip(("entity", "term", "start", "end"), x)) for x in nearby(text, s, p.window)])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"),
                 *[pa.array([[x[k] for x in s] for s in spans], pa.list_(pa.int32())) for k in range(3)],
                 pa.array(ents, pa.list_(pa.int64())), pa.array(near, near_type)],
                ["doc_id", "text_key", "kinds", "starts", "ends", "entities", "near"])
    return run


def _term_rows(batch: pa.RecordBatch, bits: np.ndarray) -> np.ndarray:
    """Distinct (term, row of the slice) pairs, as two rows, of the terms that hit the bitmap."""
    buf, offs = text_buffer(batch.column("text"))
    w = arrays.words(buf, offs, arrays.lower_table())
    slot = (w.hashes & np.uint64(len(bits) * 8 - 1)).astype(np.int64)
    hit = (bits[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 > 0
    return np.unique(np.stack([w.hashes[hit], w.row_of_word()[hit].astype(np.uint64)]), axis=1)


def _count_words(bitmap: bytes, copied: tuple[bytes, int] | None = None):
    """Per slice: (term, rows of the slice that hold it, those of them that are surely no copies)."""
    def run(batches):
        bits = np.frombuffer(bitmap, np.uint8)
        for whole in batches:
            for batch in slices(whole):
                pair = _term_rows(batch, bits)
                own = ~hits(*copied, batch.column("row")) if copied else np.ones(batch.num_rows, bool)
                term, back, n = np.unique(pair[0], return_inverse=True, return_counts=True)
                sure = np.bincount(back, weights=own[pair[1].astype(np.int64)], minlength=len(term)) if len(term) else n
                yield pa.RecordBatch.from_arrays([pa.array(term.view(np.int64)), pa.array(n, pa.int64()), pa.array(sure.astype(np.int64))],
                                                 ["term", "n", "sure"])
    return run


def _terms_of_copies(bitmap: bytes, copied: tuple[bytes, int]):
    """(row, term) of the terms that hit the bitmap, in rows that may be copies: the texts need not move."""
    def run(batches):
        bits = np.frombuffer(bitmap, np.uint8)
        for whole in batches:
            for batch in slices(whole.filter(pa.array(hits(*copied, whole.column("row"))))):
                pair = _term_rows(batch, bits)
                row = batch.column("row").to_numpy()[pair[1].astype(np.int64)]
                yield pa.RecordBatch.from_arrays([pa.array(row, pa.int64()), pa.array(pair[0].view(np.int64))], ["row", "term"])
    return run


BITMAP_BITS = 1 << 23


def bitmap_of(terms: DataFrame) -> bytes:
    """Bitmap of the terms' hashes: at most BITMAP_BITS / 32 rows reach the driver, whatever the number of terms."""
    slot = f"(term & {BITMAP_BITS - 1})"
    got = terms.select(F.expr(f"{slot} div 32").alias("cell"), F.expr(f"shiftleft(1L, cast({slot} % 32 as int))").alias("bit")) \
               .groupBy("cell").agg(F.bit_or("bit").alias("bits")).collect()
    cells = np.zeros(BITMAP_BITS // 32, "<u4")
    for r in got:
        cells[r["cell"]] = r["bits"]
    return cells.tobytes()


def disclosures(docs: DataFrame, found: DataFrame, p: Disclosure = Disclosure()) -> DataFrame:
    """``(entity, term, disclosure)`` of the pairs at or above the lower threshold."""
    near = found.filter(F.size("near") > 0).select(row_key().alias("row"), F.explode("near").alias("x")).select("row", "x.entity", "x.term")
    by_row = near.distinct().groupBy("entity", "term").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= p.support)
    if by_row.isEmpty():
        return near.select("entity", "term", F.lit(0.0).alias("disclosure")).filter("false")
    if p.merge_copies:
        classes = copy_classes(docs)
        total = classes.select("class").distinct().count()
        # written first, so that a join can split a class that holds a third of the rows
        copied = scratch_table(classes.groupBy("class").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("class"), "copied")
        copies = scratch_table(classes.join(copied, "class").select("row", "class").distinct(), "copies")
        drop_scratch(classes, copied)
    else:
        total = docs.count()
        copies = near.select("row", F.lit(0).cast("long").alias("class")).filter("false")

    def count(rows: DataFrame, *keys: str) -> DataFrame:
        """Documents per key, copies counted once."""
        return (rows.join(copies, "row", "left").select(*keys, F.coalesce("class", "row").alias("class")).distinct()
                .groupBy(*keys).agg(F.count(F.lit(1)).alias("n")))

    pairs = scratch_table(count(near, "entity", "term").filter(F.col("n") >= p.support).withColumnRenamed("n", "n_et"), "pairs")
    held = found.filter(F.size("entities") > 0).select(row_key().alias("row"), F.explode("entities").alias("entity"))
    ents = count(held, "entity").withColumnRenamed("n", "n_e")
    keyed = docs.select(row_key().alias("row"), "text")
    copied = key_bitmap(copies.select("row"), "row")
    seen = scratch_table(keyed.mapInArrow(_count_words(bitmap_of(pairs.select("term")), copied), "term long, n long, sure long")
                         .groupBy("term").agg(F.sum("n").alias("n"), F.sum("sure").alias("sure")), "seen")

    def strength(n_t) -> Column:
        ic = F.log2(F.lit(float(max(total, 1))) / F.col("n_e"))
        pmi = F.log2(F.col("n_et") * float(max(total, 1)) / (F.col("n_e") * n_t))
        return F.when(ic > 0, pmi / F.when(ic > 0, ic))

    # a term is in at least as many documents as surely no copies hold it, and at least in those of the pair: most pairs
    # cannot reach the threshold, and copies are looked at for the terms of the others only
    able = scratch_table(pairs.join(seen, "term").join(ents, "entity")
                         .filter(strength(F.greatest("sure", "n_et")) >= p.generalise), "able")
    if not p.merge_copies or able.isEmpty():
        terms = able.select("term", F.col("n").alias("n_t")).distinct()
    else:
        # all rows that hold a term; for copies their rows taken off and their classes added (equal rows are one in copies)
        once = (keyed.mapInArrow(_terms_of_copies(bitmap_of(able.select("term")), copied), "row long, term long")
                .join(copies, "row").groupBy("term", "class").agg(F.count(F.lit(1)).alias("n"))
                .groupBy("term").agg(F.sum(F.col("n") - 1).alias("more")))
        terms = able.select("term", "n").distinct().join(once, "term", "left").select("term", (F.col("n") - F.coalesce("more", F.lit(0))).alias("n_t"))
    told = able.drop("n", "sure").join(terms, "term").select("entity", "term", strength(F.col("n_t")).alias("disclosure"))
    return told.filter(F.col("disclosure") >= p.generalise)


def find(docs: DataFrame, p: Disclosure = Disclosure()) -> DataFrame:
    """Spans per row: ``(doc_id, text_key, kinds, starts, ends, terms)``.

    The arrays hold the base spans by kind, then start; ``terms`` holds ``(start, end, disclosure)`` of the
    revealing terms by start.
    """
    ship(docs.sparkSession)
    narrow = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"))
    found = scratch_table(narrow.mapInArrow(_find_batches(p), _FOUND), "entities")
    told = disclosures(narrow, found, p)
    near = found.filter(F.size("near") > 0).select("doc_id", "text_key", F.explode("near").alias("x")) \
                .select("doc_id", "text_key", "x.entity", "x.term", "x.start", "x.end")
    spans = (near.join(told, ["entity", "term"]).groupBy("doc_id", "text_key", "start", "end").agg(F.max("disclosure").alias("disclosure"))
             .groupBy("doc_id", "text_key").agg(F.sort_array(F.collect_list(F.struct("start", "end", "disclosure"))).alias("terms")))
    a, b = found.drop("near", "entities").alias("a"), spans.alias("b")
    joined = a.join(b, F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col("a.text_key") == F.col("b.text_key")), "left")
    empty = F.array().cast("array<struct<start:int,end:int,disclosure:double>>")
    return joined.select("a.*", F.coalesce("b.terms", empty).alias("terms"))


def replace_spans(text: str, spans: list[tuple[int, int, str]]) -> str:
    """Replace (start, end, placeholder) spans; overlapping ones merge under the first's placeholder."""
    out, at, merged = [], 0, []
    for a, b, name in sorted(spans):
        if merged and a < merged[-1][1]:
            merged[-1][1] = max(b, merged[-1][1])
        else:
            merged.append([a, b, name])
    for a, b, name in merged:
        out += [text[at:a], name]
        at = b
    return "".join(out) + text[at:]


def _sanitise_batches(p: Disclosure, marks: list[str]):
    names = [f"<{k.upper()}>" for k in KINDS]

    def run(batches):
        for batch in batches:
            texts = batch.column("text").to_pylist()
            extra = [batch.column(c).to_pylist() for c in marks]
            changed = [False] * len(texts)
            for i, (kinds, starts, ends, terms) in enumerate(zip(*extra)):
                spans = [(a, b, names[k]) for k, a, b in zip(kinds or (), starts or (), ends or ())]
                spans += [(t["start"], t["end"], "" if t["disclosure"] >= p.remove else "<TERM>") for t in terms or ()]
                if spans:
                    texts[i], changed[i] = replace_spans(texts[i], spans), True
            cols = {c: batch.column(c) for c in batch.schema.names if c not in marks}
            cols["text"] = pa.array(texts, batch.schema.field("text").type)
            if "n_chars" in cols:
                cols["n_chars"] = pa.array([len(t) if x else n for t, x, n in zip(texts, changed, cols["n_chars"].to_pylist())],
                                           cols["n_chars"].type)
            yield pa.RecordBatch.from_arrays(list(cols.values()), list(cols))
    return run


def sanitise(docs: DataFrame, p: Disclosure = Disclosure()) -> DataFrame:
    """``docs`` with base entities and revealing terms replaced in ``text``; same rows and columns."""
    id_, key, *marks = fresh(docs, "_id", "_key", "_kinds", "_starts", "_ends", "_terms")
    found = find(docs, p).filter((F.size("kinds") > 0) | (F.size("terms") > 0)) \
        .select("doc_id", "text_key", "kinds", "starts", "ends", "terms").toDF(id_, key, *marks).dropDuplicates([id_, key])
    joined = docs.join(found, F.col("doc_id").eqNullSafe(F.col(id_)) & (F.xxhash64("text") == F.col(key)), "left") \
                 .select(*docs.columns, *marks)
    return joined.mapInArrow(_sanitise_batches(p, marks), docs.schema)


def span_digest(kinds: list[int], starts: list[int], ends: list[int]) -> str:
    """The text form of spans: kind:start:end, comma-joined."""
    names = (*KINDS, "term")
    return ",".join(f"{names[k]}:{a}:{b}" for k, a, b in zip(kinds, starts, ends))


def max_disclosure(n: int, n_e: int, n_t: int, n_et: int) -> float:
    """The formula of the module, for tests."""
    return math.log2(n * n_et / (n_e * n_t)) / math.log2(n / n_e)
