"""Language identification by cross-parsing against suffix automata.

For every language a suffix automaton of labelled text recognises exactly the
substrings of that text. A document is cross-parsed (Ziv-Merhav): from each
position the longest match is taken as one phrase, and the parse goes on behind
it. Few phrases mean that the language's text explains the document; the
normalised count ``phrases * log2(n) / length`` (n: size of the language's
text) estimates the cross entropy per character, and the least one wins (ties:
alphabetical order).

A greedy parse needs no suffix links: a missing transition ends the phrase and
starts the next one at the root. Folding that rule into the transition table
gives one deterministic machine per language, and all of them run in lockstep
over many pieces of text with one table lookup per character. Texts are
normalised (lower case, letters kept, anything else one space) and parsed in
blocks of ``block`` characters; a phrase does not cross a block border, for any
language alike, so a text of any length is parsed whole in bounded memory.

Training takes a bounded sample: about ``sample_rows`` labelled rows per
language (by hash of id and text, equal rows once, never more than four times as many in all), a window of at most ``sample_window`` characters
of each, and at most ``train_chars`` normalised characters per language.

Edge cases: null, empty or letterless text is ``und`` with score 0. Rows whose
label is null teach nothing. ``fold`` is null for a null doc_id. Without any labelled row every text is ``und``.
With one learned language the score of a text with letters is 1. Repeated rows
get equal results; extra columns are ignored; an empty table gives an empty
result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.llm.runtime import ship, slices


@dataclass(frozen=True)
class LangParams:
    sample_rows: int = 120
    sample_window: int = 2000
    train_chars: int = 1 << 16
    block: int = 1024


def suffix_automaton(text: list[int]) -> list[dict[int, int]]:
    """Transitions of the minimal automaton of all substrings of ``text`` (state 0 is the root)."""
    nxt: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in text:
        cur = len(nxt)
        nxt.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][c]
            if length[q] == length[p] + 1:
                link[cur] = q
            else:
                clone = len(nxt)
                nxt.append(dict(nxt[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p >= 0 and nxt[p].get(c) == q:
                    nxt[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    return nxt


_STATE: dict = {}


def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    if "letters" not in _STATE:
        _STATE["letters"] = np.array([chr(c).isalpha() for c in range(0x110000)], bool)
    return _STATE["letters"]


def normal_codes(text: str) -> np.ndarray:
    """Code points of the normalised text; 0 stands for the run between letters."""
    # some characters lower-case to a letter and a mark: the mark is a separator like any other non-letter
    codes = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    codes = np.where(_letters()[codes], codes, 0)
    if not codes.any():
        return codes[:0]
    keep = codes != 0
    keep[1:] |= codes[:-1] != 0
    keep[0] = codes[0] != 0
    return codes[keep]


class Parser:
    """The languages' parsing machines over one shared alphabet."""

    def __init__(self, samples: dict[str, list[str]], p: LangParams):
        self.block = p.block
        self.langs = sorted(samples)
        text = {}
        for lang in self.langs:
            parts = [normal_codes(t) for t in samples[lang]]
            joined = np.concatenate([np.append(x, 0) for x in parts if len(x)] or [np.zeros(0, np.uint32)])
            text[lang] = joined[:p.train_chars]
        self.langs = [x for x in self.langs if len(text[x])]
        known = np.unique(np.concatenate([text[x] for x in self.langs])) if self.langs else np.zeros(1, np.uint32)
        known = known[known > 0][:65000]
        # alphabet: 0 = separator, 1..k known letters, k + 1 = any other letter
        self.width = len(known) + 2
        self.code_class = np.zeros(0x110000, np.uint16)
        self.code_class[_letters()] = self.width - 1
        self.code_class[known] = np.arange(1, len(known) + 1)
        self.bits = [math.log2(max(2, len(text[x]))) for x in self.langs]
        tables, self.roots, base = [], [], 0
        for lang in self.langs:
            nxt = suffix_automaton(self.code_class[text[lang]].tolist())
            n = len(nxt)
            # entry: (next row << 1) | 1 if the phrase before this character ends; row n: behind an unseen letter
            miss = np.full(self.width, n, np.int64)
            for c, t in nxt[0].items():
                miss[c] = t
            table = np.tile(((miss + base) << 1) | 1, (n + 1, 1))
            table[0] = (miss + base) << 1
            state = np.repeat(np.arange(n), [len(d) for d in nxt])
            char = np.fromiter(chain.from_iterable(nxt), np.int64, len(state))
            to = np.fromiter(chain.from_iterable(d.values() for d in nxt), np.int64, len(state))
            table[state, char] = (to + base) << 1
            tables.append(table)
            self.roots.append(base)
            base += n + 1
        full = np.concatenate(tables) if tables else np.zeros((0, self.width), np.int64)
        # rows are stored multiplied by the width, so a lookup is one addition
        self.table = (((full >> 1) * self.width << 1) | (full & 1)).astype(np.int64 if base * self.width > 2**29 else np.int32).ravel()
        self.root = np.array(self.roots, np.int64)[:, None] * self.width

    def phrases(self, blocks: list[np.ndarray]) -> np.ndarray:
        """Phrase counts (languages x blocks) of blocks of code classes, each of at least one character."""
        size = np.array([len(b) for b in blocks])
        order = np.argsort(-size, kind="stable")
        grid = np.zeros((int(size.max()), len(blocks)), np.uint16)
        for col, k in enumerate(order):
            grid[:size[k], col] = blocks[k]
        alive = np.searchsorted(-size[order], -np.arange(grid.shape[0]), side="left")
        row = np.repeat(self.root, len(blocks), axis=1).astype(self.table.dtype)
        count = np.ones((len(self.langs), len(blocks)), np.int32)
        for t in range(grid.shape[0]):
            n = alive[t]
            entry = self.table.take(row[:, :n] + grid[t, :n])
            count[:, :n] += entry & 1
            row = entry >> 1
        out = np.empty_like(count)
        out[:, order] = count
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        blocks, owner, length = [], [], np.zeros(len(texts), np.int64)
        for i, t in enumerate(texts):
            x = self.code_class[normal_codes(t)] if t and self.langs else ()
            length[i] = len(x)
            for a in range(0, len(x), self.block):
                blocks.append(x[a:a + self.block])
                owner.append(i)
        langs, scores = ["und"] * len(texts), [0.0] * len(texts)
        if not blocks:
            return langs, scores
        counts = self.phrases(blocks)
        total = np.zeros((len(self.langs), len(texts)), np.int64)
        for k in range(len(self.langs)):
            total[k] = np.bincount(owner, weights=counts[k], minlength=len(texts)).astype(np.int64)
        cost = total * np.array(self.bits)[:, None] / np.maximum(length, 1)
        for i in np.flatnonzero(length > 0):
            best = int(cost[:, i].argmin())
            langs[i] = self.langs[best]
            others = np.delete(cost[:, i], best)
            # 0: the runner-up explains the text as well; towards 1: far worse
            scores[i] = float(1 - cost[best, i] / others.min()) if len(others) else 1.0
        return langs, scores


def sample_labelled(labelled: DataFrame, p: LangParams) -> dict[str, list[str]]:
    """Bounded sample of (text, lang) rows: windows of text per language."""
    rows = labelled.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & (F.length("text") > 0))
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return {}
    grid = 1 << 30
    limit = F.create_map(*[x for lang, n in counts.items()
                           for x in (F.lit(lang), F.lit(int(grid * min(1.0, p.sample_rows / n))))])[F.col("lang")]
    key = F.xxhash64("doc_id", F.xxhash64("text"))
    draw = F.pmod(F.xxhash64(key, F.lit(5)), F.lit(grid))
    room = F.greatest(F.length("text") - p.sample_window, F.lit(0)) + 1
    window = F.substring("text", (F.pmod(F.xxhash64(key, F.lit(6)), room) + 1).cast("int"), F.lit(p.sample_window))
    # equal rows count once; about sample_rows per language are drawn, and four times as many are the bound of what is collected
    got = (rows.filter(draw < limit).select("lang", window.alias("w"), draw.alias("d")).distinct()
           .orderBy("d", "lang", "w").limit(4 * p.sample_rows * len(counts)).collect())
    out: dict[str, list[str]] = {}
    for r in sorted(got, key=lambda r: (r["d"], r["w"])):
        out.setdefault(r["lang"], []).append(r["w"])
    return out


def identify(docs: DataFrame, labelled: DataFrame, p: LangParams = LangParams()) -> DataFrame:
    """``(doc_id, lang_pred, score)`` of every row of ``docs``, learned from ``labelled`` (doc_id, text, lang)."""
    ship(docs.sparkSession)
    samples = sample_labelled(labelled, p)

    def run(batches):
        key = (p, tuple((k, tuple(v)) for k, v in sorted(samples.items())))
        if _STATE.get("key") != key:
            _STATE["key"], _STATE["parser"] = key, Parser(samples, p)
        parser = _STATE["parser"]
        for whole in batches:
            for batch in slices(whole, max_bytes=6 << 20):
                langs, scores = parser.predict(batch.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(langs, pa.string()),
                                                  pa.array(scores, pa.float64())], ["doc_id", "lang_pred", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, lang_pred string, score double")


def fold(column: str = "doc_id"):
    """crc32 of the id as text, modulo 5; 0 is held out."""
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(5))
