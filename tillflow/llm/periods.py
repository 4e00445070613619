"""Runs of periodically repeated words, found in tiles scaled to their period.

A run is a maximal stretch of words with smallest period q and at least
``max(least_words, 4 q)`` words. Word i *matches* at period p if it equals word
i + p; a run of period p is a maximal interval of at least 3 p matches (5 where
p is 1), and its block of p words is no repetition of a shorter one.

Scale-tiled search: periods are grouped by octave [B, 2B), B a power of two. For
each octave a document is cut at the multiples of B, and the tile of the cut c
reaches from one step B left of c to 3B + 2B words right of it. Any run of the
octave has 3B matches or more, so at some cut it matches for two whole steps; only
such tiles (found by hashes of 2B words) are solved. Two boundary Z-functions at
the cut give, for all periods of the octave at once, how far the match reaches to
the right (at most 3B) and to the left (at most B): an interval fragment. The same Z-function
tells whether the block at the cut is primitive; others belong to a shorter period.
Fragments of neighbouring tiles overlap, so the fragments of a (document, period),
brought together by an exchange, are stitched by a running maximum into runs.

Documents beyond ``Periods.span_words`` words are dealt to several tasks: they are
exploded into overlapping spans (wider ones for the larger octaves, so that all spans
together hold a document about twice per level), shuffled, and their tiles solved
span by span. The others' tiles are solved where the text is read; only fragments move.

Edge cases: null or empty text, or white space only, has no words and no runs.
Rows are told apart by a number of their own, so null or repeated doc_ids are
row by row. Of equally long runs the one with the smallest start, then period,
leads. Extra columns are ignored, whatever their names; an empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillflow.llm.arrays import mix
from tillflow.llm.runtime import scratch_table, ship, slices

BLANKS = r"[\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Periods:
    least_words: int = 6
    exponent: int = 4
    span_words: int = 1 << 16


def z_function(s: list) -> list[int]:
    """z[i]: the longest common prefix of s and s[i:]."""
    n = len(s)
    z = [0] * n
    if n:
        z[0] = n
    left = right = 0
    for i in range(1, n):
        k = min(right - i, z[i - left]) if i < right else 0
        if i + k >= right:
            while i + k < n and s[k] == s[i + k]:
                k += 1
            left, right = i, i + k
        z[i] = k
    return z


def solve_tile(ids: list, c: int, step: int, periods: list[int]) -> list[tuple[int, int, int]]:
    """(period, start, end) of the match intervals around the cut c for the given periods of an octave, primitive blocks only."""
    ahead = z_function(ids[c:c + 5 * step])
    low = max(0, c - step)
    back = ids[low:c][::-1]
    behind = z_function(back + [-1] + ids[low:c + 2 * step][::-1]) if back else []
    last = min(c + 2 * step, len(ids)) - 1
    out = []
    for p in periods:
        # the block ids[c:c + p] is a power if a shorter period divides p and reaches its end
        if any(p % q == 0 and ahead[q] >= p - q for q in range(1, p // 2 + 1)):
            continue
        left = min(behind[len(back) + 1 + last - (c + p - 1)], step) if back and c + p - 1 <= last else 0
        out.append((p, c - left, c + min(ahead[p], 3 * step)))
    return out


def fragments(ids: np.ndarray, first_step: int = 1, last_step: int = 1 << 62, core: tuple[int, int] | None = None) -> list[tuple[int, int, int]]:
    """(period, start, end) match intervals of one sequence of word numbers, neighbours merged.

    Steps (octaves) from ``first_step`` to ``last_step`` are searched, at the cuts within ``core``.
    """
    n, step, out = len(ids), first_step, []
    lo, hi = core or (0, n)
    listed = None
    total = np.zeros(n + 1, np.uint64)
    with np.errstate(over="ignore"):
        weight = np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(n, _BASE)]))
        np.cumsum(mix(ids.astype(np.uint64) + np.uint64(1)) * weight[:n], out=total[1:])
        while step <= last_step and 4 * step <= n:
            cuts = np.arange(-(-lo // step) * step, min(hi, n - 3 * step + 1), step)  # the least period still fits
            if len(cuts):
                reach = np.arange(step, 2 * step)
                pos = cuts[:, None] + reach
                fits = pos + 2 * step <= n
                pos = np.minimum(pos, n - 2 * step)
                # hashes of 2 * step words, brought to a common power of the base
                here = (total[cuts + 2 * step] - total[cuts])[:, None] * weight[reach]
                same = fits & (here == total[pos + 2 * step] - total[pos])
                for t in np.flatnonzero(same.any(axis=1)):
                    if listed is None:
                        listed = ids.tolist()
                    out += solve_tile(listed, int(cuts[t]), step, (np.flatnonzero(same[t]) + step).tolist())
            step *= 2
    return merged(out)


_BASE = np.uint64(0x9E3779B97F4A7C15)


def merged(parts: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    out: list[list[int]] = []
    for p, a, b in sorted(parts):
        if out and out[-1][0] == p and a <= out[-1][2]:
            out[-1][2] = max(out[-1][2], b)
        else:
            out.append([p, a, b])
    return [tuple(x) for x in out]


def numbers(words: list[bytes]) -> np.ndarray:
    seen: dict[bytes, int] = {}
    return np.array([seen.setdefault(w, len(seen)) for w in words], np.int64)


_FRAGMENT = pa.list_(pa.struct([("period", pa.int64()), ("a", pa.int64()), ("b", pa.int64())]))
_SOLVED = "doc_id long, n_words long, whole_sha256 string, long_text boolean, text string, parts array<struct<period:long,a:long,b:long>>"


def _solve_batches(p: Periods):
    def run(batches):
        for whole in batches:
            for batch in slices(whole):
                n, digest, far, keep, parts = [], [], [], [], []
                for text in batch.column("text").to_pylist():
                    words = (text or "").encode().split()
                    n.append(len(words))
                    digest.append(hashlib.sha256(b" ".join(words)).hexdigest())
                    far.append(len(words) > p.span_words)
                    found = fragments(numbers(words)) if len(words) >= p.least_words and not far[-1] else []
                    keep.append(text if found or far[-1] else None)
                    parts.append([dict(zip(("period", "a", "b"), x)) for x in found])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(digest, pa.string()), pa.array(far, pa.bool_()),
                     pa.array(keep, pa.string()), pa.array(parts, _FRAGMENT)],
                    ["doc_id", "n_words", "whole_sha256", "long_text", "text", "parts"])
    return run


_SPAN = "row long, place long, first long, core_from int, core_to int, first_step long, last_step long, words string"


def spans_of(n: int, size: int):
    """(from, to, core from, core to, first step, last step) of the spans of n words; from and to bound the words sent."""
    lo_step, width = 1, size
    while 4 * lo_step <= n:
        hi_step = lo_step
        while 16 * hi_step <= width:  # a tile of the widest step takes at most three eighths of the core besides it
            hi_step *= 2
        for a in range(0, n, width):
            b = min(n, a + width)
            low = max(0, a - hi_step)
            yield low, min(n, b + 5 * hi_step), a - low, b - low, lo_step, hi_step
        lo_step, width = 2 * hi_step, 4 * width


def _span_batches(p: Periods):
    def run(batches):
        for batch in batches:
            for row, text in zip(batch.column("row").to_pylist(), batch.column("text").to_pylist()):
                words = text.encode().split()
                for place, (a, b, *rest) in enumerate(spans_of(len(words), p.span_words)):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([row]), pa.array([place]), pa.array([a]), *[pa.array([x], t) for x, t in zip(rest, (pa.int32(), pa.int32(), pa.int64(), pa.int64()))],
                         pa.array([b" ".join(words[a:b]).decode()])],
                        ["row", "place", "first", "core_from", "core_to", "first_step", "last_step", "words"])
    return run


def _span_fragments(batches):
    for batch in batches:
        rows = []
        for x in batch.to_pylist():
            ids = numbers(x["words"].encode().split())
            # a run that the span's edges cut ends at a match, so its pieces touch the neighbours'
            rows += [(x["row"], q, a + x["first"], b + x["first"])
                     for q, a, b in fragments(ids, x["first_step"], x["last_step"], (x["core_from"], x["core_to"]))]
        cols = list(zip(*rows)) or [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["row", "period", "a", "b"])


def stitch(parts: DataFrame, p: Periods) -> DataFrame:
    """Fragments ``(row, period, a, b)`` -> runs ``(row, start, length, period)``."""
    mine = Window.partitionBy("row", "period").orderBy("a", "b")
    reached = F.max("b").over(mine.rowsBetween(Window.unboundedPreceding, -1))
    begun = parts.withColumn("new", (reached.isNull() | (F.col("a") > reached)).cast("int"))
    part = F.sum("new").over(mine.rowsBetween(Window.unboundedPreceding, 0))
    length = F.max("b") - F.min("a") + F.col("period")
    return (begun.withColumn("part", part).groupBy("row", "period", "part")
            .agg(F.min("a").alias("start"), length.alias("length"))
            .filter(F.col("length") >= F.greatest(F.lit(p.least_words), p.exponent * F.col("period")))
            .select("row", "start", "length", "period"))


def find_runs(docs: DataFrame, p: Periods = Periods()) -> tuple[DataFrame, DataFrame]:
    """``(solved, runs)``: a row per row of ``docs`` (numbered by ``row``), and the runs ``(row, start, length, period)``.

    ``solved`` holds doc_id, n_words, the digest of all words joined by one space, and
    the text of rows that may have runs.
    """
    ship(docs.sparkSession)
    solved = docs.select("doc_id", "text").mapInArrow(_solve_batches(p), _SOLVED).withColumn("row", F.monotonically_increasing_id())
    solved = scratch_table(solved, "solved")
    near = solved.filter(F.size("parts") > 0).select("row", F.explode("parts").alias("x")).select("row", "x.*")
    spans = solved.filter("long_text").select("row", "text").mapInArrow(_span_batches(p), _SPAN).repartition("row", "place")
    far = spans.mapInArrow(_span_fragments, "row long, period long, a long, b long")
    return solved.drop("parts"), stitch(near.unionByName(far), p)


def _collapse_batches(batches):
    for batch in batches:
        out = []
        for text, runs in zip(batch.column("text").to_pylist(), batch.column("runs").to_pylist()):
            words = text.encode().split()
            keep = np.ones(len(words), bool)
            for r in runs:
                keep[r["start"] + r["period"]:r["start"] + r["length"]] = False
            out.append(b" ".join([words[i] for i in np.flatnonzero(keep)]).decode())
        yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("runs"), pa.array(out, pa.string())], ["row", "runs", "collapsed"])


def collapse(solved: DataFrame, runs: DataFrame) -> DataFrame:
    """Rows with a run: ``(row, runs, collapsed)``; ``runs`` by start, then period, and the text without repeated blocks."""
    listed = runs.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "period", "length"))).alias("runs"))
    both = solved.filter("text is not null").select("row", "text").join(listed, "row")
    return both.mapInArrow(_collapse_batches, "row long, runs array<struct<start:long,period:long,length:long>>, collapsed string")


def digest_runs(docs: DataFrame, p: Periods = Periods()) -> DataFrame:
    """Per row: doc_id, n_runs, the leading run, and the digests of all runs and of the collapsed text."""
    solved, runs = find_runs(docs, p)
    found = collapse(solved, runs)
    lead = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")))
    told = found.select("row", F.size("runs").cast("long").alias("n"), lead.alias("lead"),
                        F.sha2(F.concat(F.array_join(lines, "\n"), F.lit("\n")), 256).alias("all_runs"),
                        F.sha2("collapsed", 256).alias("kept_words"))
    length, period = F.col("lead.length"), -F.col("lead.period")
    return solved.select("row", "doc_id", "whole_sha256").join(told, "row", "left").select(
        "doc_id", F.coalesce("n", F.lit(0).cast("long")).alias("n_runs"), (-F.col("lead.start")).alias("start"), length.alias("length"),
        period.alias("period"), F.expr("1000 * lead.length div -lead.period").alias("exponent_milli"),
        F.coalesce("all_runs", F.sha2(F.lit(""), 256)).alias("runs_sha256"),
        F.coalesce("kept_words", "whole_sha256").alias("collapsed_sha256"))


def planted(text: Column, doc_id: Column) -> Column:
    """The words of every tenth document (by crc32 of doc_id) repeated periodically from some word on; other texts as they are."""
    h = F.crc32(doc_id.cast("string"))
    words = F.filter(F.split(text, BLANKS), lambda w: w != "")

    def repeated(x):
        w, g = x["w"], x["g"]
        n = F.size(w).cast("long")
        a = g % n
        period = 1 + F.floor((n - a) / (3 + g % 8))
        place = F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.when(i < a, i).otherwise(a + (i - a) % period))
        return F.when(n > 0, F.array_join(F.transform(place, lambda i: F.get(w, i.cast("int"))), " ")).otherwise(F.lit(""))

    # a lambda over one cell, so that the words are split once
    cell = F.array(F.struct(words.alias("w"), F.floor(h / 10).alias("g")))
    return F.when((h % 10 == 0) & text.isNotNull(), F.get(F.transform(cell, repeated), 0)).otherwise(text)
