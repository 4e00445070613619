"""Removal of repeated passages: sorted suffixes of anchors, merged with known prefixes.

A window is ``length`` (400) bytes of a text. Windows that occur anywhere else are
repeated, and every byte that a repeated window covers is removed.

*Anchors.* The anchor of a window is the leftmost position of least 8-byte hash
among its first ``spread`` positions. It depends on the window's bytes alone, so
equal windows have their anchors at equal distances d from their starts. A run of
neighbouring windows has one anchor x, with distances from ``dlo`` to ``dhi``; about
one position in spread / 2 is an anchor. So it is enough to order the suffixes
that start at anchors: two windows are equal exactly if, at their anchors, d
bytes agree to the left and length - d to the right.

*Jobs.*

1. One scan hashes, per anchor, the ``length - spread + 1`` bytes that every window
   of it holds to the right (``near``), and all bytes of its windows (``ctx``).
   Anchors whose ``near`` occurs once are left aside; equal ``ctx`` form a class, all
   of whose windows are repeated if it has two members. One member of each class
   stands for it, in clusters of equal ``near`` that have a class of one.
2. The representatives' suffixes are sorted in memory-bounded runs, front-coded (bytes
   shared with the suffix before, then the rest), cut at splitters of the
   representatives' range and exchanged.
3. Every range merges its runs with a loser tree whose entries carry the prefix
   they share with the last winner: unequal lengths decide without reading a byte, equal
   ones go on comparing behind them, so a known prefix is never compared again. The
   merge yields the common prefix of neighbours.
4. In that order, for growing d, the members of a cluster are refined by the d-th byte to the
   left; the nearest in order that agree to the left have the longest common
   prefix (the least of those between), and if that reaches length - d the window is repeated.

Equal texts are one text in the later jobs: texts are named by two 64-bit hashes, and
only texts with a repeated anchor are shuffled. Classes and names rest on 64-bit and
128-bit hashes; clusters, which only gather candidates, on hashes alone.

A cluster is merged by one task: at most the *different* surroundings of one
``spread``-byte passage's place, after equal ones have become one class. Beyond
``cluster_rows`` members it is cut: windows of a range of distances [b, e) share b bytes to the left of the
anchor and length - e + 1 to its right, so members become members of finer clusters
at the origin x - b, one for each of the ranges, down to single windows, which are counted.

Edge cases: null text is empty; texts shorter than ``length`` are kept whole. Rows that repeat
a doc_id are texts of their own, and equal rows repeat each other. Null doc_ids are
carried through. Extra columns are ignored, whatever their names; an empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.llm import arrays
from tillflow.llm.runtime import drop_scratch, key_filter, scratch_table, ship, slices, text_buffer, trim_memory


@dataclass(frozen=True)
class Passages:
    length: int = 400
    spread: int = 256
    part_rows: int = 40_000
    run_rows: int = 40_000
    cluster_rows: int = 65_536
    ranges: int = 8
    splitters: int = 1024

    @property
    def near(self) -> int:
        return self.length - self.spread + 1


# ---- anchors ------------------------------------------------------------------------------------------------------

CHUNK = 1 << 20


def sliding_min(a: np.ndarray, w: int) -> np.ndarray:
    """Least of a[i:i + w] for every i with w values from it on."""
    n = len(a)
    full = np.full(-(-n // w) * w, np.iinfo(a.dtype).max, a.dtype)
    full[:n] = a
    blocks = full.reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n - w + 1], ahead[w - 1:n])


def anchors(buf: np.ndarray, offs: np.ndarray, p: Passages) -> np.ndarray:
    """Rows (text, x, dlo, dhi, near, ctx) as int64, x within its text, in order."""
    out = []
    end_of = offs[1:]
    for c in range(0, len(buf), CHUNK):
        part = buf[c:c + CHUNK + p.length + p.spread]
        n = len(part)
        count = min(CHUNK, n - p.length + 1)
        if count <= 0:
            break
        start = np.arange(count)
        text = np.searchsorted(end_of, start + c, side="right")
        fits = np.flatnonzero(end_of[text] - c - start >= p.length)
        if not len(fits):
            continue
        grams = np.lib.stride_tricks.as_strided(np.concatenate([part, np.zeros(8, np.uint8)]), (n, 8), (1, 1))
        with np.errstate(over="ignore"):
            key = arrays.mix(np.ascontiguousarray(grams).view("<u8").ravel())
        bits = np.uint64(n.bit_length())
        key = ((key >> bits) << bits) | np.arange(n, dtype=np.uint64)
        at = (sliding_min(key, p.spread)[fits] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        last = np.concatenate([first[1:] - 1, [len(fits) - 1]])
        x, lo, hi = at[first], fits[first], fits[last]
        with np.errstate(over="ignore"):
            sums = arrays.prefix(arrays._weights()[part])
            near = arrays.span_hash(sums, x, x + p.near)
            ctx = arrays.span_hash(sums, lo, hi + p.length)
        t = text[lo]
        out.append(np.stack([t, x + c - offs[t], x - hi, x - lo, near.view(np.int64), ctx.view(np.int64)], axis=1))
    return np.concatenate(out) if out else np.zeros((0, 6), np.int64)


_ANCHORS = "t1 long, t2 long, list array<struct<x:int,dlo:int,dhi:int,near:long,ctx:long>>"
_ANCHOR_TYPE = pa.struct([("x", pa.int32()), ("dlo", pa.int32()), ("dhi", pa.int32()), ("near", pa.int64()), ("ctx", pa.int64())])


def _anchor_batches(p: Passages):
    def run(batches):
        for whole in batches:
            for batch in slices(whole):
                buf, offs = text_buffer(batch.column("text"))
                found = anchors(buf, offs, p)
                rows = pa.StructArray.from_arrays([pa.array(found[:, k], f.type, safe=False) for k, f in zip(range(1, 6), _ANCHOR_TYPE)],
                                                  fields=list(_ANCHOR_TYPE))
                at = np.searchsorted(found[:, 0], np.arange(batch.num_rows + 1))
                yield pa.RecordBatch.from_arrays([batch.column("t1"), batch.column("t2"),
                                                  pa.ListArray.from_arrays(pa.array(at, pa.int32()), rows)], ["t1", "t2", "list"])
    return run


# ---- sorted runs --------------------------------------------------------------------------------------------------

_ENTRY = struct.Struct("<HHqHHH")  # shared, rest, id, dlo, dhi, bytes to the left


def common(a: bytes, b: bytes, k: int) -> int:
    """Length of the common prefix of a and b, of which k bytes are known."""
    n = min(len(a), len(b))
    differ = int.from_bytes(a[k:n], "big") ^ int.from_bytes(b[k:n], "big")
    return n - (differ.bit_length() + 7) // 8


def front_code(items: list[tuple[bytes, int, int, int, bytes]]) -> bytes:
    """Sorted (suffix, id, dlo, dhi, left) -> one blob: bytes shared with the suffix before, then the rest."""
    out, before = [], b""
    for suffix, id_, dlo, dhi, left in items:
        k = common(before, suffix, 0)
        out += [_ENTRY.pack(k, len(suffix) - k, id_, dlo, dhi, len(left)), suffix[k:], left]
        before = suffix
    return b"".join(out)


def decode(blob: bytes) -> Iterator[tuple[int, bytes, int, int, int, bytes]]:
    """(shared with the one before, suffix, id, dlo, dhi, left) of a front-coded run."""
    at, suffix = 0, b""
    while at < len(blob):
        k, rest, id_, dlo, dhi, n = _ENTRY.unpack_from(blob, at)
        at += _ENTRY.size
        suffix = suffix[:k] + blob[at:at + rest]
        at += rest
        yield k, suffix, id_, dlo, dhi, blob[at:at + n]
        at += n


class LoserTree:
    """Merges sorted runs; ``known[r]`` is the prefix that run r's head shares with the winner it was last compared to."""

    def __init__(self, runs: list[Iterator]):
        self.size = 1
        while self.size < len(runs):
            self.size *= 2
        self.runs = runs
        self.head = [next(r, None) for r in runs] + [None] * (self.size - len(runs))
        self.known = [0] * self.size
        self.loser = [0] * self.size
        self.compared = 0  # bytes that were read to decide
        winners = list(range(self.size))
        level = self.size
        while level > 1:
            level //= 2
            for i in range(level):
                winners[i], self.loser[level + i] = self._play(winners[2 * i], winners[2 * i + 1])
        self.best = winners[0]

    def _play(self, a: int, b: int) -> tuple[int, int]:
        """(winner, loser): the one that shares more with the last winner is the less; if they share the same, the bytes behind decide."""
        x, y = self.head[a], self.head[b]
        if x is None or y is None:
            return (b, a) if x is None else (a, b)
        k, m = self.known[a], self.known[b]
        if k != m:
            return (a, b) if k > m else (b, a)
        s, t = x[1], y[1]
        m = common(s, t, k)
        self.compared += m - k
        first = a if s[m:m + 1] <= t[m:m + 1] else b
        last = b if first == a else a
        self.known[last] = m
        return first, last

    def __iter__(self):
        while (item := self.head[self.best]) is not None:
            r = self.best
            yield self.known[r], item
            following = next(self.runs[r], None)
            self.head[r] = following
            self.known[r] = following[0] if following else 0
            i = (r + self.size) // 2
            while i >= 1 and self.size > 1:
                r, self.loser[i] = self._play(r, self.loser[i])
                i //= 2
            self.best = r


_PART = "part long, run binary"


def _cut(sorted_items: list, splitters: list[bytes], spread: int, p: Passages, near: dict[int, int]) -> dict[int, bytes]:
    """Parts of a sorted run: the range of the suffix's first bytes, ranges cut again by cluster where there are ``spread`` parts to each."""
    import bisect

    parts: dict[int, list] = {}
    for x in sorted_items:
        at = bisect.bisect_right(splitters, x[0][:p.near]) * spread + near[x[1]] % spread
        parts.setdefault(at, []).append(x)
    return {k: front_code(v) for k, v in parts.items()}


def _run_batches(p: Passages, splitters: list[bytes], spread: int):
    def run(batches):
        items: list = []
        near: dict[int, int] = {}

        def flush():
            items.sort()
            cut = _cut(items, splitters, spread, p, near)
            items.clear()
            near.clear()
            return pa.RecordBatch.from_arrays([pa.array(list(cut), pa.int64()), pa.array(list(cut.values()), pa.binary())], ["part", "run"])

        for batch in batches:
            for text, members in zip(batch.column("text"), batch.column("members")):
                data = text.as_py().encode()
                for m in members.as_py():
                    x = m["x"]
                    items.append((data[x:x + p.length - m["dlo"]], m["id"], m["dlo"], m["dhi"], data[x - m["dhi"]:x][::-1]))
                    near[m["id"]] = m["near"] & 0x7FFFFFFF
                if len(items) >= p.run_rows:
                    yield flush()
            trim_memory()
        if items:
            yield flush()
    return run


def range_least(values: np.ndarray) -> list[np.ndarray]:
    """Tables of the least of 1, 2, 4, ... consecutive values."""
    out = [values]
    while 2 ** len(out) <= len(values):
        step = 2 ** (len(out) - 1)
        out.append(np.minimum(out[-1][:-step], out[-1][step:]))
    return out


def repeated_distances(lcp: np.ndarray, dlo: np.ndarray, dhi: np.ndarray, left: np.ndarray, p: Passages, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest distance at which each suffix's window is repeated (greatest -1: none).

    ``lcp[i]`` is the common prefix of suffixes i - 1 and i; ``left[i, j]`` the byte j + 1 places before suffix i.
    Clusters share ``length - width + 1`` bytes.
    """
    n = len(lcp)
    least, most = np.full(n, p.length), np.full(n, -1)
    tables = range_least(lcp)
    cls = np.cumsum(np.concatenate([[0], (lcp[1:] < p.length - width + 1).astype(np.int64)])) if n else np.zeros(0, np.int64)
    active = np.arange(n)
    for d in range(width):
        if d:
            stay = dhi[active] >= d
            active, cls = active[stay], cls[stay] * 256 + left[active[stay], d - 1]
        if not len(active):
            break
        _, cls, size = np.unique(cls, return_inverse=True, return_counts=True)
        paired = size[cls] > 1
        active, cls = active[paired], cls[paired]
        may = dlo[active] <= d
        rank, group = active[may], cls[may]
        if len(rank) < 2:
            continue
        order = np.argsort(group, kind="stable")
        rank, group = rank[order], group[order]
        next_ = np.flatnonzero(group[1:] == group[:-1])
        a, b = rank[next_], rank[next_ + 1]
        k = np.log2(b - a).astype(np.int64)
        share = np.empty(len(a), np.int64)
        for level in np.unique(k):
            sel = k == level
            share[sel] = np.minimum(tables[level][a[sel] + 1], tables[level][b[sel] + 1 - 2 ** level])
        hit = share >= p.length - d
        both = np.concatenate([a[hit], b[hit]])
        least[both] = np.minimum(least[both], d)
        most[both] = d
    return least, most


def _merge(p: Passages, width: int):
    def run(table: pa.Table) -> pa.Table:
        tree = LoserTree([decode(b) for b in table.column("run").to_pylist()])
        lcp, ids, lo, hi, lefts = [], [], [], [], []
        for k, (_, _, id_, dlo, dhi, left) in tree:
            lcp.append(k)
            ids.append(id_)
            lo.append(dlo)
            hi.append(dhi)
            lefts.append(left.ljust(width, b"\0"))
        left = np.frombuffer(b"".join(lefts), np.uint8).reshape(-1, width).astype(np.int64)
        least, most = repeated_distances(np.array(lcp, np.int64), np.array(lo, np.int64), np.array(hi, np.int64), left, p, width)
        ids = np.array(ids, np.int64)
        ok = most >= 0
        trim_memory()
        return pa.table({"id": ids[ok], "least": pa.array(least[ok], pa.int32()), "most": pa.array(most[ok], pa.int32())})
    return run


def _sample(p: Passages):
    def run(batches):
        for batch in batches:
            out = [t.as_py().encode()[m["x"]:m["x"] + p.near] for t, ms in zip(batch.column("text"), batch.column("members"))
                   for m in ms.as_py() if m["pick"]]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["head"])
    return run


def merge_sort(members: DataFrame, texts: DataFrame, p: Passages, width: int) -> DataFrame:
    """``(id, least, most)`` of the members ``(id, t1, t2, x, dlo, dhi, near)`` with repeated windows.

    Distances are below ``width``; members whose windows may be equal share ``length - width + 1`` bytes from x on.
    """
    near = Passages(**{**p.__dict__, "spread": width})
    n = members.count()
    parts = max(1, -(-n // p.part_rows))
    ranges = min(parts, p.splitters)
    spread = -(-parts // ranges)
    # a sample of some 20 suffixes a range, bounded by 20 * splitters, chosen by hash
    pick = F.pmod(F.xxhash64("id"), F.lit(max(1, n // (20 * ranges)))) == 0
    listed = members.groupBy("t1", "t2").agg(F.collect_list(F.struct("id", "x", "dlo", "dhi", "near", pick.alias("pick"))).alias("members"))
    both = scratch_table(texts.join(listed, ["t1", "t2"]).select("text", "members"), "suffixes")
    heads = sorted(r["head"] for r in both.mapInArrow(_sample(near), "head binary").collect()) if ranges > 1 else []
    splitters = sorted({bytes(heads[len(heads) * k // ranges]) for k in range(1, ranges)}) if heads else []
    runs = both.mapInArrow(_run_batches(near, splitters, spread), _PART)
    return scratch_table(runs.groupBy("part").applyInArrow(_merge(near, width), "id long, least int, most int"), "merged")


def _finer_batches(p: Passages, bounds: list[int]):
    """Members -> members of finer clusters, one for each range of distances [bounds[k], bounds[k + 1]) that they have."""
    def run(batches):
        for batch in batches:
            rows = []
            for text, members in zip(batch.column("text"), batch.column("members")):
                data = text.as_py().encode()
                for m in members.as_py():
                    for b, e in zip(bounds, bounds[1:]):
                        lo, hi = max(m["dlo"], b), min(m["dhi"], e - 1)
                        if lo <= hi:
                            shared = data[m["x"] - b:m["x"] + p.length - e + 1]
                            key = int.from_bytes(hashlib.blake2b(b"%d:" % e + shared, digest_size=8).digest(), "little", signed=True)
                            rows.append((m["id"], m["x"] - b, lo - b, hi - b, key, b))
            cols = list(zip(*rows)) or [[]] * 6
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], ["id", "x", "dlo", "dhi", "near", "base"])
    return run


def repeats(members: DataFrame, texts: DataFrame, p: Passages, width: int) -> DataFrame:
    """``(id, least, most)`` of members in clusters (``near``) of two or more, whatever the clusters' sizes."""
    size = scratch_table(members.groupBy("near").agg(F.count(F.lit(1)).alias("members_n")).filter("members_n > 1"), "sizes")
    sized = scratch_table(members.join(size, "near"), "sized")
    out = merge_sort(sized.filter(F.col("members_n") <= p.cluster_rows), texts, p, width)
    large = sized.filter(F.col("members_n") > p.cluster_rows)
    if large.isEmpty():
        return out
    if width == 1:  # members share the whole window
        return out.unionByName(large.select("id", F.lit(0).alias("least"), F.lit(0).alias("most")))
    step = -(-width // p.ranges)
    bounds = [*range(0, width, step), width]
    listed = large.groupBy("t1", "t2").agg(F.collect_list(F.struct("id", "x", "dlo", "dhi")).alias("members"))
    finer = texts.join(listed, ["t1", "t2"]).select("text", "members").mapInArrow(
        _finer_batches(p, bounds), "id long, x int, dlo int, dhi int, near long, base int")
    finer = scratch_table(finer.join(large.select("id", "t1", "t2"), "id"), "finer")
    parts = []
    for b, e in zip(bounds, bounds[1:]):
        got = repeats(finer.filter(F.col("base") == b).drop("base"), texts, p, e - b)
        parts.append(got.select("id", (F.col("least") + b).cast("int").alias("least"), (F.col("most") + b).cast("int").alias("most")))
    for part in parts:
        out = out.unionByName(part)
    return out.groupBy("id").agg(F.min("least").alias("least"), F.max("most").alias("most"))


# ---- removal ------------------------------------------------------------------------------------------------------

_DIGEST = "t1 long, t2 long, n_removed long, spans array<struct<start:long,end:long>>, kept_sha256 string"


def _kept(data: bytes, cuts: list[tuple[int, int]]) -> tuple[list[tuple[int, int]], bytes]:
    """Maximal removed runs of overlapping or touching ``cuts``, and the bytes left."""
    spans: list[list[int]] = []
    for a, b in sorted(cuts):
        if spans and a <= spans[-1][1]:
            spans[-1][1] = max(b, spans[-1][1])
        else:
            spans.append([a, b])
    at, out = 0, []
    for a, b in spans:
        out.append(data[at:a])
        at = b
    return [tuple(s) for s in spans], b"".join(out) + data[at:]


def _digest_batches(batches):
    for batch in batches:
        removed, spans, digest = [], [], []
        for text, cuts in zip(batch.column("text"), batch.column("cuts")):
            got, kept = _kept(text.as_py().encode(), [(c["a"], c["b"]) for c in cuts.as_py()])
            removed.append(sum(b - a for a, b in got))
            spans.append([{"start": a, "end": b} for a, b in got])
            digest.append(hashlib.sha256(kept).hexdigest())
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        yield pa.RecordBatch.from_arrays([batch.column("t1"), batch.column("t2"), pa.array(removed, pa.int64()), pa.array(spans, kind), pa.array(digest, pa.string())],
                                         ["t1", "t2", "n_removed", "spans", "kept_sha256"])


def named(docs: DataFrame) -> DataFrame:
    """``doc_id, text, t1, t2``: null texts empty, texts named by two hashes."""
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(1), text).alias("t2"))


def repeated_passages(docs: DataFrame, p: Passages = Passages()) -> DataFrame:
    """Per row: ``doc_id, n_bytes, n_removed, spans`` (byte offsets of the maximal removed runs) and ``kept_sha256``."""
    ship(docs.sparkSession)
    texts = named(docs)
    sites = scratch_table(texts.filter(F.octet_length("text") >= p.length).select("t1", "t2", "text")
                          .mapInArrow(_anchor_batches(p), _ANCHORS), "anchors")
    each = sites.select("t1", "t2", F.explode("list").alias("s")).select("t1", "t2", "s.*")
    # written before their joins, so that a join can split a passage that a third of all texts share
    shared = scratch_table(each.groupBy("near").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("near"), "shared")
    found = scratch_table(each.join(shared, "near"), "found")
    drop_scratch(sites, shared)
    key = ["near", "ctx", "dlo", "dhi"]
    classes = found.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("t1", "t2", "x")).alias("rep"))
    classes = scratch_table(classes.withColumn("id", F.monotonically_increasing_id()), "classes")
    open_ = scratch_table(classes.groupBy("near").agg(F.count(F.lit(1)).alias("k"), F.min("n").alias("least_n"))
                          .filter("k > 1 and least_n = 1").select("near"), "open")
    members = scratch_table(classes.join(open_, "near").select("id", "near", "dlo", "dhi", "rep.*"), "members")

    names = scratch_table(found.select("t1", "t2").distinct(), "names")
    some = texts.select("t1", "t2", "text")
    held = some.mapInArrow(key_filter(names, "t1"), some.schema).dropDuplicates(["t1", "t2"]).join(names, ["t1", "t2"])
    held = scratch_table(held, "texts")
    merged = repeats(members, held, p, p.spread)
    whole = classes.filter("n > 1").select(*key, F.col("dlo").alias("least"), F.col("dhi").alias("most"))
    partly = merged.join(classes.filter("n = 1").select("id", *key), "id").select(*key, "least", "most")
    told = scratch_table(whole.unionByName(partly), "told")
    cuts = found.join(told, key).select("t1", "t2", (F.col("x") - F.col("most")).alias("a"), (F.col("x") - F.col("least") + p.length).alias("b"))
    listed = cuts.distinct().groupBy("t1", "t2").agg(F.collect_list(F.struct("a", "b")).alias("cuts"))
    digests = scratch_table(held.join(listed, ["t1", "t2"]).mapInArrow(_digest_batches, _DIGEST), "digests")
    rows = texts.select("doc_id", "t1", "t2", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("whole_sha256"))
    none = F.array().cast("array<struct<start:long,end:long>>")
    return rows.join(digests, ["t1", "t2"], "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"), F.coalesce("spans", none).alias("spans"),
        F.coalesce("kept_sha256", "whole_sha256").alias("kept_sha256"))
