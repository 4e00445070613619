"""Near-duplicate documents: fast similarity sketching, banding, exact verification.

Fast similarity sketching (Dahlgaard, Knudsen, Thorup 2017) fills ``t``
coordinates by rounds: in round i < t every shingle is thrown into one hashed
bin with value i + hash, and each bin keeps its least value; rounds t..2t-1
place every shingle in bin i - t, so that every coordinate is filled. A round
runs only while a coordinate is empty, so a set of n shingles costs about
n + t log t hashes rather than n * t. Coordinates agree with a chance equal to
the Jaccard similarity, with concentration bounds as for independent hashing.

Stages (each a Spark job; tables in between are written to the scratch space):

1. sketch every document; documents with equal sets form one class, whose
   smallest doc_id stands for it;
2. representatives that agree on all rows of a band meet in a bucket; inside a
   bucket, pairs whose sketches agree on too few coordinates for the threshold
   are ruled out (``slack`` standard deviations below it), and the rest join
   their documents into families;
3. each family's whole sets are compared exactly, in work units of bounded
   size; a unit emits a spanning forest of the true links, not all pairs;
4. components of the exact links.

With 32 bands of 4 rows, a pair at similarity 0.8 is missed with a chance of
about 5e-8, and less above.

Edge cases: null or empty texts, or texts of white space only, have the empty
set (n_shingles 0) and link with nothing. A text of fewer words than a shingle
has one shingle, its whole word sequence. Rows that repeat a doc_id are one
node with the links of all its texts: their rows all return its component. A row whose doc_id is null is linked
with nothing and has component_id null and kept true. Extra columns of the
input are ignored, whatever their names. An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.llm import arrays
from tillflow.llm.graph import Forest, components, work_units
from tillflow.llm.runtime import drop_scratch, fresh, key_filter, scratch_table, ship, slices, text_buffer

EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


@dataclass(frozen=True)
class NearDup:
    """Parameters. Link when 100 * intersection >= ``percent`` * union."""

    words: int = 4
    percent: int = 80
    bands: int = 32
    rows: int = 4
    slack: float = 5.0
    unit_rows: int = 512
    unit_shingles: int = 1_000_000

    @property
    def t(self) -> int:
        return self.bands * self.rows

    @property
    def least_agreement(self) -> int:
        j = self.percent / 100
        return max(0, int(self.t * j - self.slack * (self.t * j * (1 - j)) ** 0.5))


def sketch(h: np.ndarray, at: np.ndarray, t: int) -> np.ndarray:
    """Sketches (rows x t) of the sets h[at[i]:at[i+1]]; empty sets keep EMPTY everywhere. t: a power of two."""
    n = len(at) - 1
    out = np.full(n * t, EMPTY, np.uint64)
    size = np.diff(at)
    row = np.repeat(np.arange(n), size)
    bits = np.uint64(t.bit_length() - 1)
    with np.errstate(over="ignore"):
        for i in range(2 * t):
            open_ = (out.reshape(n, t) == EMPTY).any(axis=1) & (size > 0)
            if not open_.any():
                break
            if not open_.all():
                take = open_[row]
                h, row = h[take], row[take]
            size = np.where(open_, size, 0)
            x = arrays.mix(h + np.uint64(i + 1) * np.uint64(0xA0761D6478BD642F))
            value = (x >> np.uint64(9)) | (np.uint64(i) << np.uint64(55))
            bin_ = (x & np.uint64(t - 1)).astype(np.int64) if i < t else np.full(len(h), i - t)
            np.minimum.at(out, row * t + bin_, value)
    return out.reshape(n, t)


def _sets(batch: pa.RecordBatch, p: NearDup):
    buf, offs = text_buffer(batch.column("text"))
    w = arrays.words(buf, offs, arrays.lower_table())
    return arrays.distinct_sets(*arrays.shingles(w, p.words))


def _band_hashes(sk: np.ndarray, p: NearDup) -> np.ndarray:
    n = len(sk)
    with np.errstate(over="ignore"):
        salt = arrays.mix(np.arange(1, p.rows + 1, dtype=np.uint64) * np.uint64(0xE7037ED1A0B428DB))
        h = (sk.reshape(n, p.bands, p.rows) * salt).sum(axis=2, dtype=np.uint64)
        return arrays.mix(h + np.arange(1, p.bands + 1, dtype=np.uint64) * np.uint64(0x8EBC6AF09C88C6E3))


def _sketch_batches(p: NearDup):
    def run(batches):
        for whole in batches:
            for batch in slices(whole):
                u, at = _sets(batch, p)
                sk = sketch(u, at, p.t)
                with np.errstate(over="ignore"):
                    sums = np.zeros((2, len(u) + 1), np.uint64)
                    np.cumsum(arrays.mix(u + np.uint64(1)), out=sums[0, 1:])
                    np.cumsum(arrays.mix(u + np.uint64(2)), out=sums[1, 1:])
                    fp = sums[:, at[1:]] - sums[:, at[:-1]]
                    small = ((sk * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(56)).astype(np.uint8)
                bands = _band_hashes(sk, p).view(np.int64)
                size = np.diff(at)
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id"), pa.array(size, pa.int64()),
                    pa.array(fp[0].view(np.int64)), pa.array(fp[1].view(np.int64)),
                    pa.array([r.tobytes() for r in small], pa.binary()),
                    pa.array(list(bands), pa.list_(pa.int64()))],
                    ["doc_id", "n_shingles", "fp1", "fp2", "sketch", "bands"])
    return run


def _alike(p: NearDup):
    """Work units of a bucket (lists of members) -> a spanning forest of the pairs whose sketches allow a link."""
    def run(batches):
        for batch in batches:
            a, b = [], []
            for ids, blks, raw in zip(batch.column("ids").to_pylist(), batch.column("blks").to_pylist(),
                                      batch.column("sketches").to_pylist()):
                sk = np.frombuffer(b"".join(raw), np.uint8).reshape(len(ids), p.t)
                f = Forest(len(ids))
                for i in range(len(ids) - 1):
                    near = np.flatnonzero((sk[i + 1:] == sk[i]).sum(axis=1) >= p.least_agreement) + i + 1
                    for j in near:
                        f.union(i, int(j))
                roots = f.roots()
                order = np.array(ids)
                for r in np.unique(roots):
                    m = order[roots == r]
                    if len(m) > 1:
                        lo = int(m.min())
                        for x in m:
                            if x != lo:
                                a.append(lo)
                                b.append(int(x))
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
    return run


def exact_forest(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """Roots of the classes that exact links (100 * |i and j| >= percent * |i or j|) form among the sets.

    Intersections of one set with all others come from posting lists; a set is
    only compared with sets of a size that the threshold allows.
    """
    n = len(sets)
    f = Forest(n)
    size = np.array([len(s) for s in sets], np.int64)
    flat = np.concatenate(sets) if n else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(n), size)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    for i in range(n):
        if size[i] == 0:
            continue
        lo, hi = np.searchsorted(flat, sets[i], side="left"), np.searchsorted(flat, sets[i], side="right")
        count = hi - lo
        start = np.cumsum(count) - count
        pos = np.arange(count.sum()) - np.repeat(start - lo, count)
        inter = np.bincount(owner[pos], minlength=n)
        linked = np.flatnonzero(100 * inter >= percent * (size + size[i] - inter))
        for j in linked:
            if j > i:
                f.union(i, int(j))
    return f.roots()


def _verify(p: NearDup):
    def run(key, frame):
        table = pa.RecordBatch.from_arrays(
            [frame.column("doc_id").combine_chunks(), frame.column("text").combine_chunks()], ["doc_id", "text"])
        ids = table.column("doc_id").to_numpy()
        sets: list[np.ndarray] = []
        for part in slices(table):
            u, at = _sets(part, p)
            sets += [u[x:y] for x, y in zip(at[:-1], at[1:])]
        roots = exact_forest(sets, p.percent)
        a, b = [], []
        for r in np.unique(roots):
            m = ids[roots == r]
            if len(m) > 1:
                lo = m.min()
                rest = m[m != lo]
                a += [lo] * len(rest)
                b += list(rest)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})
    return run


def near_duplicates(docs: DataFrame, p: NearDup = NearDup()) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)``, one row per row of ``docs``."""
    ship(docs.sparkSession)
    texts = docs.select("doc_id", "text")
    sketches = scratch_table(texts.mapInArrow(
        _sketch_batches(p),
        "doc_id long, n_shingles long, fp1 long, fp2 long, sketch binary, bands array<long>"), "sketch")

    full = sketches.filter("n_shingles > 0 and doc_id is not null")
    # written first, so that a join can split a class that holds a third of the rows
    least = scratch_table(full.groupBy("n_shingles", "fp1", "fp2").agg(F.min("doc_id").alias("rep")), "least")
    classes = full.select("doc_id", "n_shingles", "fp1", "fp2").join(least, ["n_shingles", "fp1", "fp2"]) \
                  .select("doc_id", "rep").distinct()
    classes = scratch_table(classes, "classes")
    same = classes.filter("doc_id <> rep").select(F.col("rep").alias("a"), F.col("doc_id").alias("b"))
    # one sketch per class: that of its smallest id
    reps = (least.join(full, ["n_shingles", "fp1", "fp2"]).filter("doc_id = rep")
            .groupBy("rep", "n_shingles", "fp1", "fp2").agg(F.first("sketch").alias("sketch"), F.first("bands").alias("bands")))
    reps = scratch_table(reps.select(F.col("rep").alias("doc_id"), "n_shingles", "sketch", "bands"), "reps")

    rows = reps.select("doc_id", F.explode("bands").alias("bucket"))
    shared = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("bucket")
    rows = rows.join(shared, "bucket").join(reps.select("doc_id", "sketch"), "doc_id")
    units = work_units(rows, "bucket", F.xxhash64("doc_id"), F.lit(1), p.unit_rows, p.unit_rows)
    lists = (units.groupBy("bucket", "bi", "bj")
             .agg(F.collect_list(F.struct("doc_id", "blk", "sketch")).alias("m"))
             .select(F.col("m.doc_id").alias("ids"), F.col("m.blk").alias("blks"), F.col("m.sketch").alias("sketches")))
    alike = lists.mapInArrow(_alike(p), "a long, b long")
    family = scratch_table(components(alike), "family")

    # work units are dealt from ids alone; texts, of candidates only, meet them by doc_id. A doc_id may have several texts.
    weights = reps.groupBy("doc_id").agg(F.max("n_shingles").alias("n_shingles"))
    members = scratch_table(family.toDF("doc_id", "family").join(weights, "doc_id"), "candidates")
    units = work_units(members, "family", F.xxhash64("doc_id"), F.col("n_shingles"), p.unit_rows, p.unit_shingles)
    units = scratch_table(units.select("family", "bi", "bj", "doc_id"), "units")
    some = texts.filter("doc_id is not null")
    some = some.mapInArrow(key_filter(members.select("doc_id"), "doc_id"), some.schema)
    links = units.join(some.distinct(), "doc_id").groupBy("family", "bi", "bj").applyInArrow(_verify(p), "a long, b long")
    found = components(links.unionByName(same))
    drop_scratch(least, classes, reps, family, members, units)

    out = (sketches.select("doc_id", "n_shingles")
           .join(found.withColumnRenamed("id", "doc_id"), "doc_id", "left")
           .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def row_key(text_key="text_key"):
    """A row's id and text as one hash: copies of a text under other ids are rows of their own."""
    return F.xxhash64("doc_id", text_key)


def copy_classes(docs: DataFrame, p: NearDup = NearDup()) -> DataFrame:
    """``(row, class)`` of the rows of ``docs`` (``row_key`` of doc_id and ``text_key``): exact and edited copies share a class."""
    rows = docs.select(row_key().alias("doc_id"), "text")
    found = near_duplicates(rows, p).select(F.col("doc_id").alias("row"), F.col("component_id").alias("class"))
    return scratch_table(found, "copies")


def drop_near_duplicates(docs: DataFrame, p: NearDup = NearDup()) -> DataFrame:
    """One row of every near-duplicate class, that of its smallest doc_id; same columns.

    Of rows that repeat a doc_id the one with the least text stays; rows with a null doc_id all stay.
    """
    id_, row = fresh(docs, "_id", "_row")
    seen = near_duplicates(docs, p).filter("doc_id is not null").groupBy(F.col("doc_id").alias(id_)) \
        .agg(F.count(F.lit(1)).alias("n"), F.bool_and("kept").alias("stays"))
    touched = scratch_table(seen.filter("n > 1 or not stays"), "touched")
    untouched = docs.join(touched.select(id_), F.col("doc_id") == F.col(id_), "left_anti")
    repeated = docs.join(touched.filter("stays").select(id_), F.col("doc_id") == F.col(id_), "left_semi")
    first = repeated.groupBy("doc_id").agg(F.min_by(F.struct(*docs.columns), F.struct(F.col("text").isNull(), "text")).alias(row))
    return untouched.unionByName(first.select(f"{row}.*"))
