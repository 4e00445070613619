"""Near-duplicate embeddings: Euclidean p-stable hashing with exact cosine checks.

Vectors are normalised, so a cosine of c is a distance of sqrt(2 - 2c). Each of
``tables`` hash tables concatenates ``projections`` quantised Gaussian
projections floor((a.x + b) / width); vectors of one label that agree on a
table's key meet in a bucket, and the cosine of every pair that meets is
computed in double precision. At a cosine of 0.98 the defaults miss a pair with
a chance of about 1e-4, and less above.

Identical vectors are one class with a multiplicity, so thousands of copies are
one row in the search. Buckets are dealt to work units of bounded size, which
return link counts and a spanning forest, not pairs. A pair that meets in
several tables is counted in the first table whose keys agree.

Edge cases: a vector that is null, empty, zero or has null or non-finite
components, or whose label is null, links with nothing. Vectors of different
lengths never link. Rows that repeat vec_id, label and vector are one vector; a
vec_id with several vectors is one node of the components and counts links per
vector. A null vec_id has component_id null, n_links 0 and kept true. Extra
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.llm.arrays import mix
from tillflow.llm.graph import Forest, components, work_units
from tillflow.llm.runtime import scratch_table, ship


@dataclass(frozen=True)
class PStable:
    cosine: float = 0.98
    tables: int = 32
    projections: int = 8
    width: float = 1.0
    seed: int = 3
    unit_rows: int = 512


_MATRICES: dict = {}


def _projections(dim: int, p: PStable) -> tuple[np.ndarray, np.ndarray]:
    if (dim, p) not in _MATRICES:
        rng = np.random.default_rng([p.seed, dim])
        n = p.tables * p.projections
        _MATRICES[dim, p] = rng.standard_normal((dim, n)), rng.uniform(0, p.width, n)
    return _MATRICES[dim, p]


def bucket_keys(unit: np.ndarray, p: PStable) -> np.ndarray:
    """One 64-bit key per table of normalised vectors (rows x dim)."""
    a, b = _projections(unit.shape[1], p)
    cell = np.floor((unit @ a + b) / p.width).astype(np.int64).view(np.uint64).reshape(len(unit), p.tables, p.projections)
    with np.errstate(over="ignore"):
        salt = mix(np.arange(1, p.projections + 1, dtype=np.uint64) * np.uint64(0xE7037ED1A0B428DB))
        h = mix(cell * salt).sum(axis=2, dtype=np.uint64)
        table = np.arange(1, p.tables + 1, dtype=np.uint64) * np.uint64(0x8EBC6AF09C88C6E3)
        return mix(h + table + np.uint64(unit.shape[1]))


def _vectors(cells: list, dim: int) -> np.ndarray:
    return np.array([np.frombuffer(x, np.float64) for x in cells], np.float64).reshape(len(cells), dim)


def _hash_batches(p: PStable):
    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, 4096):
                batch = whole.slice(at, 4096)
                rows = batch.column("embedding").to_pylist()
                vecs: list = [None] * len(rows)
                keys: list = [None] * len(rows)
                print_: list = [None] * len(rows)
                by_dim: dict[int, list[int]] = {}
                for i, (x, label) in enumerate(zip(rows, batch.column("label").to_pylist())):
                    if x and label is not None and None not in x:
                        by_dim.setdefault(len(x), []).append(i)
                for dim, members in by_dim.items():
                    v = np.array([rows[i] for i in members], np.float64) + 0.0
                    with np.errstate(over="ignore", invalid="ignore"):
                        norm = np.sqrt((v * v).sum(axis=1))
                    good = np.isfinite(v).all(axis=1) & np.isfinite(norm) & (norm > 0)
                    v = v[good]
                    members = [i for i, g in zip(members, good) if g]
                    if not members:
                        continue
                    k = bucket_keys(v / norm[good][:, None], p).view(np.int64)
                    for i, row, key in zip(members, v, k):
                        vecs[i] = row.tobytes()
                        keys[i] = key
                        print_[i] = hashlib.blake2b(vecs[i], digest_size=16).digest()
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id"), batch.column("label"), pa.array(vecs, pa.binary()), pa.array(print_, pa.binary()),
                     pa.array(keys, pa.list_(pa.int64()))], ["vec_id", "label", "vec", "print", "keys"])
    return run


def _links(p: PStable):
    """Work units -> rows (a, b, n): a forest edge (n null), or n links of class a (b null)."""
    def run(batches):
        for batch in batches:
            a, b, links = [], [], []
            cols = ("tbl", "bi", "bj", "nb", "ids", "blks", "mults", "vecs", "keys")
            for tbl, bi, bj, nb, ids, blks, mults, vecs, keys in zip(*(batch.column(c).to_pylist() for c in cols)):
                v = _vectors(vecs, len(vecs[0]) // 8)
                v /= np.sqrt((v * v).sum(axis=1))[:, None]
                keys, blks, mults = np.array(keys), np.array(blks), np.array(mults)
                x, y = np.nonzero(np.triu(v @ v.T >= p.cosine, 1))
                first = (keys[x] == keys[y]).argmax(axis=1)
                # rows of one block meet in every unit of that block: count them in one
                same = blks[x] == blks[y]
                partner = np.where(blks[x] == bi, bj, bi)
                mine = (first == tbl) & (~same | (nb == 1) | (partner == (blks[x] + 1) % nb))
                x, y = x[mine], y[mine]
                n = np.bincount(x, mults[y], len(ids)) + np.bincount(y, mults[x], len(ids))
                f = Forest(len(ids))
                for i, j in zip(x.tolist(), y.tolist()):
                    if f.union(i, j):
                        a.append(ids[i])
                        b.append(ids[j])
                        links.append(None)
                for i in np.flatnonzero(n):
                    a.append(ids[i])
                    b.append(None)
                    links.append(int(n[i]))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (a, b, links)], ["a", "b", "n"])
    return run


def near_vectors(vectors: DataFrame, p: PStable = PStable()) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)``, one row per row of ``vectors`` (vec_id, embedding, label)."""
    ship(vectors.sparkSession)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"),
                          F.col("label").cast("string").alias("label"))
    hashed = scratch_table(rows.mapInArrow(
        _hash_batches(p), "vec_id long, label string, vec binary, print binary, keys array<long>"), "vectors")
    full = hashed.filter("print is not null and vec_id is not null")
    members = scratch_table(full.select("vec_id", "label", "print").distinct(), "members")
    # a class is named by a hash of label and vector, and stands for `mult` vectors
    least = members.groupBy("label", "print").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("mult"))
    least = least.withColumn("cls", F.xxhash64("label", "print"))
    classes = scratch_table(members.join(least, ["label", "print"]).select("vec_id", "label", "print", "rep", "mult", "cls"), "classes")
    reps = (full.join(least, ["label", "print"]).filter("vec_id = rep")
            .groupBy("label", "cls", "mult").agg(F.first("vec").alias("vec"), F.first("keys").alias("keys")))
    reps = scratch_table(reps, "reps")

    rows = reps.select("cls", F.xxhash64("label").alias("lab"), F.posexplode("keys").alias("tbl", "key")) \
               .select("cls", "tbl", F.xxhash64("lab", "tbl", "key").alias("bucket"))
    units = work_units(rows, "bucket", F.xxhash64("cls"), F.lit(1), p.unit_rows, p.unit_rows, keep_blocks=True)
    units = units.join(reps.select("cls", "mult", "vec", "keys"), "cls")
    lists = (units.groupBy("bucket", "tbl", "bi", "bj", "nb").agg(F.collect_list(F.struct("cls", "blk", "mult", "vec", "keys")).alias("m"))
             .select("tbl", "bi", "bj", "nb", F.col("m.cls").alias("ids"), F.col("m.blk").alias("blks"),
                     F.col("m.mult").alias("mults"), F.col("m.vec").alias("vecs"), F.col("m.keys").alias("keys")))
    found = scratch_table(lists.mapInArrow(_links(p), "a long, b long, n long"), "links")
    counts = found.filter("n is not null").groupBy(F.col("a").alias("cls")).agg(F.sum("n").alias("n"))

    # class links and class membership as edges between vector ids
    named = classes.select("cls", "rep").distinct()
    edges = (found.filter("b is not null").select("a", "b")
             .join(named.toDF("a", "ra"), "a").join(named.toDF("b", "rb"), "b")
             .select(F.col("ra").alias("a"), F.col("rb").alias("b"))
             .unionByName(classes.select(F.col("rep").alias("a"), F.col("vec_id").alias("b"))))
    comp = components(edges)
    per = classes.join(counts, "cls", "left").select(
        "vec_id", "label", "print", (F.col("mult") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"))
    out = (hashed.select("vec_id", "label", "print").join(per, ["vec_id", "label", "print"], "left")
           .join(comp.withColumnRenamed("id", "vec_id"), "vec_id", "left")
           .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                   F.coalesce("component_id", "vec_id").alias("component_id")))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
