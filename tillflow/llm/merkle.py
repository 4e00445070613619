"""Merkle manifest of documents: a SHA-256 midstate tree, proofs and folds.

A digest enters its parent as 64 hex characters, which is exactly one block of
SHA-256. So the hash state before each child slot is eight words with no
remainder: parents *retain* these states, and a fold that replaces one child
resumes the state before its slot, adds the replacement and the siblings to its
right, and never hashes the left ones again. The compression function works on
arrays (one lane per node or per document).

Jobs: leaf digests are built-in expressions; leaves are ordered by (language,
doc_id) with a range exchange and numbered by prefix sums over (partition,
language) counts, so no task numbers a whole language. Tiles of ``fanout ** 4``
consecutive leaves grow four levels each; their tops are the next step's leaves,
so a few steps reach any number of rows, and no task holds more than one tile.
Subroots, ordered by language, form a tree of their own in the same way. The fold
meets a tile's leaves with the tile's nodes and the nodes on its path to the root.

Edge cases: a null column is ``-`` in the leaf, so null and empty text differ.
Languages ascend bytewise, null first. Rows that repeat a doc_id (or whose doc_id
is null, which come first) are leaves of their own, ordered by digest; fully equal
rows are interchangeable. A null doc_id is never tampered with in ``tampered``. A
lone leaf is its own subroot, and a lone subroot the root; the proof is then the
digest of no bytes. Extra columns are ignored, whatever their names; an empty
table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillflow.llm.runtime import drop_scratch, fresh, scratch_table, ship

FANOUT_BITS = 3
FANOUT = 1 << FANOUT_BITS
STEP = 4                       # levels that one tile grows
LANES = 4096                   # of one compression call, so that its arrays stay in the cache
MAX_LEVELS = 21                # 8 ** 21 places are all that a long can number
TOP = -1                       # the tree of the subroots
LEAF_FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def _fraction_bits(n: int, root: int) -> int:
    """The first 32 bits of the fractional part of the root of n."""
    target, lo, hi = n << (32 * root), 0, 1 << 40
    while hi - lo > 1:
        mid = (lo + hi) // 2
        lo, hi = (mid, hi) if mid ** root <= target else (lo, mid)
    return lo & 0xFFFFFFFF


_PRIMES = [p for p in range(2, 312) if all(p % q for q in range(2, int(p ** 0.5) + 1))]
_ROUND = np.array([_fraction_bits(p, 3) for p in _PRIMES], np.uint32)
INITIAL = np.array([_fraction_bits(p, 2) for p in _PRIMES[:8]], np.uint32)


def _turn(x: np.ndarray, r: int) -> np.ndarray:
    return (x >> np.uint32(r)) | (x << np.uint32(32 - r))


def compress(state: np.ndarray, block: np.ndarray) -> np.ndarray:
    """The SHA-256 states (8 x n) after one more block (16 x n) each."""
    n = state.shape[1]
    if n > LANES:
        return np.concatenate([compress(state[:, i:i + LANES], block[:, i:i + LANES]) for i in range(0, n, LANES)], axis=1)
    w = list(np.ascontiguousarray(block))
    a, b, c, d, e, f, g, h = np.ascontiguousarray(state)
    for t in range(64):
        if t >= 16:
            x, y = w[t - 15], w[t - 2]
            w.append(w[t - 16] + (_turn(x, 7) ^ _turn(x, 18) ^ (x >> np.uint32(3))) + w[t - 7]
                     + (_turn(y, 17) ^ _turn(y, 19) ^ (y >> np.uint32(10))))
        one = h + (_turn(e, 6) ^ _turn(e, 11) ^ _turn(e, 25)) + (g ^ (e & (f ^ g))) + _ROUND[t] + w[t]
        two = (_turn(a, 2) ^ _turn(a, 13) ^ _turn(a, 22)) + ((a & b) | (c & (a | b)))
        a, b, c, d, e, f, g, h = one + two, a, b, c, d + one, e, f, g
    return state + np.stack([a, b, c, d, e, f, g, h])


def start(n: int) -> np.ndarray:
    return np.repeat(INITIAL[:, None], n, axis=1)


def finish(state: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """States of messages of whole ``blocks`` -> digests as blocks of hex text (16 x n)."""
    pad = np.zeros((16, state.shape[1]), np.uint32)
    pad[0] = 0x80000000
    pad[15] = np.asarray(blocks, np.uint32) << np.uint32(9)
    return hex_blocks(compress(state, pad))


_HEX = np.frombuffer("".join(f"{i:02x}" for i in range(256)).encode(), np.uint8).reshape(256, 2)


def hex_blocks(words: np.ndarray) -> np.ndarray:
    raw = np.ascontiguousarray(words.T).astype(">u4").view(np.uint8)
    return np.ascontiguousarray(_HEX[raw].reshape(len(raw), 64).view(">u4").astype(np.uint32).T)


def blocks_of(texts: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Hex digests (strings of 64 characters) as blocks (16 x n)."""
    joined = b"".join(x.encode() for x in texts.to_pylist())
    return np.ascontiguousarray(np.frombuffer(joined, ">u4").reshape(-1, 16).astype(np.uint32).T)


def texts_of(blocks: np.ndarray) -> list[str]:
    raw = np.ascontiguousarray(blocks.T).astype(">u4").tobytes().decode()
    return [raw[i:i + 64] for i in range(0, len(raw), 64)]


def parents(children: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a tile's children (16 x n): the parents' digests (16 x m), retained states (slot, 8, m) and child counts."""
    n = children.shape[1]
    m = -(-n // FANOUT)
    count = np.full(m, FANOUT)
    count[-1] = n - (m - 1) * FANOUT
    slots = np.zeros((16, m * FANOUT), np.uint32)
    slots[:, :n] = children
    slots = slots.reshape(16, m, FANOUT)
    state, kept = start(m), np.zeros((FANOUT, 8, m), np.uint32)
    for j in range(FANOUT):
        kept[j] = state
        state = np.where(count > j, compress(state, slots[:, :, j]), state)
    return finish(state, count), kept, count


# ---- the tree -----------------------------------------------------------------------------------------------------

_NODES = "tree long, level int, pos long, size long, digest string, children binary, states binary"


def _grow(base: int):
    """A tile's nodes (tree, pos, size, digest) -> the parents of up to STEP levels above ``base``."""
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("pos")
        tree, size = table.column("tree")[0].as_py(), table.column("size")[0].as_py()
        blocks, pos, level = blocks_of(table.column("digest")), table.column("pos")[0].as_py(), base
        rows = []
        while size > 1 and level < base + STEP:
            digests, kept, count = parents(blocks)
            size, pos, level = -(-size // FANOUT), pos >> FANOUT_BITS, level + 1
            text = np.ascontiguousarray(blocks.T).astype(">u4").view(np.uint8)
            for i, digest in enumerate(texts_of(digests)):
                k = int(count[i])
                rows.append((tree, level, pos + i, size, digest, text[i * FANOUT:i * FANOUT + k].tobytes(),
                             np.ascontiguousarray(kept[:k, :, i]).tobytes()))
            blocks = digests
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.binary()]
        return pa.table([pa.array(c, t) for c, t in zip(list(zip(*rows)) or [[]] * 7, kinds)],
                        names=["tree", "level", "pos", "size", "digest", "children", "states"])
    return run


def numbered(df: DataFrame, group: str, *order: str) -> DataFrame:
    """``df`` with ``pos``, a row's place (from 0) in its group by ``order``.

    A range exchange sorts the rows, and prefix sums over the rows of each
    (partition, group) number them: no task sorts or counts a whole group. The
    last order column must tell rows apart.
    """
    at, part, low, n, before = fresh(df, "_at", "_part", "_low", "_n", "_before")
    placed = scratch_table(df.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
                           .withColumn(at, F.monotonically_increasing_id()), "placed")
    placed = placed.withColumn(part, F.shiftright(at, 33))
    counts = placed.groupBy(part, group).agg(F.count(F.lit(1)).alias(n), F.min(at).alias(low))
    earlier = Window.partitionBy(group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn(before, F.coalesce(F.sum(n).over(earlier), F.lit(0)))
    return placed.join(counts.drop(n), [part, group]).withColumn("pos", F.col(at) - F.col(low) + F.col(before)).drop(part, at, low, before)


def grow(leaves: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of leaves ``(tree, pos, digest)``: all parents (``_NODES``), and the roots ``(tree, digest, depth, size)``."""
    sizes = leaves.groupBy("tree").agg(F.count(F.lit(1)).alias("size"))
    current = leaves.select("tree", "pos", "digest").join(sizes, "tree")
    nodes, roots, base = [], [], 0
    while True:
        roots.append(current.filter("size = 1").select("tree", "digest", F.lit(base).alias("depth")))
        # one text as key: an exchange by tree alone must not serve these groups
        cell = F.concat_ws(":", "tree", F.shiftright("pos", FANOUT_BITS * STEP)).alias("cell")
        made = scratch_table(current.filter("size > 1").select("*", cell).groupBy("cell")
                             .applyInArrow(_grow(base), _NODES), "nodes")
        nodes.append(made)
        top = made.filter((F.col("level") == base + STEP) | ((F.col("size") == 1) & (F.col("level") < base + STEP)))
        roots.append(top.filter((F.col("size") == 1) & (F.col("level") < base + STEP)).select("tree", "digest", F.col("level").alias("depth")))
        current = top.filter(F.col("level") == base + STEP).select("tree", "pos", "digest", "size")
        base += STEP
        if current.isEmpty():
            break
    union = lambda parts: reduce(DataFrame.unionByName, parts)
    return union(nodes), scratch_table(union(roots).join(sizes, "tree"), "roots")


# ---- leaves -------------------------------------------------------------------------------------------------------

def leaf_digest(**replaced: Column) -> Column:
    """Hex SHA-256 of the row's fields, each with its byte count; ``replaced`` puts other columns in a field's place."""
    def field(name: str) -> Column:
        value = replaced.get(name, F.col(name)).cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))
    return F.sha2(F.concat(*map(field, LEAF_FIELDS)), 256)


def manifest(docs: DataFrame, replacement: Column | None = None) -> dict[str, DataFrame]:
    """The written manifest of ``docs``: ``leaves``, ``nodes``, ``subroots`` and ``roots``.

    ``leaves`` holds ``tree`` (a language's place), ``pos``, ``doc_id``, ``leaf`` and
    ``fold_leaf``: ``replacement`` where it is not null, the digest that a fold
    puts in the leaf's place. Nodes hold their children and the state before each slot.
    """
    ship(docs.sparkSession)
    leaf = leaf_digest()
    fold = leaf if replacement is None else F.coalesce(replacement, leaf)
    hashed = scratch_table(docs.select("doc_id", "lang", leaf.alias("leaf"), fold.alias("fold_leaf"),
                                       F.monotonically_increasing_id().alias("row")), "leaves")
    langs = scratch_table(numbered(hashed.groupBy("lang").agg(F.lit(0).cast("long").alias("all")), "all", "lang")
                          .select("lang", F.col("pos").alias("tree")), "langs")
    keyed = hashed.alias("h").join(langs.alias("l"), F.col("h.lang").eqNullSafe(F.col("l.lang"))) \
                  .select("tree", "doc_id", "leaf", "fold_leaf", "row")
    leaves = scratch_table(numbered(keyed, "tree", "doc_id", "leaf", "row").drop("row"), "numbered")
    nodes, subroots = grow(leaves.select("tree", "pos", F.col("leaf").alias("digest")))
    top_nodes, roots = grow(subroots.select(F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("pos"), "digest"))
    drop_scratch(hashed)
    return {"leaves": leaves, "nodes": nodes, "subroots": subroots, "top_nodes": top_nodes, "roots": roots}


# ---- folds and proofs ---------------------------------------------------------------------------------------------

def _paths(made: dict[str, DataFrame]) -> DataFrame:
    """Per tile of leaves ``(tree, tile)``: the nodes inside it and those on its path to the root, in order of ``step``."""
    nodes, top = made["nodes"], made["top_nodes"]
    columns = ["tree", "tile", "step", "level", "pos", "digest", "children", "states"]
    inside = nodes.filter(F.col("level") <= STEP).withColumn("tile", F.expr(f"shiftright(pos, {FANOUT_BITS} * ({STEP} - level))")) \
                  .withColumn("step", F.col("level")).select(*columns)
    tiles = made["subroots"].select("tree", "depth", F.explode(F.expr(
        f"sequence(0L, shiftright(size - 1, {FANOUT_BITS * STEP}))")).alias("tile"))
    above = tiles.filter(F.col("depth") > STEP).select("tree", "tile", F.explode(F.expr(f"sequence({STEP} + 1, depth)")).alias("level")) \
                 .withColumn("pos", F.expr(f"shiftright(tile, {FANOUT_BITS} * (level - {STEP}))"))
    above = above.join(nodes.select("tree", "level", "pos", "digest", "children", "states"), ["tree", "level", "pos"]) \
                 .withColumn("step", F.col("level")).select(*columns)
    # the root's tree: as high as its nodes, of which each level has one for every language's place
    over = top.select("level", F.col("pos").alias("at"), "digest", "children", "states")
    places = tiles.select("tree", "tile", F.explode(F.expr(f"sequence(1, {MAX_LEVELS})")).alias("level")) \
                  .withColumn("at", F.expr(f"shiftright(tree, {FANOUT_BITS} * level)"))
    over = places.join(over, ["level", "at"]).withColumn("step", 1000 + F.col("level")).withColumn("pos", F.col("at")).select(*columns)
    return inside.unionByName(above).unionByName(over)


def _climb(digest, proof, blocks, slot, owner, kids, states, count):
    """One level: fold ``digest`` into its parent and add the siblings to the proof.

    ``owner`` names each lane's parent; ``kids`` (16, parent, slot), ``states``
    (slot, 8, parent) and ``count`` describe the parents.
    """
    k = count[owner]
    state = compress(np.ascontiguousarray(states[slot, :, owner].T), digest)
    for j in range(FANOUT):
        right = np.flatnonzero((j > slot) & (j < k))
        if len(right):
            state[:, right] = compress(state[:, right], kids[:, owner[right], j])
        other = np.flatnonzero((j != slot) & (j < k))
        if len(other):
            proof[:, other] = compress(proof[:, other], kids[:, owner[other], j])
    return finish(state, k), proof, blocks + k - 1


def _fold(leaves: pa.Table, path: pa.Table) -> pa.Table:
    leaves = leaves.sort_by("pos")
    path = path.sort_by([("step", "ascending"), ("pos", "ascending")])
    n = leaves.num_rows
    pos, tree = leaves.column("pos").to_numpy(), leaves.column("tree")[0].as_py() if n else 0
    digest = blocks_of(leaves.column("fold_leaf"))
    proof, blocks = start(n), np.zeros(n, np.int64)
    sub = root = leaves.column("leaf")[0].as_py() if n else ""
    steps = path.column("step").to_numpy()
    for step in np.unique(steps):
        rows = path.filter(pa.array(steps == step))
        level, first, root = (rows.column(c)[0].as_py() for c in ("level", "pos", "digest"))
        sub = root if step < 1000 else sub
        kids = np.zeros((rows.num_rows, FANOUT, 16), np.uint32)
        states = np.zeros((FANOUT, 8, rows.num_rows), np.uint32)
        count = np.zeros(rows.num_rows, np.int64)
        for i, (c, s) in enumerate(zip(rows.column("children").to_pylist(), rows.column("states").to_pylist())):
            count[i] = len(c) // 64
            kids[i, :count[i]] = np.frombuffer(c, ">u4").reshape(-1, 16)
            states[:count[i], :, i] = np.frombuffer(s, np.uint32).reshape(-1, 8)
        at = pos if step < 1000 else np.full(n, tree)
        owner = (at >> (FANOUT_BITS * level)) - first
        slot = (at >> (FANOUT_BITS * (level - 1))) & (FANOUT - 1)
        digest, proof, blocks = _climb(digest, proof, blocks, slot, owner, np.ascontiguousarray(kids.transpose(2, 0, 1)), states, count)
    columns = {"subroot": [sub] * n, "root": [root] * n, "proof_sha256": texts_of(finish(proof, blocks)), "folded_root": texts_of(digest)}
    return pa.table([leaves.column("doc_id"), leaves.column("leaf"), *[pa.array(c, pa.string()) for c in columns.values()]],
                    names=["doc_id", "leaf", *columns])


def fold(made: dict[str, DataFrame]) -> DataFrame:
    """Per leaf: ``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified``."""
    tile = F.shiftright("pos", FANOUT_BITS * STEP).alias("tile")
    paths = scratch_table(_paths(made), "paths")
    got = (made["leaves"].select("*", tile).groupBy("tree", "tile").cogroup(paths.groupBy("tree", "tile"))
           .applyInArrow(_fold, "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string"))
    return got.withColumn("verified", F.col("folded_root") == F.col("root"))


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def tampered() -> Column:
    """The leaf of a row whose text lost its capitals, where 3 divides crc32(doc_id); null elsewhere."""
    return F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, leaf_digest(text=F.translate("text", UPPER, LOWER)))
