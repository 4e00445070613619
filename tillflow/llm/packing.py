"""Best-fit-decreasing packing of tokenised documents into sequences.

A document's ids get an end id; only documents longer than a sequence are cut,
into pieces of the full length and a rest. Pieces are placed longest first,
each into the open sequence with the least sufficient room, found by descending
a segment tree over the remaining capacities: leaf r tells whether a sequence
with r free places is open, so a placement takes O(log capacity).

Full pieces are sequences by themselves. The others are dealt by hash to groups
of about ``group_pieces`` pieces, packed independently (a group is bounded, so
no task or driver holds the corpus). Every group leaves only a few sequences
with room; those below ``refill_percent`` percent are opened again and packed
once more in groups of their own.

Edge cases: null or empty text is one piece that holds the end id alone. Rows
that repeat a doc_id (or whose doc_id is null) are packed row by row. Equal
lengths are placed in order of doc_id and piece. Extra columns are ignored; an
empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.llm.runtime import scratch_table, ship, trim_memory
from tillflow.llm.wordbpe import tokenizer


@dataclass(frozen=True)
class Packing:
    capacity: int = 4096
    end_id: int = 1
    group_pieces: int = 32768
    refill_percent: int = 98


class OpenSequences:
    """Open sequences by free places: a segment tree of occupancy over capacities 0..capacity."""

    def __init__(self, capacity: int):
        self.size = 1 << (capacity + 1).bit_length()
        self.any = bytearray(2 * self.size)
        self.at: list[list[int]] = [[] for _ in range(capacity + 1)]

    def add(self, sequence: int, free: int) -> None:
        self.at[free].append(sequence)
        if len(self.at[free]) == 1:
            i = free + self.size
            while i and not self.any[i]:
                self.any[i] = 1
                i >>= 1

    def tightest(self, need: int) -> int:
        """Least free capacity of at least ``need``, or -1."""
        i = need + self.size
        if self.any[i]:
            return need
        while i > 1:
            if not i & 1 and self.any[i + 1]:
                i += 1
                while i < self.size:
                    i = 2 * i + (not self.any[2 * i])
                return i - self.size
            i >>= 1
        return -1

    def take(self, free: int) -> int:
        sequence = self.at[free].pop()
        if not self.at[free]:
            i = free + self.size
            self.any[i] = 0
            i >>= 1
            while i and not (self.any[2 * i] or self.any[2 * i + 1]):
                self.any[i] = 0
                i >>= 1
        return sequence


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of every piece; ``lengths`` must be descending and at most ``capacity``."""
    n = len(lengths)
    sequence, offset = np.zeros(n, np.int64), np.zeros(n, np.int64)
    bins, opened = OpenSequences(capacity), 0
    for i, need in enumerate(lengths.tolist()):
        free = bins.tightest(need)
        if free < 0:
            s, free = opened, capacity
            opened += 1
        else:
            s = bins.take(free)
        sequence[i], offset[i] = s, capacity - free
        if free > need:
            bins.add(s, free - need)
    return sequence, offset


_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def _piece_batches(path: str, p: Packing):
    end = np.array([p.end_id], "<u4").tobytes()

    def run(batches):
        tok = tokenizer(path)
        for batch in batches:
            trim_memory()
            for a in range(0, batch.num_rows, 512):
                part = batch.slice(a, 512)
                rows = []
                for doc, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                    ids = tok.ids(text or "") + end
                    total, step = len(ids) // 4, p.capacity
                    for k, start in enumerate(range(0, total, step)):
                        cut = ids[4 * start:4 * (start + step)]
                        rows.append((doc, k, start, len(cut) // 4, zlib.crc32(cut)))
                cols = list(zip(*rows)) or [[]] * 5
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()), *[pa.array(c, pa.int64()) for c in cols[2:]]],
                    ["doc_id", "piece", "start", "length", "ids_crc32"])
    return run


def _pack_group(p: Packing):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending"), ("ids_crc32", "ascending")])
        length = table.column("length").to_numpy()
        sequence, offset = best_fit_decreasing(length, p.capacity)
        group = table.column("grp").to_numpy()
        fill = np.bincount(sequence, weights=length, minlength=1)
        cols = {"sequence_id": (group << 24) | sequence, "offset": offset, "fill": fill[sequence].astype(np.int64)}
        for name, values in cols.items():
            table = table.append_column(name, pa.array(values, pa.int64()))
        return table
    return run


def pieces(docs: DataFrame, tokenizer_path: str, p: Packing = Packing()) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32``."""
    ship(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(_piece_batches(tokenizer_path, p), _PIECES)


def _packed(rest: DataFrame, p: Packing, turn: int) -> DataFrame:
    """Packs rows of a written table, dealt by their numbers in it: equal rows spread over the groups like others."""
    n = rest.count()
    groups = max(1, -(-n // p.group_pieces))
    dealt = rest.withColumn("grp", F.pmod(F.xxhash64(F.monotonically_increasing_id(), F.lit(turn)), F.lit(groups)) * 2 + turn)
    return dealt.groupBy("grp").applyInArrow(_pack_group(p), f"{_PIECES}, grp long, sequence_id long, offset long, fill long")


def pack(docs: DataFrame, tokenizer_path: str, p: Packing = Packing()) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32, sequence_id, offset)`` of all pieces of all rows."""
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    cut = scratch_table(pieces(docs, tokenizer_path, p), "pieces")
    # a full piece's sequence id is negative: no two rows share a number
    full = cut.filter(F.col("length") == p.capacity).withColumn("sequence_id", -1 - F.monotonically_increasing_id()) \
              .withColumn("offset", F.lit(0).cast("long")).select(*names)
    first = scratch_table(_packed(cut.filter(F.col("length") < p.capacity), p, 0), "packed")
    done = F.col("fill") * 100 >= p.refill_percent * p.capacity
    again = first.filter(~done).select("doc_id", "piece", "start", "length", "ids_crc32")
    second = _packed(again, p, 1)
    return full.unionByName(first.filter(done).select(*names)).unionByName(second.select(*names))
