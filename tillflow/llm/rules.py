"""Quality rules: per-document measures and cross-document line frequency.

Base rules fail a document with fewer than ``min_words`` words, or with more
than ``repeat_percent`` percent of its words inside 3-word windows that occur
at least twice in it.

The method: lines are normalised (words joined by one space, A-Z lower-cased,
digits as 0) and hashed; for every host the documents that hold a line are
counted, equal texts once. A line in more than
``max(line_docs, line_share * documents of the host)`` documents is frequent. A
frequent line is boilerplate if its documents are different ones: whole
documents that near-dedup would merge (``minhash``, exact check included) count
once, and more than that limit must be left. The edited copies of one document, wherever the edits fall, do not
make each other's lines boilerplate. Boilerplate lines are removed, and a
document that loses more than ``depleted_percent`` percent of its words is
rejected.

Counts are aggregations with map-side combination on (host, line, text), so a
host or a line that holds a third of all rows is no special case. Only documents
that hold a frequent line are compared (found by a bitmap of fixed size, whose
false hits merely compare more), and of these only candidate copies have their
texts shuffled.

Edge cases: null or empty text has no words and fails the base rules. A null
host is a host of its own. Rows that repeat a doc_id are judged one by one;
``apply_rules`` keeps every row whose own text passes (rows are told apart by
their text's hash). A null doc_id is carried through. Extra columns are kept by
``apply_rules`` and ignored otherwise. An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.llm import arrays
from tillflow.llm.minhash import copy_classes, row_key
from tillflow.llm.runtime import fresh, key_filter, scratch_table, ship, slices, text_buffer

SYMBOLS = b"#*$%&|<>"


@dataclass(frozen=True)
class LineRules:
    min_words: int = 50
    repeat_percent: int = 50
    line_docs: int = 10
    line_share: float = 0.001
    depleted_percent: int = 60


def row_sums(values: np.ndarray, offs: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[offs[1:]] - total[offs[:-1]]


def repeat_words(w: arrays.Words) -> np.ndarray:
    """Words of each row that lie in a 3-word window found at least twice in the row."""
    n = len(w.starts)
    h, at = arrays.shingles(w, 3)
    count = np.diff(at)
    row = np.repeat(np.arange(len(count)), count)
    rep = arrays.repeated_within_rows(h, row)
    pos = (np.arange(len(h)) - np.repeat(at[:-1] - w.first[:-1], count))[rep]
    covered = np.zeros(n + 2, bool)
    for k in range(3):
        covered[pos + k] = True
    return row_sums(covered[:n].astype(np.int64), w.first)


def base_measures(buf: np.ndarray, offs: np.ndarray, w: arrays.Words) -> dict[str, np.ndarray]:
    """The base columns of every row of a slice."""
    solid = ~arrays.SPACE[buf]
    symbol = np.zeros(256, bool)
    symbol[list(SYMBOLS)] = True
    starts, ends, row = arrays.lines(buf, offs)
    filled = np.zeros(len(buf) + 1, np.int64)
    np.cumsum(solid, out=filled[1:])
    has = filled[ends] > filled[starts]
    starts, ends, row = starts[has], ends[has], row[has]
    with np.errstate(over="ignore"):
        h = arrays.span_hash(arrays.prefix(arrays._weights()[buf]), starts, ends)
        key = arrays.mix(h ^ arrays.mix(row.astype(np.uint64) + np.uint64(1)))
    first = np.zeros(len(key), bool)
    first[np.unique(key, return_index=True)[1]] = True
    n = len(offs) - 1
    return {"n_words": np.diff(w.first), "word_chars": row_sums(solid & ((buf & 0xC0) != 0x80), offs),
            "n_symbols": row_sums(symbol[buf], offs),
            "n_dup_lines": np.bincount(row[~first], minlength=n), "n_repeat_words": repeat_words(w)}


def line_keys(buf: np.ndarray, offs: np.ndarray):
    """(row, line number, words, hash) of every line with a word."""
    w = arrays.words(buf, offs, arrays.line_table())
    starts, ends, row = arrays.lines(buf, offs)
    number = np.arange(len(row)) - np.searchsorted(row, row)
    lo, hi = np.searchsorted(w.starts, starts), np.searchsorted(w.starts, ends)
    has = hi > lo
    with np.errstate(over="ignore"):
        h = arrays.span_hash(arrays.prefix(w.hashes), lo[has], hi[has])
    return row[has], number[has], (hi - lo)[has], h


_PROFILE = ("doc_id long, host long, text_key long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
            "n_repeat_words long, lines array<struct<h:long,words:int,numbers:array<int>>>")


def _profile_batches(batches):
    for whole in batches:
        for batch in slices(whole):
            buf, offs = text_buffer(batch.column("text"))
            m = base_measures(buf, offs, arrays.words(buf, offs))
            row, number, size, h = line_keys(buf, offs)
            lines: list[dict] = [{} for _ in range(len(offs) - 1)]
            for r, no, k, x in zip(row.tolist(), number.tolist(), size.tolist(), h.view(np.int64).tolist()):
                have = lines[r].get(x)
                if have is None:
                    lines[r][x] = [k, [no]]
                else:
                    have[0] += k
                    have[1].append(no)
            cells = [[{"h": x, "words": v[0], "numbers": v[1]} for x, v in d.items()] for d in lines]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("host"), batch.column("text_key"),
                 *[pa.array(m[c], pa.int64()) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
                 pa.array(cells, pa.list_(pa.struct([("h", pa.int64()), ("words", pa.int32()),
                                                     ("numbers", pa.list_(pa.int32()))])))],
                ["doc_id", "host", "text_key", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                 "lines"])


def _different(docs: DataFrame, held: DataFrame) -> DataFrame:
    """``(host, h, different)``: the documents that hold a line by ``held`` (host, h, row), exact and edited copies counted once."""
    keyed = docs.select("doc_id", "text", "text_key", row_key().alias("row"))
    # written: two passes read it, and a stage of two Python functions would hold two workers for each task
    some = scratch_table(keyed.mapInArrow(key_filter(held.select("row"), "row"), keyed.schema), "holders")
    copies = scratch_table(copy_classes(some).filter("row <> class").distinct(), "moved")
    return (held.join(copies, "row", "left").select("host", "h", F.coalesce("class", "row").alias("class"))
            .groupBy("host", "h", "class").agg(F.lit(1).alias("x"))
            .groupBy("host", "h").agg(F.count(F.lit(1)).alias("different")))


def judge(docs: DataFrame, p: LineRules = LineRules()) -> DataFrame:
    """Per row: measures, ``removed_words``, ``removed`` (numbers of boilerplate lines), ``base_failed``, ``kept``."""
    ship(docs.sparkSession)
    narrow = docs.select("doc_id", "text", F.xxhash64("source").alias("host"), F.xxhash64("text").alias("text_key"))
    prof = scratch_table(narrow.mapInArrow(_profile_batches, _PROFILE), "profile")
    hosts = prof.groupBy("host").agg(F.count(F.lit(1)).alias("host_docs"))
    row = ["doc_id", "text_key", "host"]
    each = prof.select(*row, F.explode("lines").alias("l")).select(*row, "l.h", "l.words", "l.numbers")
    limit = F.greatest(F.lit(p.line_docs), F.ceil(F.col("host_docs") * p.line_share))
    frequent = (each.groupBy("host", "h", "text_key").agg(F.lit(1).alias("x")).groupBy("host", "h").agg(F.count(F.lit(1)).alias("docs"))
                .join(hosts, "host").withColumn("limit", limit).filter("docs > limit").select("host", "h", "limit"))
    frequent = scratch_table(frequent, "frequent")
    different = _different(narrow, scratch_table(each.join(frequent.select("host", "h"), ["host", "h"])
                                                 .select("host", "h", row_key().alias("row")), "held"))
    over = frequent.join(different, ["host", "h"]).filter("different > limit").select("host", "h")
    lost = (each.join(over, ["host", "h"]).dropDuplicates([*row, "h"])  # a repeated row has its lines once
            .groupBy(*row).agg(F.sum("words").cast("long").alias("lost"),
                               F.sort_array(F.flatten(F.collect_list("numbers"))).alias("numbers")))
    out = prof.drop("lines").alias("a").join(
        lost.alias("b"), F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col("a.text_key") == F.col("b.text_key"))
        & (F.col("a.host") == F.col("b.host")), "left").select(
        "a.*", F.coalesce("b.lost", F.lit(0)).alias("removed_words"), F.col("b.numbers").alias("removed"))
    base = (F.col("n_words") < p.min_words) | (100 * F.col("n_repeat_words") > p.repeat_percent * F.col("n_words"))
    depleted = 100 * F.col("removed_words") > p.depleted_percent * F.col("n_words")
    return (out.withColumn("base_failed", base).withColumn("kept", ~base & ~depleted))


def _strip_batches(mark: str):
    """Rewrite texts without the lines whose numbers ``mark`` holds; adjusts n_chars where the table has it."""
    def run(batches):
        for batch in batches:
            texts = batch.column("text").to_pylist()
            cuts = batch.column(mark).to_pylist()
            for i, cut in enumerate(cuts):
                if cut:
                    gone = set(cut)
                    texts[i] = "\n".join(x for k, x in enumerate(texts[i].split("\n")) if k not in gone)
            cols = {c: batch.column(c) for c in batch.schema.names if c != mark}
            cols["text"] = pa.array(texts, batch.schema.field("text").type)
            if "n_chars" in cols:
                cols["n_chars"] = pa.array([len(t) if cut else n for t, cut, n in zip(texts, cuts, cols["n_chars"].to_pylist())],
                                           cols["n_chars"].type)
            yield pa.RecordBatch.from_arrays(list(cols.values()), list(cols))
    return run


def apply_rules(docs: DataFrame, p: LineRules = LineRules()) -> DataFrame:
    """The rows of ``docs`` that are kept, with their boilerplate lines removed; same columns."""
    id_, key, host, mark = fresh(docs, "_id", "_key", "_host", "_removed")
    verdict = judge(docs, p).filter("kept").select("doc_id", "text_key", "host", "removed").toDF(id_, key, host, mark) \
        .dropDuplicates([id_, key, host])
    same = F.col("doc_id").eqNullSafe(F.col(id_)) & (F.xxhash64("text") == F.col(key)) & (F.xxhash64("source") == F.col(host))
    return docs.join(verdict, same).select(*docs.columns, mark).mapInArrow(_strip_batches(mark), docs.schema)
