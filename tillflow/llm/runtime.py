"""Shared plumbing: code shipping, scratch tables, size-bounded Arrow slices.

Scratch tables are Parquet folders under ``spark.checkpoint.dir`` (resolved by
``tillflow.session``), so a lost executor re-reads them instead of recomputing.
"""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from tillflow.session import scratch_path

_PACKAGE = os.path.dirname(os.path.abspath(__file__))


# Bounds of one Arrow batch between the JVM and a Python worker, unless the Spark configuration names its own:
# texts can be long, and both sides hold whole batches.
BATCH_BOUNDS = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000", "spark.sql.execution.arrow.maxBytesPerBatch": "4m"}


def ship(spark: SparkSession) -> None:
    """Send this package's code to the executors, once per Spark context, and bound the session's Arrow batches.

    The same as ``--py-files``; it makes the Arrow functions importable there
    however the driver itself found the package.
    """
    sc = spark.sparkContext
    for key, bound in BATCH_BOUNDS.items():
        if not sc.getConf().contains(key):
            spark.conf.set(key, bound)
    if getattr(sc, "_tillflow_llm_shipped", False):
        return
    path = os.path.join(tempfile.mkdtemp(prefix="tillflow-code-"), f"tillflow_llm_{uuid.uuid4().hex}.zip")
    root = os.path.dirname(_PACKAGE)
    with zipfile.ZipFile(path, "w") as z:
        z.write(os.path.join(root, "__init__.py"), "tillflow/__init__.py")
        z.write(os.path.join(root, "session.py"), "tillflow/session.py")
        for name in sorted(os.listdir(_PACKAGE)):
            if name.endswith(".py"):
                z.write(os.path.join(_PACKAGE, name), f"tillflow/llm/{name}")
    sc.addPyFile(path)
    sc._tillflow_llm_shipped = True


def scratch_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new folder of the shared scratch space and read it back (cuts lineage)."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names for helper columns that no column of ``df`` has (whatever the letter case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
    return out


def drop_scratch(*tables: DataFrame) -> None:
    """Delete the folders of scratch tables that no later plan reads."""
    for df in tables:
        jvm = df.sparkSession.sparkContext._jvm
        conf = df.sparkSession.sparkContext._jsc.hadoopConfiguration()
        for folder in {os.path.dirname(f) for f in df.inputFiles()}:
            if os.path.basename(folder).startswith("llm-"):
                path = jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(conf).delete(path, True)


def trim_memory() -> None:
    """Give freed memory back to the system: a Python worker outlives its tasks and shares the executor's budget."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def slices(batch: pa.RecordBatch, column: str = "text", max_bytes: int = 1 << 19) -> Iterator[pa.RecordBatch]:
    """Consecutive row slices of a batch holding about ``max_bytes`` of text each.

    A row is never divided: one longer text makes a slice of its own.
    """
    n, start, size = batch.num_rows, 0, 0
    if n == 0:
        return
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    for i, length in enumerate(lengths):
        if size and size + length > max_bytes:
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += length
    yield batch.slice(start, n - start)
    trim_memory()


def text_buffer(col: pa.Array):
    """(bytes as uint8, row offsets) of a string column; nulls are empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = pc.fill_null(col, "").cast(pa.large_string())
    offs = np.frombuffer(col.buffers()[1], dtype=np.int64)[col.offset:col.offset + len(col) + 1]
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    data = col.buffers()[2]
    buf = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return buf[offs[0]:offs[-1]], offs - offs[0]


FILTER_BITS = 1 << 24


def key_bitmap(keys: DataFrame, column: str) -> tuple[bytes, int]:
    """A bitmap of the long ``column`` and its number of bits: sixteen a key, FILTER_BITS (2 MB) at most.

    At most FILTER_BITS / 64 rows reach the driver, whatever the number of keys; with
    very many keys the bitmap tells less. A key of ``keys`` always hits it.
    """
    from pyspark.sql import functions as F

    n = keys.count()
    bits = min(FILTER_BITS, max(1 << 12, 1 << (16 * n).bit_length()))
    slot = f"({column} & {bits - 1}L)"
    got = keys.select(F.expr(f"{slot} div 64").alias("cell"), F.expr(f"shiftleft(1L, cast({slot} % 64 as int))").alias("bit")) \
              .groupBy("cell").agg(F.bit_or("bit").alias("bits")).collect()
    cells = np.zeros(bits // 64, "<i8")
    for r in got:
        cells[r["cell"]] = r["bits"]
    return cells.tobytes(), bits


def hits(bitmap: bytes, bits: int, keys: pa.Array) -> np.ndarray:
    """Whether each key may be among those of the bitmap."""
    table = np.frombuffer(bitmap, np.uint8)
    slot = keys.to_numpy(zero_copy_only=False).astype(np.int64) & (bits - 1)
    return (table[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 > 0


def key_filter(keys: DataFrame, column: str):
    """A ``mapInArrow`` function that keeps the rows whose long ``column`` may be among those of ``keys``.

    It only spares an exact join the rows that cannot match.
    """
    bitmap, bits = key_bitmap(keys, column)

    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(hits(bitmap, bits, batch.column(column))))
    return run
