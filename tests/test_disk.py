"""What the jobs keep on disk: exchanges end with their action, layers are compressed, shares are the whole."""

import glob
import os
import tempfile
import time

import pytest
from conftest import SF, msg, records
from pyspark.sql import functions as F

from tillflow.operators import silver
from tillflow.plans import jobs
from tillflow.sources import store
from tillflow.sources.tables import bronze_batch
from tillflow.streaming.bronze import decode


def _shuffle_bytes(spark):
    dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return sum(os.path.getsize(f) for d in dirs for f in glob.glob(f"{d}/*/shuffle_*.data"))


def _same(a, b):
    b = b.select(*a.columns)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_publish_leaves_no_exchange_on_disk(spark):
    root = tempfile.mkdtemp(prefix="tillflow-disk-")
    df = spark.range(100_000).select("id", F.md5(F.col("id").cast("string")).alias("text"))
    before = _shuffle_bytes(spark)
    assert store.publish(df.repartition(4, "text"), root, "t") == 100_000
    tables = {"even": "e", "odd": "o"}
    tagged = df.withColumn("tag", F.when(F.col("id") % 2 == 0, "even").otherwise("odd"))
    assert store.publish_split(tagged.repartition(4, "text"), root, "s", "tag", tables) == {"e": 50_000, "o": 50_000}
    until = time.time() + 20  # the files are deleted by messages to the executors
    while (left := _shuffle_bytes(spark) - before) > 100_000 and time.time() < until:
        time.sleep(0.2)
    assert left < 100_000  # each of the two exchanges holds millions of bytes
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_layers_are_compressed_unless_the_session_names_a_codec(spark):
    import pyarrow.parquet as pq
    root = tempfile.mkdtemp(prefix="tillflow-codec-")
    codec = lambda t: {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in glob.glob(f"{root}/{t}/*.parquet")}
    store.publish(spark.range(10), root, "a")
    assert codec("a") == {"ZSTD"}
    spark.conf.set("spark.sql.parquet.compression.codec", "gzip")
    try:
        store.publish(spark.range(10), root, "b")
    finally:
        spark.conf.unset("spark.sql.parquet.compression.codec")
    assert codec("b") == {"GZIP"}


@pytest.mark.parametrize("bits", [26, 15, 4])  # few slots: rows without a copy hit marks of others
def test_replays_of_written_rows(spark, monkeypatch, bits):
    monkeypatch.setattr(silver, "SLOT_BITS", bits)
    messages = [msg(customer=i % 7 or None, invoice=str(i % 40), code=[None, "A", "B"][i % 3], qty=[1, None][i % 2],
                    desc=None if i % 11 == 0 else f"d{i}", when=["2020-01-01T10:00:00", "bad"][i % 5 == 0]) for i in range(300)]
    path = os.path.join(tempfile.mkdtemp(prefix="tillflow-replays-"), "bronze")
    decode(records(spark, messages + messages[:50]), F.lit("2020-01-01").cast("timestamp")).write.parquet(path)
    typed = silver.silver_typed(spark.read.parquet(path))
    whole, marked = silver.silver_clean(typed), silver.silver_clean_written(typed)
    assert marked.columns == whole.columns and 0 < whole.count() < typed.count()
    assert _same(whole, marked)


def test_rows_without_copies_are_not_moved(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="tillflow-moved-"), "bronze")
    bronze_batch(spark, SF).write.parquet(path)
    clean = silver.silver_clean_written(silver.silver_typed(spark.read.parquet(path)))
    before = _shuffle_bytes(spark)
    n = len(clean.select(*clean.columns).collect())
    assert 0 < _shuffle_bytes(spark) - before < 40 * n  # hashes; the rows themselves are some 90 bytes


def test_shares_are_the_whole(spark, monkeypatch):
    assert jobs.shares(0) == [(0, 1)] and jobs.shares(10**12, "delta") == [(0, 1)]
    assert len(jobs.shares(10**12)) == jobs.MAX_SHARES
    lakes = [tempfile.mkdtemp(prefix="tillflow-shares-") for _ in range(2)]
    counts = [jobs.run_all(spark, SF, lakes[0])]
    monkeypatch.setattr(jobs, "SHARE_BYTES", 10_000)
    assert len(jobs.shares(store.stored_bytes(spark, f"{SF}/lineitem.parquet"))) > 1
    assert len(jobs.shares(store.stored_bytes(spark, os.path.join(lakes[0], jobs.SILVER_FOLDER)))) > 1
    counts.append(jobs.run_all(spark, SF, lakes[1]))
    assert counts[0] == counts[1] and all(counts[0].values())
    for layer in ("bronze", "silver", "gold"):
        one, shared = (store.read_layer(spark, lake, layer) for lake in lakes)
        rounded = lambda df: df.select(*[F.round(c, 6).alias(c) if t == "double" else c for c, t in df.dtypes])
        assert _same(rounded(one), rounded(shared))
    assert [r["version"] for r in store.publish_history(spark, lakes[1], "bronze").collect()] == [0]
