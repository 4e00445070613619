"""Table store: overwrite publishing with a version log, layer counts, and the run log.

The format is a setting: ``parquet`` offline, ``delta`` where the Delta jars
are installed. Without Delta's own history, every publish appends one row to a
small log table next to the data (K7).
"""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillflow.session import release_shuffles
from tillflow.sources.schemas import PUBLISH_LOG_SCHEMA, RUN_LOG_SCHEMA

LOG_DIR = "_publish_log"


def _exists(spark: SparkSession, path: str, fmt: str = "parquet") -> bool:
    """Whether a table folder can be read (a missing path raises at analysis, no job runs)."""
    from pyspark.errors import AnalysisException
    try:
        spark.read.format(fmt).load(path).schema
        return True
    except AnalysisException:
        return False


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of a table's files, as its file system lists them (no job, no scan)."""
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(sc._jsc.hadoopConfiguration()).getContentSummary(p).getLength()


CODEC_CONF = "spark.sql.parquet.compression.codec"


def _writer(df: DataFrame, fmt: str, mode: str = "overwrite") -> DataFrameWriter:
    """A layer's writer; Parquet files are compressed with Zstandard unless the session names a codec."""
    spark = df.sparkSession
    w = df.write.format(fmt).mode(mode)
    named = spark.sparkContext.getConf().contains(CODEC_CONF) or spark.conf.get(CODEC_CONF) != "snappy"
    return w if fmt != "parquet" or named else w.option("compression", "zstd")


def publish(df: DataFrame | list[DataFrame], root: str, table: str, fmt: str = "parquet",
            partition_by: list[str] | None = None) -> int:
    """K3: overwrite ``root/table`` (schema replaced), log the version, return rows written.

    A list of frames is one version, written frame after frame, so that the exchanges of one of
    them at a time lie on disk. The row count is read back from the written files, so the data is
    computed once; the count itself touches only file footers for Parquet.
    """
    frames = df if isinstance(df, list) else [df]
    spark = frames[0].sparkSession
    path = os.path.join(root, table)
    with release_shuffles(spark):
        for n, frame in enumerate(frames):
            w = _writer(frame, fmt, "append" if n else "overwrite")
            if fmt == "delta" and not n:
                w = w.option("overwriteSchema", "true")
            if partition_by:
                w = w.partitionBy(*partition_by)
            w.save(path)
        rows = spark.read.format(fmt).load(path).count()
    _log(spark, root, table, rows, path)
    return rows


def publish_split(df: DataFrame, root: str, folder: str, column: str, tables: dict[str, str],
                  fmt: str = "parquet") -> dict[str, int]:
    """K3 for tables that are partitions of one write: ``tables`` maps a value of
    ``column`` to a table name. Rows with another value (or null) are not written.
    The whole folder is replaced (a table without rows leaves no old partition).
    Each table is logged with its own row count (from one grouped count)."""
    spark = df.sparkSession
    path = os.path.join(root, folder)
    w = _writer(df.filter(F.col(column).isin(list(tables))), fmt).partitionBy(column)
    w = w.option("overwriteSchema" if fmt == "delta" else "partitionOverwriteMode", "true" if fmt == "delta" else "static")
    with release_shuffles(spark):
        w.save(path)
        back = read_split(spark, root, folder, column, None, df.schema, fmt)
        counts = {r[column]: r["n"] for r in back.groupBy(column).agg(F.count("*").alias("n")).collect()}
    out = {}
    for value, table in tables.items():
        out[table] = counts.get(value, 0)
        _log(spark, root, table, out[table], f"{path}/{column}={value}")
    return out


def read_split(spark: SparkSession, root: str, folder: str, column: str, value: str | None, schema: T.StructType,
               fmt: str = "parquet") -> DataFrame:
    """A table of ``publish_split``: the folder's root, pruned to one partition (all of them for ``value`` None).

    The root is read with the known schema, so a table without rows is empty
    instead of a missing path, and a Delta folder is read as the table it is.
    """
    reader = spark.read.format(fmt)
    whole = (reader if fmt == "delta" else reader.schema(schema)).load(os.path.join(root, folder))
    return whole if value is None else whole.filter(F.col(column) == value).drop(column)


def _now() -> dt.datetime:
    """Zone-aware, so that the stored instant does not depend on the process's zone."""
    return dt.datetime.now(dt.timezone.utc)


def _log(spark: SparkSession, root: str, table: str, rows: int, path: str) -> None:
    log_path = os.path.join(root, LOG_DIR)
    version = 0
    if _exists(spark, log_path):
        prev = spark.read.schema(PUBLISH_LOG_SCHEMA).parquet(log_path).filter(F.col("table") == table) \
                    .agg(F.max("version")).first()[0]
        version = 0 if prev is None else prev + 1
    entry = spark.createDataFrame([(table, version, _now(), "WRITE" if version == 0 else "OVERWRITE", rows, path)],
                                  PUBLISH_LOG_SCHEMA)
    entry.coalesce(1).write.mode("append").parquet(log_path)


def publish_history(spark: SparkSession, root: str, table: str, fmt: str = "parquet") -> DataFrame:
    """K7: versions of one table, newest first (empty frame when never published).

    With ``fmt="delta"`` the table's own transaction history answers; otherwise
    the log that every publish appends to.
    """
    if fmt == "delta":
        from delta.tables import DeltaTable
        path = os.path.join(root, table)
        return DeltaTable.forPath(spark, path).history().select(
            F.lit(table).alias("table"), F.col("version"), F.col("timestamp"), F.col("operation"),
            F.col("operationMetrics")["numOutputRows"].cast("long").alias("num_output_rows"), F.lit(path).alias("path"))
    log_path = os.path.join(root, LOG_DIR)
    if not _exists(spark, log_path):
        return spark.createDataFrame([], PUBLISH_LOG_SCHEMA)
    return spark.read.schema(PUBLISH_LOG_SCHEMA).parquet(log_path).filter(F.col("table") == table) \
                .orderBy(F.col("version").desc())


def read_layer(spark: SparkSession, root: str, table: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(os.path.join(root, table))


def layer_counts(spark: SparkSession, root: str, tables: list[str], fmt: str = "parquet") -> DataFrame:
    """Row count of every present layer; absent layers are skipped."""
    out = None
    for t in tables:
        path = os.path.join(root, t)
        if not _exists(spark, path, fmt):
            continue
        r = spark.read.format(fmt).load(path).agg(F.count("*").alias("row_count")) \
                 .select(F.lit(t).alias("layer"), "row_count")
        out = r if out is None else out.unionByName(r)
    if out is None:
        return spark.createDataFrame([], "layer string, row_count long")
    return out


def schema_report(df: DataFrame, table: str) -> DataFrame:
    """(table, column, type, nullable) of a frame's schema."""
    rows = [(table, f.name, f.dataType.simpleString(), f.nullable) for f in df.schema.fields]
    return df.sparkSession.createDataFrame(rows, "table string, column_name string, data_type string, nullable boolean")


# ------------------------------------------------------------------ run log
def log_runs(spark: SparkSession, root: str, runs: list[dict]) -> None:
    """K5: append one row per model run (params and metrics as maps)."""
    rows = [(r["experiment"], r["run_name"], r["model_type"], r.get("started_at"),
             {k: str(v) for k, v in r.get("params", {}).items()},
             {k: float(v) for k, v in r.get("metrics", {}).items() if v is not None})
            for r in runs]
    spark.createDataFrame(rows, RUN_LOG_SCHEMA).coalesce(1).write.mode("append").parquet(os.path.join(root, "runs"))


def search_runs(spark: SparkSession, root: str, experiment: str) -> DataFrame:
    """All runs of one experiment; an empty frame when there are none."""
    path = os.path.join(root, "runs")
    if not _exists(spark, path):
        return spark.createDataFrame([], RUN_LOG_SCHEMA)
    return spark.read.schema(RUN_LOG_SCHEMA).parquet(path).filter(F.col("experiment") == experiment)
