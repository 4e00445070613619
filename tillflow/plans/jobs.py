"""Composite jobs (C1-C4): the layered pipeline with written tables.

Each layer is written once and the next layer reads it back, so lineage is
cut at every layer (a lost executor recomputes from the last written table,
not from the raw feed), and Gold reads Silver with a literal time bound that
Parquet can use to skip row groups.

    python -m tillflow.plans.jobs <sf_dir> <lake_dir> [bronze|silver|gold|train|all]
        [--source fixture|files|kafka] [--feed PATH] [--bootstrap HOSTS] [--topic NAME] [--duration SECONDS]
        [--format parquet|delta] [--no-models]

``--source files`` ingests a folder of Kafka-shaped JSON lines and ``kafka`` a
topic, both as a checkpointed stream that stops when drained or after
``--duration`` seconds; ``fixture`` builds Bronze from the driver tables.
"""

from __future__ import annotations

import argparse
import logging
import os
import sys

from pyspark.sql import SparkSession

from tillflow.operators import gold, ml, silver
from tillflow.sources import store
from tillflow.sources.schemas import DEFAULT_TOPIC
from tillflow.sources.tables import bronze_batch, in_share
from tillflow.streaming import bronze as stream

SILVER_FOLDER = "silver"
SILVER_TABLES = {"purchases": "silver_purchases", "cancellations": "silver_cancellations"}
# folder inside the lake -> table name
LAYERS = {"bronze": "bronze", **{f"{SILVER_FOLDER}/{silver.SILVER_TABLE}={v}": t for v, t in SILVER_TABLES.items()}, "gold": "gold"}

# A job that moves all its rows writes them share after share, each of so many bytes of its input at least, so that the
# exchanges of one share at a time lie on disk. Every share reads the input again, so their number does not grow with it.
MAX_SHARES, SHARE_BYTES = 4, 32 << 20


def shares(size: int, fmt: str = "parquet") -> list[tuple[int, int]]:
    """The shares (i, n) that a job over so many bytes of files is written in; one for Delta, where each write is a version."""
    n = 1 if fmt == "delta" else max(1, min(MAX_SHARES, size // SHARE_BYTES))
    return [(i, n) for i in range(n)]


def bronze_job(spark: SparkSession, sf_dir: str, lake: str, fmt: str = "parquet") -> int:
    """C1 in batch form: the fixture feed decoded into the Bronze table, by shares of the orders."""
    parts = shares(store.stored_bytes(spark, os.path.join(sf_dir, "lineitem.parquet")), fmt)
    return store.publish([bronze_batch(spark, sf_dir, share=s) for s in parts], lake, "bronze", fmt)


def bronze_stream_job(spark: SparkSession, lake: str, source: str, feed: str | None = None, bootstrap: str | None = None,
                      topic: str = DEFAULT_TOPIC, duration_seconds: float = 0, fmt: str = "parquet") -> int:
    """C1 as a stream: a feed folder or a Kafka topic appended to Bronze, with checkpoint and progress table."""
    return stream.run_ingest(spark, feed, os.path.join(lake, "bronze"), os.path.join(lake, "_checkpoints", "bronze"),
                             duration_seconds, fmt, source, bootstrap, topic,
                             progress_path=os.path.join(lake, "_progress", "bronze"))


def silver_job(spark: SparkSession, lake: str, fmt: str = "parquet") -> dict:
    """Bronze -> typed -> cleaned -> purchases / cancellations.

    The cleaned rows are tagged with their table and written once, partitioned
    by the tag: one evaluation of the de-duplication and one write for both
    tables (the original job re-ran the de-duplication per action). Bronze is read
    again rather than moved (``silver.drop_replays_of_written``). Rows are
    sorted by time inside each file (a local sort, no shuffle), so Parquet
    min/max statistics let Gold's literal time bound skip row groups.
    """
    clean = silver.silver_clean_written(silver.silver_typed(store.read_layer(spark, lake, "bronze", fmt)))
    tagged = silver.with_silver_table(clean).sortWithinPartitions(silver.SILVER_TABLE, "invoice_date")
    return store.publish_split(tagged, lake, SILVER_FOLDER, silver.SILVER_TABLE, SILVER_TABLES, fmt)


def read_silver(spark: SparkSession, lake: str, table: str, fmt: str = "parquet"):
    value = {v: k for k, v in SILVER_TABLES.items()}[table]
    return store.read_split(spark, lake, SILVER_FOLDER, silver.SILVER_TABLE, value, silver.written_schema(spark), fmt)


def gold_job(spark: SparkSession, lake: str, fmt: str = "parquet", require_target: bool = True) -> int:
    """Silver tables -> Gold, with the split computed once and used as a literal, by shares of the customers."""
    p = read_silver(spark, lake, "silver_purchases", fmt)
    c = read_silver(spark, lake, "silver_cancellations", fmt)
    split = gold.split_column(p)
    parts = [gold.gold_features_joined(in_share(p, gold.K, s), in_share(c, gold.K, s), split, require_target)
             for s in shares(store.stored_bytes(spark, os.path.join(lake, SILVER_FOLDER)), fmt)]
    return store.publish(parts, lake, "gold", fmt)


def train_job(spark: SparkSession, lake: str, fmt: str = "parquet", model_dir: str | None = None,
              save_models: bool = True) -> list:
    """C4: Gold -> five regressors -> run log, and saved models (under ``<lake>/models`` by default).

    A model that cannot be saved is a warning: the run is logged all the same.
    """
    t = ml.train_all(store.read_layer(spark, lake, "gold", fmt))
    train_rows = t.prepared.filter("split = 'train'").count()
    metrics = [{**r.asDict(), "train_rows": train_rows} for r in ml.model_metrics(t).collect()]  # one row per model
    store.log_runs(spark, lake, ml.run_records(t, metrics))
    if save_models:
        folder = model_dir or os.path.join(lake, "models")
        for name, m in {**t.models, "feature_pipeline": t.pipeline}.items():
            try:
                ml.save_model(m, os.path.join(folder, name))
            except Exception as failed:  # noqa: BLE001  any store error
                logging.getLogger(__name__).warning("model %s was not saved: %s", name, failed)
    return metrics


def run_all(spark: SparkSession, sf_dir: str, lake: str, fmt: str = "parquet") -> dict:
    out = {"bronze": bronze_job(spark, sf_dir, lake, fmt)}
    out.update(silver_job(spark, lake, fmt))
    out["gold"] = gold_job(spark, lake, fmt)
    return out


def main(argv: list[str], spark: SparkSession | None = None) -> None:
    from tillflow.session import build_session
    parse = argparse.ArgumentParser(prog="tillflow.plans.jobs")
    parse.add_argument("sf_dir")
    parse.add_argument("lake")
    parse.add_argument("step", nargs="?", default="all", choices=["bronze", "silver", "gold", "train", "all"])
    parse.add_argument("--source", default="fixture", choices=["fixture", "files", "kafka"])
    parse.add_argument("--feed")
    parse.add_argument("--bootstrap")
    parse.add_argument("--topic", default=DEFAULT_TOPIC)
    parse.add_argument("--duration", type=float, default=0)
    parse.add_argument("--format", default="parquet", choices=["parquet", "delta"])
    parse.add_argument("--no-models", action="store_true")
    a = parse.parse_args(argv)
    spark, fmt, lake = spark or build_session(), a.format, a.lake
    if a.step in ("bronze", "all"):
        n = bronze_job(spark, a.sf_dir, lake, fmt) if a.source == "fixture" else \
            bronze_stream_job(spark, lake, a.source, a.feed, a.bootstrap, a.topic, a.duration, fmt)
        print("bronze", n)
    if a.step in ("silver", "all"):
        print("silver", silver_job(spark, lake, fmt))
    if a.step in ("gold", "all"):
        print("gold", gold_job(spark, lake, fmt))
    if a.step in ("train", "all"):
        for m in train_job(spark, lake, fmt, save_models=not a.no_models):
            print(m)
    store.layer_counts(spark, lake, list(LAYERS), fmt).show()


if __name__ == "__main__":
    main(sys.argv[1:])
