"""Builds the layer DataFrames of one run from a folder of driver tables.

Every registered query starts here, so its work grows with the input tables.
Plans are lazy. Queries that need Silver more than once (the split instant,
then the rows; both tables; Gold and counts) use the ``written`` forms: the
cleaned rows are evaluated once, tagged with their table and written as Parquet
under the shared folder, and every later plan scans the columns it needs from
there. The application owns these folders (``session.scratch_root``).
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.operators import gold, silver
from tillflow.session import scratch_path
from tillflow.sources.tables import bronze_batch, transactions


@dataclass
class Layers:
    spark: SparkSession
    sf_dir: str
    _tables: dict = field(default_factory=dict)

    def transactions(self) -> DataFrame:
        return transactions(self.spark, self.sf_dir).drop("_feed_position")

    def bronze(self) -> DataFrame:
        return bronze_batch(self.spark, self.sf_dir)

    def typed(self) -> DataFrame:
        return silver.silver_typed(self.bronze())

    def clean(self) -> DataFrame:
        return silver.silver_clean(self.typed())

    def purchases(self) -> DataFrame:
        return silver.purchases(self.clean())

    def cancellations(self) -> DataFrame:
        return silver.cancellations(self.clean())

    # ------------------------------------------------------- written forms
    def write(self, df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
        """Evaluate ``df`` once into a scratch table and read that (columnar, so later plans prune columns)."""
        path = scratch_path(self.spark, f"{name}-{uuid.uuid4().hex}")
        w = df.write
        (w.partitionBy(*partition_by) if partition_by else w).parquet(path)
        # partition columns come back last; the schema keeps an empty table readable
        cols = [c for c in df.columns if c not in (partition_by or [])] + (partition_by or [])
        return self.spark.read.schema(df.select(*cols).schema).parquet(path).select(*df.columns)

    def written_silver(self) -> DataFrame:
        """The cleaned rows, written once: the Gold inputs and the table tag (null: neither table)."""
        if "silver" not in self._tables:
            tagged = silver.with_silver_table(self.clean()).select(*gold.INPUT_COLUMNS, silver.SILVER_TABLE)
            self._tables["silver"] = self.write(tagged, "silver", [silver.SILVER_TABLE])
        return self._tables["silver"]

    def _written(self, table: str) -> DataFrame:
        return self.written_silver().filter(F.col(silver.SILVER_TABLE) == table).drop(silver.SILVER_TABLE)

    def written_purchases(self) -> DataFrame:
        return self._written("purchases")

    def written_cancellations(self) -> DataFrame:
        return self._written("cancellations")

    def split(self) -> Column:
        if "split" not in self._tables:
            self._tables["split"] = gold.split_column(self.written_purchases())
        return self._tables["split"]

    def periods(self):
        """(feature purchases, target purchases, feature cancellations) and the split."""
        split = self.split()
        f, t, c = gold.temporal_split(self.written_purchases(), self.written_cancellations(), split)
        return f, t, c, split

    def gold(self) -> DataFrame:
        return gold.gold_features_joined(self.written_purchases(), self.written_cancellations(), self.split())

    def gold_materialized(self) -> DataFrame:
        """Gold written as a table, for queries that read it several times (quantile bounds, ranges, then the rows)."""
        if "gold" not in self._tables:
            self._tables["gold"] = self.write(self.gold(), "gold")
        return self._tables["gold"]

    def customer_stats(self) -> DataFrame:
        """The customer profile written as a table, for queries that take bounds from it first."""
        from tillflow.operators.reports import customer_stats
        if "stats" not in self._tables:
            self._tables["stats"] = self.write(customer_stats(self.purchases()), "customer-stats")
        return self._tables["stats"]


def rounded(df: DataFrame, places: int = 4) -> DataFrame:
    """Round every double column (D9: sum order differs between engines)."""
    return df.select(*[F.round(F.col(f.name), places).alias(f.name)
                       if f.dataType.typeName() in ("double", "float") else F.col(f.name)
                       for f in df.schema.fields])
