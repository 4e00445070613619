"""Silver: typing, cleaning, de-duplication and the purchase/cancellation split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillflow.functions import parse_ts
from tillflow.session import bound_tasks
from tillflow.sources.schemas import CANCELLATION, DEDUP_KEYS

SURVIVOR_ORDER = ["kafka_timestamp", "kafka_partition", "kafka_offset"]


def silver_typed(bronze: DataFrame) -> DataFrame:
    """Timestamps parsed (null on bad text), money and the flag derived."""
    return bronze.withColumns({
        "timestamp": parse_ts("timestamp"),
        "invoice_date": parse_ts("invoice_date"),
        "total_price": F.col("quantity") * F.col("unit_price"),
        "is_cancellation": F.col("olay_tipi") == F.lit(CANCELLATION),
    })


def drop_replays(df: DataFrame, keys: list[str] = DEDUP_KEYS,
                 order: list[str] = SURVIVOR_ORDER) -> DataFrame:
    """One row per key combination; the earliest broker delivery survives.

    Written as an aggregation (``min`` of a struct whose leading fields are the
    delivery order) rather than a ``row_number`` window: the aggregation is
    combined map-side, so a hot group of copies (even a third of the table)
    collapses to one row per task before the shuffle instead of being sorted
    inside one reducer. Null keys group together, as in ``dropDuplicates``.
    """
    rest = [c for c in df.columns if c not in keys]
    out = df.groupBy(*keys).agg(survivor(df, keys, order).alias("_row"))
    return out.select(*[F.col(k) for k in keys], *[F.col(f"_row.{c}").alias(c) for c in rest]) \
              .select(*df.columns)


def survivor(df: DataFrame, keys: list[str] = DEDUP_KEYS, order: list[str] = SURVIVOR_ORDER) -> Column:
    """Aggregate: the non-key columns of a group's earliest delivery, as a struct."""
    bound_tasks(df.sparkSession)  # the aggregate sorts whole rows
    order = [c for c in order if c in df.columns]
    return F.min(F.struct(*order, *[c for c in df.columns if c not in keys and c not in order]))


def silver_clean(typed: DataFrame) -> DataFrame:
    """P8 + U2: customer and description present, replays removed."""
    return drop_replays(_complete(typed))


def silver_clean_written(typed: DataFrame) -> DataFrame:
    """``silver_clean`` for a written Bronze table, which is read again instead of moved (see ``drop_replays_of_written``)."""
    return drop_replays_of_written(_complete(typed))


def _complete(typed: DataFrame) -> DataFrame:
    return typed.filter(F.col("kullanici_ID").isNotNull()).filter(F.col("description").isNotNull())


# The bitmap of hashes that come more than once: 2^26 slots, one bit each, in rows of 2^15 (4 KB), 8 MB in all.
SLOT_BITS, SLOT_BITS_IN_ROW = 26, 15


def drop_replays_of_written(df: DataFrame, keys: list[str] = DEDUP_KEYS, order: list[str] = SURVIVOR_ORDER) -> DataFrame:
    """``drop_replays`` for rows that are cheap to read again (a written table): only rows that may have copies are moved.

    One exchange of 64-bit hashes of the keys finds those that come more than once; they are marked in a
    bitmap of fixed size. Rows that hit no mark have no copy and stay in the task that reads them; the others (all copies of
    a key hit the same mark) go through ``drop_replays``. Where very many keys repeat the marks tell less and more rows are moved.
    """
    slot = F.col("_hash").bitwiseAND((1 << SLOT_BITS) - 1)
    row, bit = F.shiftright(slot, SLOT_BITS_IN_ROW), slot.bitwiseAND((1 << SLOT_BITS_IN_ROW) - 1)
    hashed = df.withColumn("_hash", F.xxhash64(*keys))
    repeated = hashed.groupBy("_hash").agg(F.count("*").alias("_n")).filter(F.col("_n") > 1)
    marks = repeated.groupBy(row.alias("_row")).agg(F.bitmap_construct_agg(bit).alias("_marks"))
    byte = F.conv(F.hex(F.substring("_marks", F.shiftright(bit, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    marked = byte.bitwiseAND(F.expr("shiftleft(1, cast(_hash & 7 as int))")) != 0
    found = hashed.withColumn("_row", row).join(F.broadcast(marks), "_row", "left").withColumn("_may", F.coalesce(marked, F.lit(False)))
    alone = found.filter(~F.col("_may")).select(*df.columns)
    return alone.unionByName(drop_replays(found.filter("_may").select(*df.columns), keys, order))


def is_purchase() -> Column:
    """P9/P10 as a condition (null for a null flag, quantity or price that decides it)."""
    return ~F.col("is_cancellation") & (F.col("quantity") > 0) & (F.col("unit_price") > 0)


def purchases(clean: DataFrame) -> DataFrame:
    """Non-cancellation rows with positive quantity and price.

    A null flag satisfies neither ``~flag`` nor ``flag``: such rows reach
    neither table, as in the three-valued filter of the original job.
    """
    return clean.filter(~F.col("is_cancellation")) \
                .filter(F.col("quantity") > 0) \
                .filter(F.col("unit_price") > 0)


def cancellations(clean: DataFrame) -> DataFrame:
    """Rows flagged as cancellation (no sign or price filter)."""
    return clean.filter(F.col("is_cancellation"))


SILVER_TABLE = "silver_table"


def with_silver_table(clean: DataFrame) -> DataFrame:
    """U3 as one column: which Silver table a cleaned row belongs to (null: neither).

    Writing the cleaned rows once, partitioned by this column, gives both
    tables from one evaluation and one write; each table is then a partition
    that readers select by partition pruning.
    """
    tag = F.when(is_purchase(), F.lit("purchases")).when(F.col("is_cancellation"), F.lit("cancellations"))
    return clean.withColumn(SILVER_TABLE, tag)


def written_schema(spark) -> T.StructType:
    """Schema of the written Silver folder: the cleaned columns and the table tag."""
    from tillflow.streaming.bronze import FEED_SCHEMA, decode
    return with_silver_table(silver_typed(decode(spark.createDataFrame([], FEED_SCHEMA)))).schema


def silver_tables(bronze: DataFrame) -> tuple[DataFrame, DataFrame]:
    clean = silver_clean(silver_typed(bronze))
    return purchases(clean), cancellations(clean)
