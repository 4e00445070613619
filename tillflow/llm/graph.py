"""Connected components of large edge lists, and bounded work units for large groups."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillflow.llm.runtime import drop_scratch, scratch_table


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Components of the undirected edges ``(a long, b long)``: ``(id, component_id)``.

    ``component_id`` is the smallest id of the component. Every round each node
    picks the neighbour (or itself) of least hashed priority, nodes with one
    pick are merged, and edges inside a merged node vanish, so the edge list
    shrinks geometrically. Each round is aggregations with map-side
    combination and joins on written tables: no neighbour list is collected,
    so a node that neighbours a third of all others is no special case.
    """
    both = lambda e: e.select("a", "b").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    current = scratch_table(edges.select("a", "b").filter("a <> b").distinct(), "edges")
    levels: list[DataFrame] = []
    for _ in range(max_rounds):
        if current.isEmpty():
            break
        rank = lambda c: F.struct(F.xxhash64(c).alias("p"), F.col(c).alias("v"))
        pick = both(current).groupBy("a").agg(F.least(F.min(rank("b")), F.first(rank("a")))["v"].alias("pick"))
        level = scratch_table(pick.withColumnRenamed("a", "id"), "picks")
        levels.append(level)
        merged = (current.join(level.toDF("a", "pa"), "a").join(level.toDF("b", "pb"), "b")
                  .filter("pa <> pb")
                  .select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct())
        following = scratch_table(merged, "edges")
        drop_scratch(current)
        current = following
    else:
        raise RuntimeError("components did not converge")
    drop_scratch(current)
    if not levels:
        return edges.select(F.col("a").alias("id"), F.col("b").alias("component_id")).filter("false")
    at = levels[0].select("id", "pick")
    for level in levels[1:]:
        nxt = level.select(F.col("id").alias("pick"), F.col("pick").alias("next"))
        at = at.join(nxt, "pick", "left").select("id", F.coalesce("next", "pick").alias("pick"))
    at = scratch_table(at, "members")
    drop_scratch(*levels)
    least = at.groupBy("pick").agg(F.min("id").alias("component_id"))
    return at.join(least, "pick").select("id", "component_id")


def work_units(members: DataFrame, key: str, spread: Column, weight: Column, max_rows: int, max_weight: int,
               keep_blocks: bool = False) -> DataFrame:
    """Deal groups to bounded work units: adds ``blk``, ``bi`` and ``bj`` (and the block count ``nb``).

    Groups with one row are dropped. A group over ``max_rows`` rows or
    ``max_weight`` total weight is cut into blocks by the hash ``spread``, and
    every pair of blocks is one unit, so any two rows of a group meet in some
    unit while no task holds more than two blocks. Block counts come from an
    aggregation with map-side combination.
    """
    sizes = members.groupBy(F.col(key)).agg(F.count(F.lit(1)).alias("_n"), F.sum(weight).alias("_w")).filter("_n > 1")
    blocks = F.greatest(F.ceil(F.col("_n") / max_rows), F.ceil(F.col("_w") / max_weight)).cast("int")
    cut = (members.join(sizes.select(key, blocks.alias("_b")), key)
           .withColumn("blk", F.when(F.col("_b") > 1, F.pmod(spread, F.col("_b"))).otherwise(0).cast("int")))
    others = F.when(F.col("_b") > 1, F.filter(F.sequence(F.lit(0), F.col("_b") - 1), lambda x: x != F.col("blk"))) \
              .otherwise(F.array(F.lit(0)))
    return (cut.withColumn("_o", F.explode(others))
            .withColumn("bi", F.least("blk", "_o")).withColumn("bj", F.greatest("blk", "_o"))
            .withColumn("nb", F.col("_b")).drop("_o", "_b", *([] if keep_blocks else ["nb"])))


class Forest:
    """Union-find over positions 0..n-1 of one work unit."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def find(self, x: int) -> int:
        p = self.parent
        while p[x] != x:
            p[x] = p[p[x]]
            x = p[x]
        return x

    def union(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        if x == y:
            return False
        self.parent[max(x, y)] = min(x, y)
        return True

    def roots(self) -> np.ndarray:
        return np.array([self.find(x) for x in range(len(self.parent))], dtype=np.int64)
