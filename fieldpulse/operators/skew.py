"""Finding groups that are too large for one task, and joins that spread them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fieldpulse.session import scratch_dir

TASK_ROWS = 131_072
BATCH_ROWS = 524_288  # of a cached batch, some 60 bytes each: each shuffle that starts from it opens a file per task and partition
LEAST_ROWS = 8_192


@dataclass(frozen=True)
class HotGroups:
    """When a group is too large for one task.

    A group is hot above ``min_rows`` rows and above 1/``max_groups`` of all rows. The second condition
    bounds the number of hot groups by ``max_groups``, so their keys can be broadcast at any scale.
    ``slots`` bounds the counters of the first look at the data. At 10**12 rows a group of 5 million is hot.

    That look takes a sample in which a group of ``min_rows`` has ``sampled`` rows, and all rows if that is not
    fewer. It only picks the plan: a group near the limit may go either way, and both ways are exact.
    """

    min_rows: int = 1_000_000
    max_groups: int = 200_000
    slots: int = 1 << 21
    sampled: int = 10_000

    @property
    def share(self) -> float:
        return min(1.0, self.sampled / max(1, self.min_rows))


def _slot(keys: Sequence[str], hot: HotGroups) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(hot.slots))


def _slot_counts(rows: DataFrame, keys: Sequence[str], hot: HotGroups) -> DataFrame:
    """Estimated rows per hash slot of the keys. A task shuffles no more rows than it has in the sample, nor
    more than ``hot.slots``."""
    looked = rows.select(*keys) if hot.share == 1 else rows.select(*keys).sample(hot.share, seed=1)
    return looked.groupBy(_slot(keys, hot).alias("_slot")).agg((F.count(F.lit(1)) / hot.share).cast("long").alias("_n"))


def hot_limit(rows: DataFrame, keys: Sequence[str], hot: HotGroups) -> int | None:
    """Row count above which a group is hot, or None if no group can be.

    Counting every group would shuffle a row per group; a group is no larger than its slot, so counting
    slots is enough to rule hot groups out. Two numbers reach the driver.
    """
    return look(rows, keys, hot)[0]


def look(rows: DataFrame, keys: Sequence[str], hot: HotGroups) -> tuple[int | None, int]:
    """What ``hot_limit`` returns, and about how many rows there are."""
    seen = _slot_counts(rows, keys, hot).agg(
        F.max("_n").alias("largest"), F.sum("_n").alias("total")).first()
    if seen["total"] is None:
        return None, 0
    limit = max(hot.min_rows, seen["total"] // hot.max_groups)
    return (limit if seen["largest"] > limit else None), seen["total"]


def tasks_for(spark: SparkSession, rows: int, most: int = TASK_ROWS) -> int:
    """Tasks for so many rows: one per ``most``, or fewer rows each while there are cores, but not below ``LEAST_ROWS``.

    For frames that are cached after a shuffle: AQE leaves the partitions of a cached plan alone, and each shuffle that starts from them opens a
    file per task and partition.
    """
    return max(1, -(-rows // most), min(spark.sparkContext.defaultParallelism, rows // LEAST_ROWS))


def hot_groups(rows: DataFrame, keys: Sequence[str], hot: HotGroups, limit: int,
               *aggregates: Column) -> DataFrame:
    """Keys, ``count`` and ``aggregates`` of the hot groups; at most ``hot.max_groups`` rows.

    Only rows of hot slots are grouped. The result is written out, as several parts of a plan use it and
    must agree on which groups are hot.
    """
    slots = _slot_counts(rows, keys, hot).where(F.col("_n") > limit).select("_slot")
    groups = (rows.withColumn("_slot", _slot(keys, hot))
              .join(F.broadcast(slots), "_slot", "left_semi")
              .groupBy(*keys)
              .agg(F.count(F.lit(1)).alias("count"), *aggregates)
              .where(F.col("count") > limit))
    path = scratch_dir(rows.sparkSession, "hot-groups")
    groups.write.parquet(path)
    return rows.sparkSession.read.schema(groups.schema).parquet(path)


def spread_join(rows: DataFrame, one: DataFrame, keys: Sequence[str], spread_by: str, how: str,
                hot: HotGroups = HotGroups()) -> DataFrame:
    """Joins ``rows`` to ``one``, which has one row per key; rows of a hot key go to several tasks.

    A hot key gets one salt per ``limit`` rows, drawn from the ``spread_by`` column of ``rows``, and its row in
    ``one`` is repeated for each salt. AQE splits skewed joins by itself, but not if the sides come out of a
    grouping by the same keys or go into one.
    """
    keys = list(keys)
    limit = hot_limit(rows, keys, hot)
    if limit is None:
        return rows.join(one, keys, how)
    salts = F.broadcast(hot_groups(rows, keys, hot, limit).select(
        *keys, F.ceil(F.col("count") / limit).alias("_salts")))
    number = F.coalesce("_salts", F.lit(1))
    left = rows.join(salts, keys, "left").withColumn("_salt", F.pmod(F.xxhash64(spread_by), number))
    right = one.join(salts, keys, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0).cast("long"), number - 1)))
    return left.drop("_salts").join(right.drop("_salts"), [*keys, "_salt"], how).drop("_salt")


def last_before(rows: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, name: str) -> DataFrame:
    """``rows`` with the last non-null ``value`` among the earlier rows of the same keys, or null.

    A window over the keys alone would hold all rows of a hot key in one task. Rows are dealt by key *and* order instead, so a hot key spans
    several tasks; each looks at its own run of rows, and what the runs before it end with is carried over, one row per key and run.
    """
    keys = list(keys)
    placed = rows.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order).withColumn("_place", F.monotonically_increasing_id())
    path = scratch_dir(rows.sparkSession, "in-order")
    placed.write.parquet(path)
    placed = rows.sparkSession.read.schema(placed.schema).parquet(path).withColumn("_run", F.shiftright("_place", 33))
    own = F.last(value, True).over(Window.partitionBy(*keys, "_run").orderBy("_place").rowsBetween(Window.unboundedPreceding, -1))
    ends = placed.where(F.col(value).isNotNull()).groupBy(*keys, "_run").agg(F.max_by(value, "_place").alias("_end"))
    runs = placed.select(*keys, "_run").distinct().join(ends, [*keys, "_run"], "left")
    carried = runs.select(*keys, "_run", F.last("_end", True).over(
        Window.partitionBy(*keys).orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)).alias("_carried"))
    return (placed.withColumn("_own", own).join(carried, [*keys, "_run"], "left")
            .withColumn(name, F.coalesce("_own", "_carried")).select(*rows.columns, name))
