"""Exact nearest-rank quantiles that do not depend on how large a group is.

Nearest rank of q over n values is the ceil(q * n)-th smallest. ``percentile_disc`` gives that, but one
task has to hold a group's distinct values. Groups that are too large for one task are found first and
answered by selection instead: a sketch proposes cut points around the rank, the rows between the cuts
are counted exactly, and only the rows of the slice that holds the rank go on. A slice with too many distinct values for one task is cut
again, into even parts, until it has few. The sketches decide how small a slice is, never what the answer is.

Rows may carry a weight: then a row stands for that many equal values.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldpulse.operators.skew import HotGroups, hot_groups, hot_limit
from fieldpulse.session import scratch_dir

# Distance of the cuts from the wanted quantile. The sketch errs by 1/ACCURACY of the rows at most, so
# the slice with the rank holds about 2/ACCURACY of them.
ACCURACY = 10_000
CUT_OFFSETS = (-64, -16, -4, -1, 1, 4, 16, 64)

# Distinct values of a group that one task may rank, and the parts into which a slice with more is cut.
RANKED_VALUES = 100_000
EVEN_CUTS = 200


def _fractions(q: float) -> list[float]:
    return [min(1.0, max(0.0, q + offset / ACCURACY)) for offset in CUT_OFFSETS]


def _select_rank(rows: DataFrame, keys: Sequence[str], value: str, hot: DataFrame, most: int = RANKED_VALUES) -> DataFrame:
    """The ``_rank``-th smallest value of each hot group, as ``p``. No task ranks more than about ``most`` values of a group."""
    keys = list(keys)
    none = F.lit(None).cast(rows.schema[value].dataType)
    search = hot.select(*keys, "_rank", "_cuts", none.alias("_low"), none.alias("_high"))
    done = None
    while True:
        inside = ((F.col("_low").isNull() | (F.col(value) > F.col("_low"))) & (F.col("_high").isNull() | (F.col(value) <= F.col("_high"))))
        # The slice of a value is the number of cuts below it.
        placed = (rows.join(F.broadcast(search), keys).where(inside)
                  .withColumn("_slice", F.size(F.filter("_cuts", lambda cut: cut < F.col(value)))))
        # At most one row per hot group and cut, so these windows are small.
        in_order = Window.partitionBy(*keys).orderBy("_slice")
        below = F.sum("_n").over(in_order) - F.col("_n")
        slices = placed.groupBy(*keys, "_slice", "_rank", "_cuts", "_low", "_high").agg(
            F.sum("_weight").alias("_n"), F.approx_count_distinct(value).alias("_values"))
        target = (slices.withColumn("_below", below)
                  .where((F.col("_below") < F.col("_rank")) & (F.col("_rank") <= F.col("_below") + F.col("_n")))
                  .select(*keys, (F.col("_rank") - F.col("_below")).alias("_rank"), "_values",
                          F.coalesce(F.get("_cuts", F.col("_slice") - 1), "_low").alias("_low"),
                          F.coalesce(F.get("_cuts", F.col("_slice")), "_high").alias("_high")))
        target = _written(target, "rank-slices")
        few, many = target.where(F.col("_values") <= most), target.where(F.col("_values") > most)
        # Equal values collapse before the shuffle.
        values = (rows.join(F.broadcast(few), keys).where(inside)
                  .groupBy(*keys, "_rank", value).agg(F.sum("_weight").alias("_n")))
        running = F.sum("_n").over(Window.partitionBy(*keys).orderBy(value))
        found = (values.withColumn("_upto", running).where(F.col("_upto") >= F.col("_rank"))
                 .groupBy(*keys).agg(F.min(value).alias("p")))
        done = found if done is None else done.unionByName(found)
        if many.isEmpty():
            return done
        even = [step / EVEN_CUTS for step in range(1, EVEN_CUTS)]
        # Cuts that part the distinct values evenly, so that every part is smaller however often a value occurs.
        cuts = rows.join(F.broadcast(many), keys).where(inside).select(*keys, value).distinct().groupBy(*keys).agg(
            F.array_distinct(F.percentile_approx(value, even, ACCURACY)).alias("_cuts"))
        search = _written(many.drop("_values").join(cuts, keys), "rank-cuts")


def _written(frame: DataFrame, purpose: str) -> DataFrame:
    path = scratch_dir(frame.sparkSession, purpose)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def _ordinary_stats(rows: DataFrame, keys: Sequence[str], value: str, q: float,
                    name: str) -> DataFrame:
    return rows.groupBy(*keys).agg(
        F.avg(value).alias("average"),
        F.expr(f"percentile_disc({q}D) WITHIN GROUP (ORDER BY `{value}`)").alias(name),
        F.count(F.lit(1)).alias("count"))


def _weighted_stats(rows: DataFrame, keys: Sequence[str], value: str, q: float, name: str, tasks: int | None = None) -> DataFrame:
    # Dealt by group at once, so that adding up, ranking and the result take one shuffle and not two. No group is too large for one task here.
    dealt = rows.repartition(*keys) if tasks is None else rows.repartition(tasks, *keys)
    counted = dealt.groupBy(*keys, value).agg(F.sum("_weight").alias("_n"))
    in_order = Window.partitionBy(*keys).orderBy(value)
    everything = Window.partitionBy(*keys)
    ranked = counted.withColumns({"_upto": F.sum("_n").over(in_order), "_all": F.sum("_n").over(everything)})
    return ranked.groupBy(*keys).agg(
        (F.sum(F.col(value) * F.col("_n")) / F.sum("_n")).alias("average"),
        F.min(F.when(F.col("_upto") >= F.ceil(F.col("_all") * F.lit(q)), F.col(value))).alias(name), F.sum("_n").alias("count"))


def group_stats(rows: DataFrame, keys: Sequence[str], value: str = "value", q: float = 0.95,
                name: str = "p95", hot: HotGroups | None = HotGroups(), weight: str | None = None, tasks: int | None = None) -> DataFrame:
    """``average``, nearest-rank quantile and ``count`` of ``value`` per group.

    Reads ``rows`` once to look for hot groups, so hand in a stored table rather than a long lineage. ``weight`` names a column that
    says how many equal values a row stands for. No ``hot`` says that no group can be hot. ``tasks`` is for weighted rows whose metrics are cached
    (see ``tasks_for``).
    """
    keys = list(keys)
    rows = rows.select(*keys, value, (F.lit(1) if weight is None else F.col(weight)).cast("long").alias("_weight"))
    ordinary_stats = _ordinary_stats if weight is None else partial(_weighted_stats, tasks=tasks)
    limit = None if hot is None else hot_limit(rows, keys, hot)
    if limit is None:
        return ordinary_stats(rows, keys, value, q, name)

    # With average, wanted rank and cut points; small enough to broadcast. Weights only make the cuts less apt.
    total = F.sum("_weight")
    large = hot_groups(
        rows, keys, hot, limit,
        (F.sum(F.col(value) * F.col("_weight")) / total if weight else F.avg(value)).alias("average"),
        F.percentile_approx(value, _fractions(q), ACCURACY).alias("_cuts"),
        F.ceil(total * F.lit(q)).alias("_rank"), total.alias("_all"))
    selected = (large.select(*keys, "average", F.col("_all").alias("count"))
                .join(_select_rank(rows, keys, value, large), keys)
                .withColumnRenamed("p", name))
    ordinary = ordinary_stats(rows.join(F.broadcast(large.select(*keys)), keys, "left_anti"),
                              keys, value, q, name)
    columns = [*keys, "average", name, "count"]
    return ordinary.select(*columns).unionByName(selected.select(*columns))
