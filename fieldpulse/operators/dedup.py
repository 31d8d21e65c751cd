"""First delivery wins, by one global client-supplied key, for all time.

``delivery_seq`` breaks ties between equal arrival times. Captures are at-least-once and transports number on their
own, so it may repeat: the content of a row then decides, and of identical rows one wins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldpulse.operators.skew import BATCH_ROWS, HotGroups, look, spread_join, tasks_for

KEY = "idempotency_key"
ARRIVAL = ("ingested_at", "delivery_seq")

# Text of the distinct keys of one batch that may be broadcast.
MAX_BROADCAST_BYTES = 64 << 20

# Columns that operators add to a delivery; they are not part of what was delivered.
_ADDED = {"violations", "device_known", "storable", "decode_error"}


def content(rows: DataFrame) -> Column:
    """A number that tells apart rows with the same arrival and delivery number."""
    return F.xxhash64(*[name for name in sorted(rows.columns) if name not in _ADDED])


def dedup_first_wins(deliveries: DataFrame, key: str = KEY,
                     order: Sequence[str] = ARRIVAL) -> DataFrame:
    """The first delivery of each key, whole.

    ``min_by`` combines before the shuffle: a task sends one row per key, however many copies it read.
    """
    rest = [name for name in deliveries.columns if name != key]
    first = F.min_by(F.struct(*rest), F.struct(*order, content(deliveries).alias("_content")))
    return (deliveries.groupBy(key).agg(first.alias("_first"))
            .select(key, "_first.*").select(*deliveries.columns))


def without_message(deliveries: DataFrame) -> DataFrame:
    """Deliveries without the text they were decoded from. Its part in telling rows apart stays, as ``_content``."""
    return deliveries.withColumn("_content", content(deliveries)).drop("topic", "payload")


def mark_first(deliveries: DataFrame, key: str = KEY, order: Sequence[str] = ARRIVAL,
               eligible: Column | None = None, seen: DataFrame | None = None,
               name: str = "is_first", hot: HotGroups | None = None) -> DataFrame:
    """All deliveries, with a flag on the first eligible one of each key.

    Keys in ``seen`` have no first delivery here. Identical rows are counted together first, with map-side
    combine, and of those that win one is flagged. The join is on key, arrival *and* content, which only the
    winner matches, so the copies of a hot key spread over all partitions.

    With ``hot`` a look at the rows, which should be stored or cached, comes first: if no key is hot, the rows are dealt by key and
    sorted once, which gives the same flags.
    """
    rows = deliveries if "_content" in deliveries.columns else deliveries.withColumn("_content", content(deliveries))
    order = [*order, "_content"]
    if hot is not None:
        can = F.lit(True) if eligible is None else F.coalesce(eligible, F.lit(False))
        # A number first, as rows are sorted by it faster than by text.
        dealt = rows.withColumn("_can", can).withColumns({
            "_spread": F.when(F.col("_can"), F.xxhash64(key)).otherwise(F.col("_content")), "_of": F.when(F.col("_can"), F.col(key))})
        limit, total = look(dealt, ("_spread", "_of"), hot)
        if limit is None:
            return _first_in_order(dealt, key, order, seen, name, tasks_for(rows.sparkSession, total, BATCH_ROWS)).select(*deliveries.columns, name)
    candidates = rows if eligible is None else rows.where(eligible)
    winners = candidates.groupBy(key).agg(F.min(F.struct(*order)).alias("_first"))
    if seen is not None:
        winners = winners.join(seen.select(key), key, "left_anti")
    winners = winners.select(key, "_first.*", F.lit(True).alias("_wins"))
    rest = [column for column in deliveries.columns if column not in (key, *order)]
    # Grouped by what the join is on, so the join needs no further shuffle of the rows.
    counted = rows.groupBy(key, *order).agg(F.first(F.struct(F.lit(0), *rest)).alias("_row"), F.count(F.lit(1)).alias("_copies"))
    joined = counted.join(winners, [key, *order], "left").withColumn("_copy", F.explode(F.sequence(F.lit(1), "_copies")))
    return joined.select(key, *order, *[F.col(f"_row.{column}") for column in rest], "_wins", "_copy").select(
        *deliveries.columns, F.coalesce(F.col("_wins") & (F.col("_copy") == 1), F.lit(False)).alias(name))


def _first_in_order(dealt: DataFrame, key: str, order: Sequence[str], seen: DataFrame | None, name: str, tasks: int) -> DataFrame:
    """Flags the first row of each ``_of`` by one sort in ``tasks`` tasks; a seen key has a row of its own before all others. Rows that are not eligible are dealt
    by content. A key or a first place that is not known has no first row."""
    rows = dealt.withColumn("_seen", F.lit(False))
    if seen is not None:
        stored = seen.select(key, F.lit(True).alias("_can"), F.xxhash64(key).alias("_spread"), F.col(key).alias("_of"), F.lit(True).alias("_seen"))
        rows = rows.unionByName(stored, allowMissingColumns=True)
    rows = rows.repartition(tasks, "_spread", "_of")
    place = F.row_number().over(Window.partitionBy("_spread", "_of").orderBy(F.col("_seen").desc(), *order))
    known = F.lit(True)
    for column in (key, *order):
        known = known & F.col(column).isNotNull()
    return rows.withColumn("_nth", place).where(~F.col("_seen")).withColumn(name, F.col("_can") & (F.col("_nth") == 1) & known)


def few_bytes(rows: DataFrame, most: int) -> bool:
    """Whether the text of all columns takes at most ``most`` bytes, and 8 per row; one aggregate, one number per task."""
    sizes = [F.coalesce(F.octet_length(F.col(name).cast("string")), F.lit(0)).cast("long") for name in rows.columns]
    return (rows.agg(F.sum(sum(sizes, F.lit(8).cast("long")))).first()[0] or 0) <= most


def seen_keys(batch: DataFrame, stored: DataFrame, key: str = KEY,
              max_broadcast: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Keys of the batch that the store already holds.

    The store is read on its key column only. While the keys of the batch take at most ``max_broadcast`` bytes they
    are broadcast, so the store is not shuffled; beyond that the join shuffles both sides.
    """
    keys = batch.select(key).where(F.col(key).isNotNull()).distinct()
    if few_bytes(keys, max_broadcast):
        keys = F.broadcast(keys)
    return stored.select(key).join(keys, key, "left_semi")


def dedup_against_store(batch: DataFrame, stored: DataFrame, key: str = KEY,
                        order: Sequence[str] = ARRIVAL) -> DataFrame:
    """First deliveries of keys that were never stored."""
    fresh = dedup_first_wins(batch, key, order)
    return fresh.join(seen_keys(batch, stored, key), key, "left_anti")


def resolve_duplicates(deliveries: DataFrame, stored: DataFrame, key: str = KEY,
                       order: Sequence[str] = ARRIVAL, hot: HotGroups = HotGroups()) -> DataFrame:
    """Each delivery that is not the stored row of its key, answered with that stored row.

    Of deliveries identical to the stored row, one is that row and the others are answered.
    """
    answer = stored.select(key, *[F.col(c).alias(f"stored_{c}") for c in stored.columns if c != key])
    shared = [name for name in stored.columns if name in deliveries.columns and name != key]
    same = F.lit(True)
    for name in shared:
        same = same & F.col(name).eqNullSafe(F.col(f"stored_{name}"))
    rows = spread_join(deliveries.select(key, *shared), answer, [key], order[-1], "inner", hot).withColumn("_same", same)
    out = [key, *order, *[name for name in answer.columns if name != key]]
    copies = rows.where("_same").groupBy(*out).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    again = copies.withColumn("_copy", F.explode(F.sequence(F.lit(2), "_n"))).select(*out)
    return rows.where(~F.col("_same")).select(*out).unionByName(again)


def answer_duplicates(duplicates: DataFrame, stored: DataFrame, key: str = KEY,
                      order: Sequence[str] = ARRIVAL, hot: HotGroups = HotGroups()) -> DataFrame:
    """Deliveries known to be duplicates, each with the stored row of its key. ``stored`` has one row per key."""
    answer = stored.select(key, *[F.col(c).alias(f"stored_{c}") for c in stored.columns if c != key])
    return spread_join(duplicates.select(key, *order), answer, [key], order[-1], "inner", hot)


def duplicate_count(deliveries: DataFrame, key: str = KEY) -> DataFrame:
    """Rejected copies: deliveries less distinct keys."""
    per_key = deliveries.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_count"))
