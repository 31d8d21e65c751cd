"""An index of the stored idempotency keys, so that a micro-batch reads a few files however large the store is.

Every micro-batch leaves a run (see ``runs``): its new keys, each with the place of its reading, in hashed buckets of a bounded number
of keys. Each run also holds a Bloom filter per slot of a bucket, 32,768 bits made by Spark's bitmap functions.

A look-up hashes the keys of a batch into the buckets of every run and reads the filters of those buckets only. Key files are
read only for buckets of which a filter says that one of the keys may be there, so a new key costs no key file but for one false alarm in
about 400. Both lists of buckets are made of paths, so no other folder is listed or opened.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from fieldpulse.operators.dedup import KEY, MAX_BROADCAST_BYTES, dedup_first_wins, few_bytes
from fieldpulse.streaming.runs import Run, Runs

FEW_KEYS = 1_000_000
FEW_SLOTS = 256  # filters that are read together, a megabyte, without asking first which of them are needed
FILTER_BITS = 32_768  # what one bitmap of Spark holds
FILES = 256  # a run has no more files of each kind, until they hold FILE_KEYS keys each
FILE_KEYS = 65_536
PLACE = ("event_date", "batch_id")

_KEYS = f"{KEY} string, event_date date, batch_id long, bucket long"
_FILTERS = "slot long, bits binary, bucket long"


@dataclass(frozen=True)
class IndexShape:
    """``slot_keys`` share a filter, ``bucket_slots`` filters and their keys a file. With 2,048 keys and 4 probes a filter errs once in
    some 400 look-ups. Where files would be small and very many, more filters share one: every file costs the driver a rename and each
    reader a listing."""
    slot_keys: int = 2048
    bucket_slots: int = 32
    probes: int = 4
    fanout: int = 8

    def slots_per_file(self, slots: int) -> int:
        return max(self.bucket_slots, min(-(-slots // FILES), FILE_KEYS // self.slot_keys))


def _slot(slots: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit("slot"), KEY), slots)


def _seed() -> Column:
    return F.xxhash64(F.lit("bits"), KEY)


def _places(shape: IndexShape, seed: Column) -> Column:
    """The bits of a key in its filter: pieces of one more hash."""
    return F.array(*(F.pmod(F.shiftrightunsigned(seed, 15 * probe), F.lit(FILTER_BITS)) for probe in range(shape.probes)))


def _all_set(bits: str, places: str) -> Column:
    """Whether a bitmap has all the given bits."""
    return F.expr(f"forall({places}, p -> (shiftright(cast(conv(hex(substring({bits}, cast(p div 8 as int) + 1, 1)), 16, 10) as int), cast(p % 8 as int)) & 1) = 1)")


@dataclass(frozen=True)
class KeyIndex:
    spark: SparkSession
    root: str
    shape: IndexShape = IndexShape()

    @property
    def runs(self) -> Runs:
        return Runs(self.spark, self.root, self.shape.fanout)

    # -- writing ----------------------------------------------------------------------------------

    def add(self, keys: DataFrame, batch_id: int) -> None:
        """Indexes the rows ``keys(idempotency_key, event_date)`` that a batch stored; a batch that is run again replaces its run."""
        self._write_run(keys.select(KEY, "event_date", F.lit(batch_id).cast("long").alias("batch_id")), 0, batch_id, batch_id)

    def build(self, stored: DataFrame) -> None:
        """Indexes a store filled without an index as one run, which covers all batches up to its last one."""
        last = stored.agg(F.max("batch_id")).first()[0]
        if last is not None:
            self._write_run(stored.select(KEY, *PLACE), 1, -1, last)

    def merge(self, before: int) -> None:
        """Merges levels that are full, of batches before ``before`` only, as the last batch may still be run again."""
        self.runs.delete_covered()
        for level, full in self.runs.full_levels(before):
            keys = self.runs.read(_KEYS, [self.runs.folder(run.name, "keys") for run in full]).select(KEY, *PLACE)
            self._write_run(keys, level + 1, min(run.first_batch for run in full), max(run.last_batch for run in full))

    def _write_run(self, keys: DataFrame, level: int, first: int, last: int) -> None:
        count = keys.count()
        if not count:
            return
        runs, name = self.runs, Runs.name(level, first, last)
        slots = -(-count // self.shape.slot_keys)
        share = self.shape.slots_per_file(slots)
        buckets, empty = -(-slots // share), []
        placed = keys.withColumn("slot", _slot(F.lit(slots))).withColumn("bucket", F.expr(f"slot div {share}"))
        # Dealt before the bits are set: a bitmap has its full size however few keys a task has for it.
        placed = placed.repartition(1) if buckets == 1 else placed.repartition("bucket")
        rows = placed.select(KEY, *PLACE, "bucket").sortWithinPartitions("bucket", KEY)
        rows.write.mode("overwrite").partitionBy("bucket").parquet(runs.folder(name, "keys"))
        bits = placed.select("bucket", "slot", F.explode(_places(self.shape, _seed())).alias("place")).groupBy("bucket", "slot").agg(
            F.bitmap_construct_agg("place").alias("bits"))
        bits.sortWithinPartitions("bucket", "slot").write.mode("overwrite").partitionBy("bucket").parquet(runs.folder(name, "filters"))
        if buckets > 1:
            filled = runs.read(_FILTERS, [runs.folder(name, "filters")]).select("bucket")
            empty = [row.id for row in self.spark.range(buckets).join(filled, F.col("id") == F.col("bucket"), "left_anti").collect()]
        runs.commit(level, first, last, {"keys": count, "slots": slots, "share": share, "empty": empty})

    # -- reading ----------------------------------------------------------------------------------

    def seen(self, keys: DataFrame, batch_id: int | None = None, max_broadcast: int = MAX_BROADCAST_BYTES) -> DataFrame:
        """The ``keys(idempotency_key)`` that earlier batches stored, with event_date and batch_id of their reading."""
        asked = keys.select(KEY).where(F.col(KEY).isNotNull())
        paths = self.key_files(asked, batch_id)
        if not paths:
            return self.spark.createDataFrame([], f"{KEY} string, event_date date, batch_id long")
        probe = asked.distinct()
        # Where the index has few keys, the optimizer may choose the join by itself.
        if sum(run.about["keys"] for run in self.runs.live(batch_id)) > FEW_KEYS and few_bytes(probe, max_broadcast):
            probe = F.broadcast(probe)
        return self.runs.read(_KEYS, paths).select(KEY, *PLACE).join(probe, KEY, "left_semi")

    def key_files(self, probe: DataFrame, batch_id: int | None = None) -> list[str]:
        """Folders of the buckets that may hold one of the keys of ``probe``, which may repeat, as only buckets are told apart. The driver gets bucket numbers, never keys."""
        runs = {run.name: run for run in self.runs.live(batch_id)}
        if not runs:
            return []
        each = F.explode(F.array(*(F.struct(F.lit(run.name).alias("run"), F.lit(run.about["slots"]).cast("long").alias("slots"),
                                           F.lit(self._share(run)).cast("long").alias("share")) for run in runs.values()))).alias("_run")
        asked = (probe.select(KEY, _seed().alias("seed"), each)
                 .select("seed", "_run.run", "_run.share", _slot(F.col("_run.slots")).alias("slot"))
                 .withColumn("bucket", F.expr("slot div share")))
        all_ = [Row(run=run.name, bucket=0) for run in runs.values()] if (  # any key hashes to the only file of such runs
            all(run.about["slots"] <= self._share(run) for run in runs.values()) and sum(run.about["slots"] for run in runs.values()) <= FEW_SLOTS) else None
        near = self._folders(all_ or asked.select("run", "bucket").distinct().collect(), runs, "filters")
        if not near:
            return []
        filters = self.runs.read(_FILTERS, near).select("run", "slot", "bits")
        if sum(run.about["slots"] for run in runs.values()) * FILTER_BITS // 8 <= MAX_BROADCAST_BYTES:
            filters = F.broadcast(filters)  # so that the keys stay where they are
        places = _places(self.shape, F.col("seed"))
        maybe = asked.join(filters, ["run", "slot"]).withColumn("places", places).where(_all_set("bits", "places")).select("run", "bucket").distinct()
        return self._folders(maybe.collect(), runs, "keys")

    def _share(self, run: Run) -> int:
        """Filters per file; runs of an earlier version do not note it."""
        return run.about.get("share", self.shape.bucket_slots)

    def _folders(self, buckets: Sequence[Row], runs: dict[str, Run], part: str) -> list[str]:
        held = sorted((row.run, row.bucket) for row in buckets if row.bucket not in runs[row.run].about["empty"])
        return [f"{self.runs.folder(run, part)}/bucket={bucket}" for run, bucket in held]


def dedup_against_index(batch: DataFrame, index: KeyIndex, batch_id: int | None = None) -> DataFrame:
    """First deliveries of keys that no earlier batch stored."""
    return dedup_first_wins(batch).join(index.seen(batch, batch_id).select(KEY), KEY, "left_anti")
