"""The durable tables of the telemetry job, as parquet below one shared folder.

Rows carry the ``batch_id`` of the micro-batch that wrote them, and a batch is written with dynamic
partition overwrite, so a replayed batch replaces itself. Whole-table rewrites (devices) go to a
new numbered folder; a small file in a log folder then makes that folder the current one. Compaction adds chunks in the same way.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldpulse.functions.files import child_folders, delete_folder, read_notes, write_note
from fieldpulse.functions.times import floor_to
from fieldpulse.operators.windows import DEFAULT_POLICY, WindowPolicy
from fieldpulse.operators.referential import existence
from fieldpulse.operators.registry import DELETED, REGISTERED, change_outcome, changed_devices, merged_devices
from fieldpulse.schemas import DEVICE, DEVICE_CHANGE, READING
from fieldpulse.streaming.key_index import KeyIndex
from fieldpulse.streaming.metric_runs import MetricRuns
from fieldpulse.streaming.window_counts import WindowCounts

_BATCH = T.StructField("batch_id", T.LongType())
_DATE = T.StructField("event_date", T.DateType())
_STORED = T.StructType([*READING.fields, _DATE, _BATCH])
_REJECTED = T.StructType([
    *READING.fields,
    T.StructField("violations", T.ArrayType(T.StructType([
        T.StructField("field", T.StringType()), T.StructField("message", T.StringType())]))),
    T.StructField("outcome", T.StringType()),
    _BATCH,
])
_OUTCOMES = T.StructType([
    T.StructField("outcome", T.StringType()), T.StructField("rows", T.LongType()), _BATCH])
_LATE = T.StructType([
    *[READING[name] for name in ("idempotency_key", "device_id", "metric_type")],
    T.StructField("window_start", T.TimestampNTZType()), T.StructField("window_end", T.TimestampNTZType()),
    T.StructField("late_by", T.DayTimeIntervalType()), _BATCH])
_ANSWERS = T.StructType([
    *[READING[name] for name in ("idempotency_key", "ingested_at", "delivery_seq")],
    *[T.StructField(f"stored_{field.name}", field.dataType) for field in READING.fields if field.name != "idempotency_key"], _BATCH])
_DELTAS = T.StructType([*DEVICE.fields, T.StructField("deleted", T.BooleanType()), T.StructField("base_version", T.LongType()), _BATCH])
_STATES = T.StructType([
    *[DEVICE_CHANGE[name] for name in ("id", "received_at", "seq")], T.StructField("there", T.BooleanType()),
    T.StructField("base_version", T.LongType()), _BATCH])
_CHANGES = T.StructType([*DEVICE_CHANGE.fields, T.StructField("outcome", T.StringType()), _BATCH])

# Tables with a folder per batch, and their columns.
_BY_BATCH = {"readings": _STORED, "rejects": _REJECTED, "outcomes": _OUTCOMES, "late": _LATE, "answers": _ANSWERS, "device_changes": _CHANGES}


@dataclass(frozen=True)
class Store:
    spark: SparkSession
    root: str

    def create(self) -> Store:
        """Makes the empty tables; those already there are left alone."""
        tables = [(name, schema, ("event_date", "batch_id") if name == "readings" else ("batch_id",)) for name, schema in _BY_BATCH.items()]
        by_base = ("base_version", "batch_id")
        for name, schema, partitions in (*tables, ("device_deltas", _DELTAS, by_base), ("device_states", _STATES, by_base)):
            empty = self.spark.createDataFrame([], schema)
            empty.write.mode("ignore").partitionBy(*partitions).parquet(self._path(name))
        return self

    # -- readings ---------------------------------------------------------------------------------

    def readings(self) -> DataFrame:
        return self._table("readings", _STORED)

    def has_readings(self) -> bool:
        """Whether any batch has stored readings, by the folders alone."""
        return bool(self._chunks("readings")["chunks"]) or any(
            folder.startswith("event_date=") for folder in child_folders(self.spark, self._path("readings")))

    def readings_at(self, places: DataFrame) -> DataFrame:
        """Readings of the days and batches named in ``places(event_date, batch_id)``; other folders are not read, and of compacted ones those of
        other days. The driver gets as many names as there are folders to read."""
        held = places.select("event_date", "batch_id").distinct().collect()
        days, batches = {row.event_date for row in held}, {row.batch_id for row in held}
        return self.readings().where(F.col("event_date").isin(*days) & F.col("batch_id").isin(*batches))

    @property
    def key_index(self) -> KeyIndex:
        return KeyIndex(self.spark, self._path("key_index"))

    def window_counts(self, policy: WindowPolicy = DEFAULT_POLICY) -> WindowCounts:
        return WindowCounts(self.spark, self._path("window_counts"), policy)

    def write_readings(self, rows: DataFrame, batch_id: int) -> None:
        """Stores the rows of one batch."""
        dated = rows.select(*READING.names).withColumns(
            {"event_date": F.to_date("recorded_at"), "batch_id": F.lit(batch_id).cast("long")})
        _overwrite(_evened(dated), self._path("readings"), "event_date", "batch_id")

    def compact(self, before: int) -> None:
        """Merges what the batches before ``before`` left in a folder each. It may run while a stream writes, if ``before`` is not past the batch that
        runs: batches add folders of their own, and the last one may be run again.

        Per table the batches since the last time become one chunk, by day for readings, with their ``batch_id`` as a column. A small file names the
        chunks and the last batch in them; readers take the later batches from their folders. The folders that the chunks replace are deleted
        the next time, when no reader that began before can need them, so there are as many as between two calls. Of two calls at the same time one
        gives up.
        """
        for name, schema in _BY_BATCH.items():
            self._compact(name, schema, before)

    def _compact(self, name: str, schema: T.StructType, before: int) -> None:
        held = self._chunks(name)
        self._delete_folders(name, held["through"])
        rows = self._folders(name, schema).where((F.col("batch_id") > held["through"]) & (F.col("batch_id") < before))
        last = rows.agg(F.max("batch_id")).first()[0]
        if last is None:
            return
        chunk = f"{held['through'] + 1}-{last}-{uuid.uuid4().hex[:8]}"
        path = f"{self._path('chunks')}/{name}/chunk={chunk}"
        if name == "readings":
            _overwrite(_evened(rows), path, "event_date", replaced="static")
        else:
            rows.hint("rebalance").write.parquet(path)
        if self._chunks(name) != held:
            delete_folder(self.spark, path)
            return
        log = f"{self._path('chunks_log')}/{name}"
        write_note(self.spark, f"{log}/{last}.json", json.dumps({"through": last, "chunks": [*held["chunks"], chunk]}))
        for old in sorted(int(note) for note in read_notes(self.spark, log, ".json"))[:-2]:
            delete_folder(self.spark, f"{log}/{old}.json")

    def _chunks(self, name: str) -> dict:
        notes = read_notes(self.spark, f"{self._path('chunks_log')}/{name}", ".json")
        return json.loads(notes[max(notes, key=int)]) if notes else {"through": -1, "chunks": []}

    def _delete_folders(self, name: str, through: int) -> None:
        days = [f"{self._path(name)}/{day}" for day in child_folders(self.spark, self._path(name)) if day.startswith("event_date=")]
        for parent in days or [self._path(name)]:
            batches = [folder for folder in child_folders(self.spark, parent) if folder.startswith("batch_id=")]
            gone = [folder for folder in batches if int(folder.removeprefix("batch_id=")) <= through]
            for folder in gone:
                delete_folder(self.spark, f"{parent}/{folder}")
            if days and len(gone) == len(batches):
                delete_folder(self.spark, parent)

    def _folders(self, name: str, schema: T.StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(self._path(name))

    def staged(self, rows: DataFrame, batch_id: int, table: str = "staging") -> DataFrame:
        """Rows of one batch, written to the store's own scratch table and read back; the next but one replaces them."""
        path = f"{self._path(table)}/{batch_id % 2}"
        rows.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    # -- other outputs of a batch -----------------------------------------------------------------

    def rejects(self) -> DataFrame:
        return self._table("rejects", _REJECTED)

    def write_rejects(self, rows: DataFrame, batch_id: int) -> None:
        self._write_batch(rows.select(*READING.names, "violations", "outcome"), "rejects", batch_id)

    def outcomes(self) -> DataFrame:
        return self._table("outcomes", _OUTCOMES)

    def write_outcomes(self, counts: DataFrame, batch_id: int) -> None:
        self._write_batch(counts, "outcomes", batch_id)

    def late(self) -> DataFrame:
        """Stored readings that arrived too late for their window."""
        return self._table("late", _LATE)

    def write_late(self, rows: DataFrame, batch_id: int) -> None:
        self._write_batch(rows.select(*_LATE.names[:-1]), "late", batch_id)

    def answers(self) -> DataFrame:
        """Every duplicate with the stored reading of its key."""
        return self._table("answers", _ANSWERS)

    def write_answers(self, rows: DataFrame, batch_id: int) -> None:
        self._write_batch(rows.select(*_ANSWERS.names[:-1]), "answers", batch_id)

    @property
    def metric_runs(self) -> MetricRuns:
        return MetricRuns(self.spark, self._path("metrics"))

    def write_metrics(self, metrics: DataFrame, batch_id: int) -> None:
        self.metric_runs.add(metrics, batch_id)

    def metrics(self) -> DataFrame:
        """The latest metrics of each window; a later batch that touched a window replaces its row."""
        return self.metric_runs.latest()

    def current_window(self, as_of: datetime, device_id: str | None = None, metric_type: str | None = None,
                       policy: WindowPolicy = DEFAULT_POLICY) -> DataFrame:
        """Stored metrics of the window that holds ``as_of`` (UTC), of one device or metric if given.

        A group without data has no row. Reads the files whose range of windows and devices has the asked ones, one per run.
        """
        return self.metric_runs.at(floor_to(as_of, policy.bin), device_id, metric_type)

    # -- devices ----------------------------------------------------------------------------------

    def devices(self, version: int | None = None) -> DataFrame:
        """A snapshot of the device table: the current one, or a given version."""
        version = self._current("devices_log") if version is None else version
        if version == 0:
            return self.spark.createDataFrame([], DEVICE)
        return self.spark.read.schema(DEVICE).parquet(self._devices_path(version))

    def write_devices(self, snapshot: DataFrame) -> int:
        """Writes the next version and makes it current; readers keep the version they started with."""
        version = self._current("devices_log") + 1
        snapshot.select(*DEVICE.names).write.mode("overwrite").parquet(self._devices_path(version))
        self._log("devices_log", version)
        return version

    def devices_after(self, version: int, batch_id: int) -> DataFrame:
        """A snapshot with the changes that batches up to ``batch_id`` made to it: the latest row of each changed device."""
        deltas = self._table("device_deltas", _DELTAS).where((F.col("base_version") == version) & (F.col("batch_id") <= batch_id))
        fields = [*DEVICE.names, "deleted"]
        latest = deltas.groupBy("id").agg(F.max_by(F.struct(*fields[1:]), "batch_id").alias("_row")).select("id", "_row.*")
        return merged_devices(self.devices(version), latest)

    def apply_changes(self, changes: DataFrame, batch_id: int) -> DataFrame:
        """Applies one batch of mixed device changes and returns, per device id, when it was there (``referential.existence``).

        Writes the rows that changed and not the table; ``fold_devices`` makes a new snapshot of both. The batch's time is that of its last
        change, and devices with readings are those that earlier batches stored, so a batch that is run again gives the same rows.
        """
        version = self.devices_version(batch_id)
        held = self.devices_after(version, batch_id - 1)
        last = changes.agg(F.max("received_at")).first()[0]
        if last is not None:
            readings = self.readings().where(F.col("batch_id") < batch_id)
            judged = self.staged(change_outcome(changes, held, readings), batch_id, "staging_changes")
            self._write_batch(judged, "device_changes", batch_id)
            numbered = changed_devices(judged, held, last).withColumn("base_version", F.lit(version).cast("long"))
            self._write_batch(numbered, "device_deltas", batch_id, "base_version")
            states = judged.where(F.col("outcome").isin(REGISTERED, DELETED)).select(
                "id", "received_at", "seq", (F.col("outcome") == REGISTERED).alias("there"), F.lit(version).cast("long").alias("base_version"))
            self._write_batch(states, "device_states", batch_id, "base_version")
        states = self._table("device_states", _STATES).where((F.col("base_version") == version) & (F.col("batch_id") <= batch_id))
        return existence(self.devices(version), states)

    def device_changes(self) -> DataFrame:
        """All change rows with their outcome."""
        return self._table("device_changes", _CHANGES)

    def fold_devices(self) -> int:
        """Makes the current snapshot and its changes the next snapshot. Run it while no stream applies changes; later readings are judged by it."""
        version = self._current("devices_log")
        return self.write_devices(self.devices_after(version, 1 << 62))

    def version_after(self, committed: int) -> int:
        """The version for batches past the last ``committed`` one: that of a batch left open, else the current one."""
        noted = [int(version) for batch, version in self._notes("batch_log").items() if batch > committed]
        return min(noted, default=self._current("devices_log"))

    def devices_version(self, batch_id: int, version: int | None = None) -> int:
        """The version a batch uses, by default the current one: a replay gets the one of its first run."""
        noted = self._notes("batch_log")
        if batch_id in noted:
            return int(noted[batch_id])
        version = self._current("devices_log") if version is None else version
        write_note(self.spark, f"{self._path('batch_log')}/{batch_id}.json", str(version))
        for old in noted:
            if old < batch_id - 1:  # past being run again
                delete_folder(self.spark, f"{self._path('batch_log')}/{old}.json")
        return version

    # -- paths and logs ---------------------------------------------------------------------------

    def _path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"

    def _devices_path(self, version: int) -> str:
        return self._path(f"devices/v{version}")

    def _table(self, name: str, schema: T.StructType) -> DataFrame:
        held = self._chunks(name)
        rows = self._folders(name, schema)
        if not held["chunks"]:
            return rows
        root = f"{self._path('chunks')}/{name}"
        chunked = T.StructType([*schema.fields, T.StructField("chunk", T.StringType())])
        merged = self.spark.read.schema(chunked).option("basePath", root).parquet(*(f"{root}/chunk={chunk}" for chunk in held["chunks"]))
        return rows.where(F.col("batch_id") > held["through"]).unionByName(merged.select(*schema.names))

    def _write_batch(self, rows: DataFrame, table: str, batch_id: int, *partitions: str) -> None:
        numbered = rows.withColumn("batch_id", F.lit(batch_id).cast("long"))
        _overwrite(numbered, self._path(table), *partitions, "batch_id")

    def _notes(self, log: str) -> dict[int, str]:
        return {int(name): note for name, note in read_notes(self.spark, self._path(log), ".json").items()}

    def _current(self, log: str) -> int:
        return max(self._notes(log), default=0)

    def _log(self, log: str, version: int) -> None:
        """Makes a version the current one."""
        write_note(self.spark, f"{self._path(log)}/{version}.json", "")


def _evened(rows: DataFrame) -> DataFrame:
    """A day with most of the rows is split over tasks; time order lets later reads skip row groups."""
    return rows.hint("rebalance", "event_date").sortWithinPartitions("event_date", "batch_id", "recorded_at")


def _overwrite(rows: DataFrame, path: str, *partitions: str, replaced: str = "dynamic") -> None:
    """Replaces just the partitions that ``rows`` fills, or with ``replaced`` "static" the whole table."""
    (rows.write.mode("overwrite").option("partitionOverwriteMode", replaced)
     .partitionBy(*partitions).parquet(path))
