"""Scratch tables that cut lineage, and sorted groups streamed through Python."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from fieldpulse.functions.files import delete_folder
from fieldpulse.operators.skew import tasks_for
from fieldpulse.session import scratch_dir


#: Bytes of the rows that a Python worker gets at once; else 10,000 rows of any length.
BATCH_BYTES = 16 << 20
#: A row with a text or a set of shingles counts as so many short rows.
LONG_ROW = 8


def ship(spark: SparkSession) -> None:
    """Lets the Python workers import this package: Spark hands it to every executor, once per context. Bounds the bytes of their batches."""
    bound = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark.conf.get(bound).rstrip("b")) > BATCH_BYTES:
        spark.conf.set(bound, str(BATCH_BYTES))
    context = spark.sparkContext
    if getattr(context, "_fieldpulse_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="fieldpulse-")) / "fieldpulse.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for module in sorted(package.rglob("*.py")):
            out.write(module, module.relative_to(package.parent))
    context.addPyFile(str(archive))
    context._fieldpulse_shipped = True


_scratch: list[list[str]] = []


def scratch(spark: SparkSession, purpose: str) -> str:
    """A new folder below the shared checkpoint folder."""
    path = scratch_dir(spark, purpose)
    for folders in _scratch:
        folders.append(path)
    return path


def stored(frame: DataFrame, purpose: str, rows: int | None = None) -> DataFrame:
    """Writes a frame below the shared checkpoint folder and reads it again.

    If it is known to have at most ``rows`` rows, and those are short, it is written by as many tasks as they need, and not by one per shuffle partition.
    """
    path = scratch(frame.sparkSession, purpose)
    (frame if rows is None else frame.coalesce(tasks_for(frame.sparkSession, rows))).write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """Deletes the scratch folders made inside at the end; what is to last must be written elsewhere by then."""
    _scratch.append([])
    try:
        yield
    finally:
        for path in _scratch.pop():
            delete_folder(spark, path)


def given(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Regroups batches of a partition sorted by ``key`` so that no group lies in two tables."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        rest.append(batch)
        last = batch.column(key)[-1].as_py()
        if rest[0].column(key)[0].as_py() == last:
            continue
        table = pa.Table.from_batches(rest)
        keys = table.column(key).to_numpy()
        cut = int((keys != last).nonzero()[0][-1]) + 1
        yield table.slice(0, cut)
        rest = table.slice(cut).combine_chunks().to_batches()
    if rest:
        yield pa.Table.from_batches(rest)
