"""Immutable tables of micro-batches, merged level by level.

A run holds what one batch, or several batches in a row, left behind. It counts once its note is in the catalog folder, and no longer once a run
of a higher level covers its batches; one small file is what makes either true. ``fanout`` runs of a level are merged into one of the
next, so the number of runs grows with the logarithm of the number of batches. A batch that is run again replaces its own run, so runs are
merged only when their batches are past that. One job writes at a time; readers need no lock.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from fieldpulse.functions.files import delete_folder, read_notes, write_note

_TIME = "%Y-%m-%d %H:%M:%S.%f"


@dataclass(frozen=True)
class Run:
    """A run, the batches it covers, and ``about``, what its writer noted about it."""
    name: str
    level: int
    first_batch: int
    last_batch: int
    about: dict[str, Any]


def as_note(at: datetime) -> str:
    return at.strftime(_TIME)


def from_note(text: str) -> datetime:
    return datetime.strptime(text, _TIME)


@dataclass(frozen=True)
class Runs:
    spark: SparkSession
    root: str
    fanout: int

    def live(self, without: int | None = None) -> list[Run]:
        """The runs that count, oldest first; without that of a batch, if it is given."""
        held = self._catalog()
        return [run for run in held if (run.level, run.first_batch) != (0, without) and not any(
            other.level > run.level and other.first_batch <= run.first_batch and run.last_batch <= other.last_batch for other in held)]

    def commit(self, level: int, first: int, last: int, about: dict[str, Any]) -> None:
        """Makes a run count whose tables are written."""
        note = json.dumps({"level": level, "first_batch": first, "last_batch": last, "about": about})
        write_note(self.spark, f"{self.root}/catalog/{self.name(level, first, last)}.json", note)

    def full_levels(self, before: int) -> Iterator[tuple[int, list[Run]]]:
        """Levels with ``fanout`` runs of batches before ``before``, lowest first; the caller merges each before it asks for the next."""
        level = 0
        while True:
            held = self.live()
            full = [run for run in held if run.level == level and run.last_batch < before]
            if len(full) >= self.fanout:
                yield level, full
            elif not any(run.level > level for run in held):
                return
            level += 1

    def delete_covered(self) -> None:
        """Deletes runs that no longer count. Call it before merging: what was merged a batch ago has no reader left."""
        live = {run.name for run in self.live()}
        for run in self._catalog():
            if run.name not in live:
                delete_folder(self.spark, f"{self.root}/catalog/{run.name}.json")
                delete_folder(self.spark, f"{self.root}/runs/run={run.name}")

    @staticmethod
    def name(level: int, first: int, last: int) -> str:
        return f"l{level}-{first}-{last}"

    def folder(self, run: str, part: str) -> str:
        return f"{self.root}/runs/run={run}/part={part}"

    def read(self, schema: str, paths: list[str]) -> DataFrame:
        """Tables of runs; ``run`` and ``part`` come from the path. Only the given folders are listed."""
        return self.spark.read.schema(f"{schema}, run string, part string").option("basePath", f"{self.root}/runs").parquet(*paths)

    def _catalog(self) -> list[Run]:
        notes = read_notes(self.spark, f"{self.root}/catalog", ".json")
        return sorted((Run(name, **json.loads(note)) for name, note in notes.items()), key=lambda run: (run.first_batch, run.level))
