"""The stored history of an event table: compacted days, loose batches, and what of it a reader has seen.

A stream writes one folder per day, stream and batch (``data=/fluxo=/lote=``). ``EventHistory.compact`` rewrites closed
days as a whole into ``<table>_dias/<version>`` and commits that by one numbered manifest, which names the folder of each
compacted day and the batches in it. From then on those batches are read from there, whether or not their own folders
still exist, so a crash between the commit and the removal changes nothing, and a batch that is replayed later does not
count twice. A new batch with late events of a compacted day lies loose beside it until the next compaction.

``days`` tells the state of every day. A reader that keeps the states it has seen knows which days changed: that is how
Silver merges a new batch without ranking the whole history again.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from degraus.sources.files import delete, names_in, partition_folders, path_exists, read_text, write_new
from degraus.sources.snapshots import PublicationConflict
from degraus.sources.tables import Layer

Ranges = list[list[int]]

#: Folder of events whose time cannot be read.
NO_DAY = "data=__HIVE_DEFAULT_PARTITION__"


def with_numbers(ranges: Ranges, numbers: Iterable[int]) -> Ranges:
    """Batch numbers as ranges [first, last], with further ones."""
    found: Ranges = []
    for low, high in sorted([*map(list, ranges), *([n, n] for n in numbers)]):
        if found and low <= found[-1][1] + 1:
            found[-1][1] = max(found[-1][1], high)
        else:
            found.append([low, high])
    return found


def holds(ranges: Ranges, number: int) -> bool:
    return any(low <= number <= high for low, high in ranges)


class EventHistory:
    """An event table of the Bronze layer."""

    def __init__(self, spark: SparkSession, bronze: str, table: str):
        self.spark, self.table = spark, table
        root, _, name = bronze.rstrip("/").rpartition("/")
        self.layer = Layer(spark, root, name)
        self.folder = self.layer.path(table)
        self.compacted = f"{self.folder}_dias"

    # --- State -----------------------------------------------------------------------------

    def _numbers(self) -> list[int]:
        return sorted(int(n.split(".")[0]) for n, is_folder in names_in(self.spark, self._manifest_folder) if not is_folder)

    @property
    def _manifest_folder(self) -> str:
        return f"{self.compacted}/_manifesto"

    def _manifest(self) -> tuple[int, dict[str, dict]]:
        """Number and days of the newest manifest: day -> folder and batches per stream."""
        numbers = self._numbers()
        if not numbers:
            return 0, {}
        return numbers[-1], json.loads(read_text(self.spark, f"{self._manifest_folder}/{numbers[-1]:08d}.json"))

    def _batches(self, compacted: Mapping[str, dict]) -> tuple[dict[str, dict[str, dict[int, str]]], list[str]]:
        """Loose batches: day -> stream -> number -> folder; and the folders of batches that a compacted day holds."""
        loose, absorbed = {}, []
        for folder in partition_folders(self.spark, self.folder, 3):
            day, stream, batch = folder.split("/")
            number = int(batch.split("=", 1)[1])
            if holds(compacted.get(day, {}).get("lotes", {}).get(stream, []), number):
                absorbed.append(folder)
            else:
                loose.setdefault(day, {}).setdefault(stream, {})[number] = folder
        return loose, absorbed

    def days(self) -> dict[str, dict]:
        """State of every day: the batches it consists of, and the files of those that lie loose."""
        _, compacted = self._manifest()
        loose, _ = self._batches(compacted)
        found = {}
        for day in sorted({*compacted, *loose}):
            streams = {s: list(r) for s, r in compacted.get(day, {}).get("lotes", {}).items()}
            files = {}
            for stream, batches in loose.get(day, {}).items():
                streams[stream] = with_numbers(streams.get(stream, []), batches)
                for folder in batches.values():
                    files[folder] = [n for n, is_folder in names_in(self.spark, f"{self.folder}/{folder}") if not is_folder]
            found[day] = {"lotes": streams, "soltos": files}
        return found

    @staticmethod
    def changed(now: Mapping[str, dict], seen: Mapping[str, dict]) -> list[str]:
        """Days with a batch that was not seen, or with a loose one that was written anew since. A day that was only
        compacted has not changed."""
        found = []
        for day, state in now.items():
            before = seen.get(day)
            if before is None or before["lotes"] != state["lotes"] or any(
                files != before["soltos"].get(folder, files) for folder, files in state["soltos"].items()
            ):
                found.append(day)
        return found

    # --- Reading ----------------------------------------------------------------------------

    def read(self, days: Iterable[str] | None = None) -> DataFrame | None:
        """Events of all days or of some (``data=...``), each once; None when nothing is stored."""
        _, compacted = self._manifest()
        loose, _ = self._batches(compacted)
        wanted = {*compacted, *loose} if days is None else set(days)
        schema = self.layer.schema(self.table)
        reader = self.spark.read.schema(schema) if schema else self.spark.read.option("mergeSchema", True)
        scans = []
        folders = [f for day in loose if day in wanted for batches in loose[day].values() for f in batches.values()]
        if folders:
            scans.append(
                reader.option("basePath", self.folder).parquet(*(f"{self.folder}/{f}" for f in sorted(folders)))
            )
        versions: dict[str, list[str]] = {}
        for day, entry in compacted.items():
            if day in wanted:
                versions.setdefault(entry["pasta"], []).append(day)
        for version, inside in sorted(versions.items()):
            base = f"{self.compacted}/{version}"
            scans.append(reader.option("basePath", base).parquet(*(f"{base}/{day}" for day in sorted(inside))))
        if not scans:
            return None
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans)

    # --- Compaction --------------------------------------------------------------------------

    def compact(self, before: str, least: int = 2) -> list[str]:
        """Rewrite the days before ``before`` (an ISO date), and the events without a day, that have ``least`` loose
        batches or more, or late ones beside a compacted day. Returns the days. Meant for a time when no one reads the
        folders that it removes afterwards."""
        number, compacted = self._manifest()
        loose, absorbed = self._batches(compacted)
        chosen = [
            day for day, streams in loose.items()
            if (day == NO_DAY or day < f"data={before}")
            and (day in compacted or sum(map(len, streams.values())) >= least)
        ]
        gone = [f"{self.folder}/{f}" for f in absorbed]
        if chosen:
            version = f"v-{uuid.uuid4().hex}"
            (
                self.read(chosen).hint("rebalance", "data")
                .write.partitionBy("data").parquet(f"{self.compacted}/{version}")
            )
            days = dict(compacted)
            for day in chosen:
                streams = {s: list(r) for s, r in compacted.get(day, {}).get("lotes", {}).items()}
                for stream, batches in loose[day].items():
                    streams[stream] = with_numbers(streams.get(stream, []), batches)
                    gone += [f"{self.folder}/{f}" for f in batches.values()]
                if day in compacted:
                    gone.append(f"{self.compacted}/{compacted[day]['pasta']}/{day}")
                days[day] = {"pasta": version, "lotes": streams}
            if not write_new(self.spark, f"{self._manifest_folder}/{number + 1:08d}.json", json.dumps(days)):
                raise PublicationConflict(f"another compaction of {self.table} came first")
        self._remove(gone)
        return sorted(chosen)

    def _remove(self, folders: Iterable[str]) -> None:
        """Delete folders, and the stream and day folders that are empty without them."""
        for folder in folders:
            delete(self.spark, folder)
            while (folder := folder.rpartition("/")[0]) not in (self.folder, self.compacted) and "=" in folder.rpartition("/")[2]:
                if names_in(self.spark, folder):
                    break
                delete(self.spark, folder)


def read_history(spark: SparkSession, bronze: str, table: str) -> DataFrame | None:
    """All events of a table, each once."""
    history = EventHistory(spark, bronze, table)
    return history.read() if path_exists(spark, history.folder) or path_exists(spark, history.compacted) else None
