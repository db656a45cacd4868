"""A layer that is published as a whole: readers see the tables of one manifest, never half of a publication.

Candidates are written to folders of their own and stay there. A manifest is a small file that names, for every table, the
folder of each partition and the columns; it is numbered, and the highest number is what readers see. Publishing writes
the next number, which succeeds for one publisher only. A partition that a candidate lacks is taken over from the manifest
before, so a run limited to some years keeps the others, and nothing is written twice. Older manifests can be published
again; folders that no kept manifest names are deleted by ``expire``.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from degraus.sources.files import delete, names_in, partition_folders, path_exists, read_text, write_new
from degraus.sources.tables import Layer, read_if_present


class PublicationConflict(Exception):
    """Another publication came first; the candidate has to be checked and published again."""


class PublishedLayer(Layer):
    """Tables of the newest manifest. Versions are folders ``<root>/<name>_versoes/<version>/<table>``."""

    def __init__(self, spark: SparkSession, root: str, name: str, full_refresh: bool = False):
        super().__init__(spark, root, name, full_refresh)
        self.root = root.rstrip("/")
        self.versions = f"{self.root}/{name}_versoes"
        self.manifests = f"{self.folder}/_manifesto"

    def candidate(self, version: str) -> Layer:
        """The layer to write a new version to. Nobody reads it before it is published."""
        return Layer(self.spark, self.versions, version)

    def numbers(self) -> list[int]:
        """Numbers of the manifests, in order."""
        return sorted(int(n.split(".")[0]) for n, folder in names_in(self.spark, self.manifests) if not folder)

    def manifest(self, number: int | None = None) -> dict | None:
        """A manifest by number, or the newest; None before the first publication."""
        numbers = self.numbers() if number is None else [number]
        text = read_text(self.spark, self._file(numbers[-1])) if numbers else None
        return json.loads(text) if text else None

    def _file(self, number: int) -> str:
        return f"{self.manifests}/{number:08d}.json"

    def read(self, table: str) -> DataFrame | None:
        return self.read_of(self.manifest(), table)

    def read_of(self, manifest: Mapping | None, table: str) -> DataFrame | None:
        """A table as a manifest has it: one scan per version that still holds a partition."""
        entry = manifest["tabelas"].get(table) if manifest else None
        if not entry:
            return None
        by_folder: dict[str, list[str]] = {}
        for partition, folder in entry["particoes"].items():
            by_folder.setdefault(folder, []).append(partition)
        schema = StructType.fromJson(entry["esquema"])
        scans = []
        for folder, partitions in sorted(by_folder.items()):
            base = f"{self.root}/{folder}"
            paths = [f"{base}/{p}" if p else base for p in sorted(partitions)]
            scans.append(self.spark.read.schema(schema).option("basePath", base).parquet(*paths))
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans)

    def publish(self, candidate: Layer, tables: Mapping[str, Sequence[str]], version: str) -> int:
        """Make a candidate's tables visible, all at once; ``tables`` has the partition columns of each."""
        numbers = self.numbers()
        before = self.manifest(numbers[-1]) if numbers else None
        found = dict(before["tabelas"]) if before else {}
        relative = candidate.folder.removeprefix(f"{self.root}/")
        for table, columns in tables.items():
            if not path_exists(self.spark, candidate.path(table)):
                continue
            parts = partition_folders(self.spark, candidate.path(table), len(columns)) if columns else []
            # Without partition folders a table is one whole, and so it is when a write left none behind.
            new = {part: f"{relative}/{table}" for part in parts or [""]}
            declared = candidate.schema(table)
            if declared is None:
                stored = read_if_present(self.spark, candidate.path(table))
                if stored is None:
                    continue
                declared = stored.schema
            old = found.get(table, {"particoes": {}, "esquema": {"type": "struct", "fields": []}})
            whole = self.full_refresh or "" in new or "" in old["particoes"]
            fields = {f["name"]: f for f in declared.jsonValue()["fields"]}
            if not whole:
                fields = {f["name"]: f for f in old["esquema"]["fields"]} | fields
            found[table] = {
                "particoes": new if whole else {**old["particoes"], **new},
                "esquema": {"type": "struct", "fields": list(fields.values())},
            }
        return self._publish_next(numbers, {"versao": version, "tabelas": found})

    def restore(self, number: int) -> int:
        """Publish the tables of an older manifest again."""
        manifest = self.manifest(number)
        if manifest is None:
            raise FileNotFoundError(self._file(number))
        return self._publish_next(self.numbers(), {**manifest, "restaura": number})

    def _publish_next(self, numbers: Sequence[int], manifest: Mapping) -> int:
        number = numbers[-1] + 1 if numbers else 1
        if not write_new(self.spark, self._file(number), json.dumps(manifest)):
            raise PublicationConflict(f"manifest {number} was published by someone else")
        return number

    def expire(self, keep: int = 2, under_way: Sequence[str] = ()) -> list[str]:
        """Delete all but the newest manifests, and the versions that none of those names. Versions that are being
        written or read for publication are named in ``under_way``. Returns the versions deleted."""
        numbers = self.numbers()
        kept = [self.manifest(n) for n in numbers[-keep:]] if keep else []
        named = {
            folder.split("/")[1]
            for m in kept for entry in m["tabelas"].values() for folder in entry["particoes"].values()
            if folder.startswith(f"{self.name}_versoes/")
        }
        for number in numbers[:-keep] if keep else numbers:
            delete(self.spark, self._file(number))
        gone = [
            v for v, folder in names_in(self.spark, self.versions) if folder and v not in named and v not in under_way
        ]
        for version in gone:
            delete(self.spark, f"{self.versions}/{version}")
        return gone
