"""Layer tables: Parquet folders, replaced per partition or as a whole."""

from __future__ import annotations

import json
import re
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from degraus.sources.files import path_exists, read_text, write_text

#: Names of data files hold the job that wrote them.
_JOB = re.compile(r"part-\d+-([0-9a-f-]{36})")


def write_table(
    df: DataFrame, path: str, partitions: Sequence[str] = (), full_refresh: bool = False, compact: bool = False,
    measures: Sequence[Column] = (), observation: Observation | None = None,
) -> None:
    """Store a table.

    With partitions, only those present in the data are replaced, unless ``full_refresh`` is
    set. Every task writes its own file per partition value, so no value is gathered in one task;
    ``compact`` adds a shuffle that joins small pieces and splits large ones, for data that comes
    in many small pieces. ``measures`` are aggregates that the write itself takes and leaves in ``observation``; they
    stand right before the files, in tasks whose results count once.
    """
    keep = [c for c in partitions if c in df.columns]
    if compact:
        df = df.hint("rebalance", *keep)
    if observation is not None:
        df = df.observe(observation, *measures)
    if keep and len(keep) == len(partitions):
        mode = "static" if full_refresh else "dynamic"
        df.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy(*keep).parquet(path)
    else:
        df.write.mode("overwrite").parquet(path)


def read_table(
    spark: SparkSession, path: str, filters: Mapping[str, object] | None = None, schema: str | StructType | None = None
) -> DataFrame:
    """Scan a stored table. Filters on partition columns prune folders, others are pushed down."""
    # Partitions written by other runs may have further columns; where one lacks a column it is null. Without a declared
    # schema that takes a look at every footer.
    reader = spark.read.schema(schema) if schema else spark.read.option("mergeSchema", True)
    df = reader.parquet(path)
    for column, value in (filters or {}).items():
        if column in df.columns:
            df = df.where(F.col(column) == F.lit(value))
    return df


def read_if_present(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame | None:
    """The table, or None when nothing is stored there."""
    try:
        return read_table(spark, path, schema=schema)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


class SchemaConflict(PySparkException):
    """A column comes with another type than the stored table has."""


class Layer:
    """A folder of tables. With ``full_refresh`` a write replaces all partitions, so values that vanished go.

    The columns of every table are declared in ``_esquemas/<table>.json`` when it is written, so a read opens no footers
    to find them: a partition that was written without a column reads as null there, whatever wrote it.
    """

    def __init__(self, spark: SparkSession, root: str, name: str, full_refresh: bool = False):
        self.spark, self.name, self.full_refresh = spark, name, full_refresh
        self.folder = f"{root.rstrip('/')}/{name}"
        #: What writes through this object have measured, for tables that one write made; see ``quality.layers``.
        self.measured: dict[str, dict] = {}

    def path(self, table: str) -> str:
        return f"{self.folder}/{table}"

    def schema(self, table: str) -> StructType | None:
        """The declared columns of a table; None for one that was stored by other means."""
        text = read_text(self.spark, f"{self.folder}/_esquemas/{table}.json")
        return StructType.fromJson(json.loads(text)) if text else None

    def declare(self, table: str, schema: StructType, replaced: bool = False) -> StructType:
        """Note the columns of a table that is about to be written: those it has already and new ones behind them, or,
        if all of it is replaced, just the new ones."""
        known = None if replaced else self.schema(table)
        fields = {f.name: f for f in known.fields} if known else {}
        for field in schema.fields:
            old = fields.get(field.name)
            if old is not None and old.dataType != field.dataType:
                raise SchemaConflict(
                    f"{table}.{field.name}: {old.dataType.simpleString()} stored, {field.dataType.simpleString()} written"
                )
            fields[field.name] = StructField(field.name, field.dataType, True)
        merged = StructType(list(fields.values()))
        if merged != known:
            write_text(self.spark, f"{self.folder}/_esquemas/{table}.json", json.dumps(merged.jsonValue()))
        return merged

    def read(self, table: str) -> DataFrame | None:
        path, schema = self.path(table), self.schema(table)
        if schema is None:
            return read_if_present(self.spark, path)
        return read_table(self.spark, path, schema=schema) if path_exists(self.spark, path) else None

    def write(self, df: DataFrame, table: str, partitions: Sequence[str] = (), **options: object) -> None:
        options = {"full_refresh": self.full_refresh, **options}
        whole = bool(options["full_refresh"]) or not partitions or any(c not in df.columns for c in partitions)
        self.measured.pop(table, None)
        self.declare(table, df.schema, replaced=whole)
        write_table(df, self.path(table), partitions, **options)

    def written_at_once(self, table: str) -> bool:
        """Whether all files of a table stem from one write, so what was measured on it holds for the table."""
        df = self.read(table)
        files = df.inputFiles() if df is not None else []
        return len({_JOB.search(f.rsplit("/", 1)[-1]).group(1) if _JOB.search(f) else f for f in files}) == 1
