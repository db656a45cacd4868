"""Lookups, decodes and key differences.

A side is broadcast only when its size is bounded: by its key type (``by_year``) or because it was
measured (``broadcast_if_small``). Otherwise Catalyst chooses, and AQE splits a heavy key of the
sort-merge join over several tasks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


BROADCAST_BYTES = 8 * 1024 * 1024


def broadcast_if_small(df: DataFrame, most: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a table of texts for broadcast if all its cells together stay below ``most`` bytes."""
    cell = sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) + 16 for c in df.columns), F.lit(0))
    size = df.agg(F.sum(cell).alias("bytes")).first()["bytes"] or 0
    return F.broadcast(df) if size <= most else df


def by_year(facts: DataFrame, series: DataFrame, value: str, alias: str, year: str = "ano") -> DataFrame:
    """LEFT join of a one-value-per-year series.

    The year is a SMALLINT and grouped, so the broadcast side has at most 65 536 short rows
    whatever the data volume. Joining on the year without it would put a year in one task.
    """
    small = (
        series.select(F.col(year).try_cast("smallint").alias("__ano"), F.col(value).alias("__valor"))
        .where(F.col("__ano").isNotNull())  # a year that is none has no series
        .groupBy("__ano")
        .agg(F.max("__valor").alias(alias))
    )
    return facts.join(F.broadcast(small), facts[year] == small["__ano"], "left").drop("__ano")


def decode_with_dictionary(
    df: DataFrame,
    dictionary: DataFrame,
    table: str,
    columns: Mapping[str, str] | Sequence[str],
) -> DataFrame:
    """Replace coded columns by the text of a (id_tabela, nome_coluna, chave, valor) dictionary.

    ``columns`` maps coded column -> output column (or lists columns decoded in place). The
    codes are LEFT joined, so an unknown code gives null and no row is lost. Codes have few
    values, each in very many rows; the entries of a column are measured and broadcast.
    """
    names = columns if isinstance(columns, Mapping) else {c: c for c in columns}
    for coded, output in names.items():
        entries = dictionary.where((F.col("id_tabela") == table) & (F.col("nome_coluna") == coded)).select(
            F.col("chave").alias("__chave"), F.col("valor").alias("__valor")
        )
        entries = broadcast_if_small(entries)
        joined = df.join(entries, df[coded].cast("string") == F.col("__chave"), "left")
        df = joined.withColumn(output, F.col("__valor")).drop("__chave", "__valor")
    return df


def with_directory_name(
    df: DataFrame, directory: DataFrame, key: str, directory_key: str, name: str, output: str
) -> DataFrame:
    """LEFT join of the distinct (key, name) pairs of a directory."""
    names = directory.select(F.col(directory_key).alias("__chave"), F.col(name).alias(output)).distinct()
    names = broadcast_if_small(names)
    return df.join(names, df[key] == F.col("__chave"), "left").drop("__chave")


def orphan_keys(df: DataFrame, key: str, reference: DataFrame, reference_key: str) -> DataFrame:
    """Distinct non-null keys without a row in the reference table."""
    keys = df.where(F.col(key).isNotNull()).select(key).distinct()
    known = reference.select(F.col(reference_key).alias(key)).distinct()
    return keys.join(known, key, "left_anti")


def outside_domain(df: DataFrame, column: str, domain: Sequence[str]) -> DataFrame:
    """Distinct upper-cased values that are not in a fixed domain; nulls are ignored."""
    value = F.upper(F.col(column))
    return df.where(~value.isin(list(domain))).select(value.alias(column)).distinct()


def unmapped_codes(df: DataFrame, code: str = "rede", label: str = "rede_label") -> DataFrame:
    """Distinct codes that have no label."""
    return df.where(F.col(label).isNull() & F.col(code).isNotNull()).select(code).distinct()
