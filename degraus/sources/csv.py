"""CSV scan with a per-file choice between UTF-8 and Windows-1252."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from degraus.functions import is_typed, missing_to_null, try_cast_columns

# Column that records where a row stood in the source: (file, block, running number).
ORIGIN = "_origem"


def is_utf8(spark: SparkSession, path: str) -> bool:
    """Strict check of every line, made by the executors."""
    verdict = spark.read.text(path).agg(F.min(F.is_valid_utf8("value")).alias("ok")).first()
    return verdict["ok"] is not False


def _windows_1252_pairs() -> tuple[str, str]:
    """Latin-1 control characters and what Windows-1252 means by the same bytes."""
    source, target = "", ""
    for byte in range(0x80, 0xA0):
        try:
            char = bytes([byte]).decode("cp1252")
        except UnicodeDecodeError:
            continue
        source, target = source + chr(byte), target + char
    return source, target


def read_csv(
    spark: SparkSession,
    path: str,
    types: Mapping[str, str] | None = None,
    years: Sequence[int] | None = None,
    year: str = "ano",
    utf8: bool | None = None,
    multiline: bool = False,
) -> DataFrame:
    """Read a CSV with header. Columns stay text unless ``types`` names a type for them.

    The header decides the column order, so files may carry more columns or another order than
    the table definition. Bytes that are not UTF-8 are read as Latin-1 and the range where
    Windows-1252 differs is translated, which needs no change of session settings. The check reads
    the whole file; ``utf8`` skips it when the encoding is known. ``multiline`` allows quoted line breaks.
    """
    utf8 = is_utf8(spark, path) if utf8 is None else utf8
    raw = (
        spark.read.option("header", True)
        .option("encoding", "UTF-8" if utf8 else "ISO-8859-1")
        .option("escape", '"')
        .option("multiLine", multiline)
        .csv(path)
    )
    if not raw.columns:
        raise ValueError(f"no header in {path}")
    source, target = _windows_1252_pairs()
    texts = []
    for name in raw.columns:
        value = F.col(f"`{name}`")
        label = name
        if not utf8:
            value = F.translate(value, source, target)
            label = name.translate(str.maketrans(source, target))
        # The cast of a typed column turns such texts into null by itself.
        texts.append((value if is_typed(label, types or {}) else missing_to_null(value)).alias(label))
    origin = arrival(F.col("_metadata.file_name"), F.col("_metadata.file_block_start"))
    typed = try_cast_columns(raw.select(*texts, origin), types or {})
    if years and year in typed.columns:
        typed = typed.where(F.col(year).isin(list(years)))
    return typed


def arrival(source: Column, block: Column) -> Column:
    """Where a row stood: source, block of it, running number."""
    return F.struct(
        source.alias("arquivo"), block.cast("bigint").alias("bloco"), F.monotonically_increasing_id().alias("linha")
    ).alias(ORIGIN)


def failed_casts(spark: SparkSession, path: str, types: Mapping[str, str]) -> DataFrame:
    """Per typed column: cells that hold text but do not fit the type."""
    raw = read_csv(spark, path)
    known = [c for c in types if c in raw.columns]
    cast = try_cast_columns(raw.select(*(F.col(c).alias(f"t_{c}") for c in known), *known), {c: types[c] for c in known})
    counts = cast.agg(*(F.count_if(F.col(f"t_{c}").isNotNull() & F.col(c).isNull()).alias(c) for c in known))
    return counts.select(
        F.inline(F.array(*(F.struct(F.lit(c).alias("coluna"), F.col(c).alias("falhas")) for c in known)))
    )
