"""Expressions and metadata-only projections; all of them stay inside code generation."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from degraus.spec import MISSING_TEXTS, NETWORK_LABELS, RISK_BANDS, RISK_DEFAULT


def normalise_name(name: str) -> str:
    """``" Nome Coluna "`` -> ``nome_coluna``; accents are folded to ASCII."""
    folded = unicodedata.normalize("NFKD", name.strip().lower().translate(str.maketrans(" -", "__")))
    return "".join(ch for ch in folded if ord(ch) < 128)


def normalise_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*map(normalise_name, df.columns))


def select_present(df: DataFrame, names: Sequence[str], renames: Mapping[str, str] | None = None) -> DataFrame:
    """Keep the wanted columns that exist, in the wanted order, then rename."""
    kept = df.select([F.col(f"`{c}`") for c in names if c in df.columns])
    return kept.withColumnsRenamed(dict(renames or {}))


def missing_to_null(col: Column) -> Column:
    """Text that stands for a missing value -> null."""
    return F.when(~col.isin(MISSING_TEXTS), col)


def _fits(name: str, pattern: str) -> bool:
    return name == pattern or (pattern.endswith("*") and name.startswith(pattern[:-1]))


def is_typed(name: str, types: Mapping[str, str]) -> bool:
    """Whether a type is stated for the column; ``prefix_*`` names all columns with that beginning."""
    return any(_fits(name, pattern) for pattern in types)


WHOLE_KINDS = ("tinyint", "smallint", "int", "bigint")


def whole_number(col: Column, kind: str) -> Column:
    """Integer of a number or a text; ``"2.0"`` is 2, a text with a fraction becomes null."""
    number = col.try_cast("double")
    return F.coalesce(col.try_cast(kind), F.when(number == F.rint(number), number.try_cast(kind)))


def zero_or_one(col: Column) -> Column:
    """Flag as 0 or 1 from 0/1, 0.0/1.0 or True/False; other texts become null."""
    number = whole_number(col, "int")
    return F.coalesce(F.when(number.isin(0, 1), number), col.try_cast("boolean").cast("int"))


def try_cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast per cell; a cell that does not fit becomes null, an absent column is skipped. The kind ``flag`` is 0 or 1."""
    casts = {}
    for pattern, kind in types.items():
        for name in df.columns:
            if _fits(name, pattern):
                value = F.col(f"`{name}`")
                if kind == "flag":
                    casts[name] = zero_or_one(value)
                elif kind in WHOLE_KINDS:
                    casts[name] = whole_number(value, kind)
                else:
                    # NaN must never stay: Spark orders it above every number.
                    cast = value.try_cast(kind)
                    casts[name] = F.nanvl(cast, F.lit(None)) if kind == "double" else cast
    return df.withColumns(casts)


def code_label(code: Column, labels: Mapping[int, str] | None = None) -> Column:
    """Code -> label, null for an unmapped code."""
    pairs = NETWORK_LABELS if labels is None else labels
    branch = None
    for key, label in pairs.items():
        branch = (F if branch is None else branch).when(code == F.lit(key), F.lit(label))
    return branch


def decimal_comma(col: Column) -> Column:
    """``"0,712"`` -> 0.712; text that is no number becomes null."""
    return F.nanvl(F.replace(col.cast("string"), F.lit(","), F.lit(".")).try_cast("double"), F.lit(None))


def as_boolean(col: Column) -> Column:
    """0/1 as number or text, or a boolean -> nullable boolean; other texts become null."""
    return F.coalesce(col.try_cast("boolean"), zero_or_one(col).cast("boolean"))


def parse_event_time(col: Column) -> Column:
    """ISO text -> timestamp, unreadable text -> null."""
    return F.try_to_timestamp(col)


def out_of_range(col: Column, low: float, high: float) -> Column:
    """True outside [low, high]; a null is not outside."""
    return F.coalesce((col < low) | (col > high), F.lit(False))


def at_least_zero(gap: Column) -> Column:
    """Target reached. A comparison with an unknown result counts as not reached."""
    return F.coalesce(gap >= 0, F.lit(False))


def band(col: Column, bands: Iterable[tuple[float, float, str]] = RISK_BANDS, default: str = RISK_DEFAULT) -> Column:
    """Label of the half-open band [low, high) the value falls in."""
    branch = None
    for low, high, label in bands:
        branch = (F if branch is None else branch).when((col >= low) & (col < high), F.lit(label))
    return branch.otherwise(F.lit(default))


def round_even(col: Column, digits: int) -> Column:
    """Half-to-even on the scaled value, the rule numeric array libraries use."""
    scale = float(10**digits)
    return F.rint(col * scale) / scale


def percentage(part: Column, whole: Column, digits: int = 2) -> Column:
    """100 * part / whole, null when the whole is zero."""
    return round_even(F.try_divide(part.cast("double"), whole.cast("double")) * 100.0, digits)
