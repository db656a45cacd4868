"""Wide to long and back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from degraus.operators.selection import latest_vintage
from degraus.spec import TARGET_PREFIX


def unpivot_targets(df: DataFrame, prefix: str = TARGET_PREFIX) -> DataFrame:
    """One row per (vintage row, target year) with a value; ``ano`` becomes ``ano_referencia``."""
    wide = [c for c in df.columns if c.startswith(prefix)]
    ids = [c for c in df.columns if c not in wide]
    return (
        df.unpivot(ids, wide, "__coluna", "valor_meta")
        .where(F.col("valor_meta").isNotNull())
        .withColumn("ano_meta", F.substring(F.col("__coluna"), len(prefix) + 1, 10).cast("int"))
        .drop("__coluna")
        .withColumnRenamed("ano", "ano_referencia")
    )


def targets_in_force(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """Unpivot, then the latest vintage per (keys, network, target year)."""
    long = unpivot_targets(df)
    scope = ["rede"] if "rede" in long.columns else []
    return latest_vintage(long, [*keys, *scope, "ano_meta"], "ano_referencia", order)


def pivot_years(df: DataFrame, key: str, value: str, years: Sequence[int], year: str = "ano") -> DataFrame:
    """Entity x year, mean of the value, one column per listed year."""
    return df.groupBy(key).agg(
        *(F.avg(F.when(F.col(year) == y, F.col(value))).alias(f"{value}_{y}") for y in years)
    )


def first_and_last_year(df: DataFrame, key: str, values: Sequence[str], year: str = "ano") -> DataFrame:
    """Mean of each value in the first and in the last year of the data, per entity.

    Every non-null year counts for the bounds, as in a pivot over the whole table.
    Result: key, then ``<value>_inicial`` and ``<value>_atual``.
    """
    bounds = df.agg(F.min(year).alias("primeiro"), F.max(year).alias("ultimo"))
    first = bounds.select("primeiro").scalar()
    last = bounds.select("ultimo").scalar()
    rows = df.withColumns({"__inicial": F.col(year) == first, "__atual": F.col(year) == last})
    return (
        rows.where(F.col("__inicial") | F.col("__atual"))
        .groupBy(key)
        .agg(*(F.avg(F.when(F.col(f"__{end}"), F.col(v))).alias(f"{v}_{end}") for v in values for end in ("inicial", "atual")))
    )


def union_levels(levels: Sequence[tuple[str, DataFrame]], column: str = "nivel") -> DataFrame:
    """UNION ALL by name with a literal level tag."""
    tagged = [df.withColumn(column, F.lit(name)) for name, df in levels]
    result = tagged[0]
    for other in tagged[1:]:
        result = result.unionByName(other)
    return result
