"""Top and bottom lists. The input is read once for all lists, and every task passes on the head of a list only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def ranked_lists(
    df: DataFrame, lists: Sequence[tuple[str, str, bool]], key: str, size: int
) -> DataFrame:
    """Rows of several ranked lists, tagged ``lista`` and numbered ``posicao`` from 1.

    ``lists`` holds (name, column, ascending). Rows with a null in the column are left out and
    ties are broken by the key.
    """
    entries = F.array(*(
        F.struct(
            F.lit(name).alias("lista"), (F.col(column) if ascending else -F.col(column)).cast("double").alias("ordem")
        )
        for name, column, ascending in lists
    ))
    window = Window.partitionBy("__lista.lista").orderBy("__lista.ordem", key)
    return (
        df.withColumn("__lista", F.explode(entries)).where(F.col("__lista.ordem").isNotNull())
        .withColumn("posicao", F.row_number().over(window)).where(F.col("posicao") <= size)
        .select(*df.columns, F.col("__lista.lista").alias("lista"), "posicao")
    )


def best_and_worst(df: DataFrame, value: str, key: str, size: int) -> DataFrame:
    return ranked_lists(df, [("melhores", value, False), ("piores", value, True)], key, size)


def largest_changes(df: DataFrame, value: str, key: str, size: int) -> DataFrame:
    return ranked_lists(df, [("mais_melhoraram", value, False), ("mais_pioraram", value, True)], key, size)
