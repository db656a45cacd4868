"""Pick one row per key.

``row_number() = 1`` lets Spark keep one row per key in every map task before the shuffle
(WindowGroupLimit), so a key that holds a large share of all rows costs one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from degraus.session import stored
from degraus.spec import NETWORK_PRIORITY

_RANK = "__posicao"


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key; null keys form a key of their own."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RANK, F.row_number().over(window)).where(F.col(_RANK) == 1).drop(_RANK)


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row that came last per key. ``order`` names the columns that record arrival order."""
    return first_per_key(df, keys, [F.col(c).desc_nulls_last() for c in order])


_HASH = "__hash"


def repeated_hashes(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key hashes that occur more than once, stored. A key whose hash is not among them is certainly unique.

    Only hashes are shuffled. The stored table carries its size, so Catalyst broadcasts it where it is small.
    """
    counted = df.select(F.xxhash64(*keys).alias(_HASH)).groupBy(_HASH).agg(F.count("*").alias("__n"))
    return stored(counted.where(F.col("__n") > 1).select(_HASH), "chaves-repetidas")


def keep_last_of_few(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``keep_last`` for a large table in which repeated keys are expected to be rare.

    Rows whose key hash is unique pass through unranked; the rest is ranked by its exact keys, so a hash collision
    changes nothing.
    """
    repeated = repeated_hashes(df, keys)
    hashed = df.withColumn(_HASH, F.xxhash64(*keys))
    single = hashed.join(repeated, _HASH, "left_anti").drop(_HASH)
    several = hashed.join(repeated, _HASH, "left_semi").drop(_HASH)
    return single.unionByName(keep_last(several, keys, order))


def count_removed_of_few(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``count_removed`` for a large table in which repeated keys are expected to be rare."""
    hashed = df.select(*(F.col(f"`{k}`") for k in keys), F.xxhash64(*keys).alias(_HASH))
    return count_removed(hashed.join(repeated_hashes(df, [f"`{k}`" for k in keys]), _HASH, "left_semi"), keys)


def latest_vintage(
    df: DataFrame, keys: Sequence[str], vintage: str = "ano_referencia", order: Sequence[str] = ()
) -> DataFrame:
    """The most recent publication per key."""
    return keep_last(df, keys, [vintage, *order])


def network_rank(priority: Sequence[str] = tuple(NETWORK_PRIORITY)) -> Column:
    """Position of ``rede_label`` in the priority list; unknown labels come last."""
    place = F.array_position(F.array(*map(F.lit, priority)), F.col("rede_label")).cast("int")
    return F.when(place > 0, place).otherwise(F.lit(len(priority) + 1))


def pick_network(
    df: DataFrame,
    keys: Sequence[str] = ("ano", "id_municipio"),
    priority: Sequence[str] = tuple(NETWORK_PRIORITY),
    ties: Sequence[str] = ("serie", "rede"),
) -> DataFrame:
    """One headline row per key: the best network available."""
    order = [network_rank(priority), *(F.col(c) for c in ties if c in df.columns)]
    return first_per_key(df, keys, [c.asc() for c in order])


def pick_network_with_scope(
    df: DataFrame, scope: str, value: str, alias: str, keys: Sequence[str] = ("id_municipio", "ano"),
    ties: Sequence[str] = ("serie", "rede"),
) -> DataFrame:
    """The headline row, and next to it the value of one network and whether that network exists.

    Both come from one aggregation, so the results are read and shuffled once. Rows are reduced to
    one per key in the map tasks.
    """
    present = [F.col(c) for c in ties if c in df.columns]
    in_scope = F.coalesce(F.col("rede_label") == scope, F.lit(False))
    picked = df.groupBy(*keys).agg(
        F.min_by(F.struct(*(c for c in df.columns if c not in keys)), F.struct(network_rank(), *present)).alias("__melhor"),
        F.min_by(value, F.when(in_scope, F.struct(F.lit(0), *present))).alias(alias),
        F.bool_or(in_scope).alias("__no_escopo"),
    )
    return picked.select(*keys, "__melhor.*", alias, "__no_escopo")


def count_removed(before: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: how many rows a de-duplication on ``keys`` removes."""
    return (
        before.groupBy(*(F.col(f"`{k}`") for k in keys))
        .agg(F.count("*").alias("n"))
        .agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("removidos"))
    )
