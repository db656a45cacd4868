"""Silver: one cleaning function per table and the integration.

Each function takes a Bronze DataFrame and returns a lazy DataFrame. ``order`` names the columns
that tell which of two rows with the same key came later.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from degraus.functions import (
    as_boolean,
    at_least_zero,
    code_label,
    decimal_comma,
    normalise_columns,
    out_of_range,
    parse_event_time,
    select_present,
    try_cast_columns,
)
from degraus.operators.reshape import targets_in_force
from degraus.operators.selection import keep_last, keep_last_of_few, pick_network_with_scope
from degraus.sources.csv import ORIGIN
from degraus.spec import CITY_TARGET_SCOPE, EVENT_TYPES, HDI_YEAR, TOPIC_INDICATORS, TOPIC_TARGETS

Order = Sequence[str]
BY_ORIGIN: Order = (ORIGIN,)


def _only_years(df: DataFrame, years: Sequence[int] | None) -> DataFrame:
    return df.where(F.col("ano").isin(list(years))) if years else df


def _latest(df: DataFrame, keys: Sequence[str], order: Order) -> DataFrame:
    """Keep the last row per key, then drop the arrival columns if they are technical."""
    return keep_last(df, keys, order).drop(ORIGIN)


def _result_table(df: DataFrame, entity: str, id_rule, years, order: Order) -> DataFrame:
    df = _only_years(normalise_columns(df), years)
    df = try_cast_columns(df, {"ano": "int", entity: "string", "rede": "tinyint"})
    df = df.withColumn(entity, id_rule(F.col(entity))).withColumn("rede_label", code_label(F.col("rede")))
    df = _latest(df, ["ano", entity, "serie", "rede"], order)
    return df.withColumn("flag_taxa_invalida", out_of_range(F.col("taxa_alfabetizacao"), 0, 100))


def city_results(df: DataFrame, years: Sequence[int] | None = None, order: Order = BY_ORIGIN) -> DataFrame:
    """silver.indicador_municipio"""
    return _result_table(df, "id_municipio", F.trim, years, order)


def state_results(df: DataFrame, years: Sequence[int] | None = None, order: Order = BY_ORIGIN) -> DataFrame:
    """silver.indicador_uf"""
    return _result_table(df, "sigla_uf", lambda c: F.upper(F.trim(c)), years, order)


def national_results(df: DataFrame, years: Sequence[int] | None = None, order: Order = BY_ORIGIN) -> DataFrame:
    """silver.indicador_brasil: the observed rate that each national target vintage carries."""
    df = _only_years(normalise_columns(df), years)
    df = select_present(df, ["ano", "rede", "taxa_alfabetizacao", "percentual_participacao", *order])
    return _latest(try_cast_columns(df, {"ano": "int"}), ["ano"], order)


def national_targets(df: DataFrame, order: Order = BY_ORIGIN) -> DataFrame:
    """silver.meta_brasil"""
    return targets_in_force(normalise_columns(df), [], order).drop(ORIGIN)


def state_targets(df: DataFrame, order: Order = BY_ORIGIN) -> DataFrame:
    """silver.meta_uf"""
    df = normalise_columns(df).withColumn("sigla_uf", F.upper(F.trim("sigla_uf")))
    return targets_in_force(df, ["sigla_uf"], order).drop(ORIGIN)


def city_targets(df: DataFrame, order: Order = BY_ORIGIN) -> DataFrame:
    """silver.meta_municipio"""
    df = try_cast_columns(normalise_columns(df), {"id_municipio": "string"})
    df = df.withColumn("id_municipio", F.trim("id_municipio"))
    return targets_in_force(df, ["id_municipio"], order).drop(ORIGIN)


# The directory columns that are kept.
CITY_DIRECTORY_COLUMNS = [
    "id_municipio", "nome", "sigla_uf", "nome_uf", "nome_regiao", "amazonia_legal", "capital_uf", "ddd",
]


def city_directory(df: DataFrame, order: Order = BY_ORIGIN) -> DataFrame:
    """silver.diretorio_municipio"""
    extra = [c for c in order if c not in CITY_DIRECTORY_COLUMNS]
    df = select_present(normalise_columns(df), [*CITY_DIRECTORY_COLUMNS, *extra], {"nome": "nome_municipio"})
    df = try_cast_columns(df, {"id_municipio": "string"})
    df = df.withColumns({
        "id_municipio": F.trim("id_municipio"),
        "sigla_uf": F.upper(F.trim("sigla_uf")),
        "nome_municipio": F.trim("nome_municipio"),
    })
    return _latest(df, ["id_municipio"], order).drop(*extra)


def state_directory(df: DataFrame, order: Order = BY_ORIGIN) -> DataFrame:
    """silver.diretorio_uf"""
    df = normalise_columns(df).withColumnsRenamed({"sigla": "sigla_uf", "nome": "nome_uf"})
    df = df.withColumns({"sigla_uf": F.upper(F.trim("sigla_uf")), "nome_uf": F.trim("nome_uf")})
    return _latest(df, ["sigla_uf"], order)


# Names of the index columns.
HDI_NAMES = {
    "codmun7": "id_municipio", "municipio_nome_atlas": "nome_municipio_atlas",
    "idhm_e": "idhm_educacao", "idhm_l": "idhm_longevidade", "idhm_r": "idhm_renda",
}
HDI_COLUMNS = ["idhm", "idhm_educacao", "idhm_longevidade", "idhm_renda"]


def city_hdi(df: DataFrame, order: Order = BY_ORIGIN) -> DataFrame:
    """silver.idhm_municipio: all vintages, index texts with a decimal comma read as numbers."""
    df = normalise_columns(df).withColumnsRenamed(HDI_NAMES)
    df = try_cast_columns(df, {"ano": "int", "id_municipio": "string"})
    df = df.withColumn("id_municipio", F.trim("id_municipio"))
    df = df.withColumns({c: decimal_comma(F.col(c)) for c in HDI_COLUMNS if c in df.columns})
    return _latest(df, ["ano", "id_municipio"], order)


def outside_unit_interval(df: DataFrame, columns: Sequence[str] = tuple(HDI_COLUMNS)) -> DataFrame:
    """One row: how many rows have any of the columns outside [0, 1]."""
    flags = [out_of_range(F.col(c), 0, 1) for c in columns if c in df.columns]
    any_flag = flags[0]
    for flag in flags[1:]:
        any_flag = any_flag | flag
    return df.agg(F.count_if(any_flag).alias("fora_do_dominio"))


def students(df: DataFrame, years: Sequence[int] | None = None, order: Order = BY_ORIGIN) -> DataFrame:
    """silver.alunos: microdata, missing scores stay missing."""
    df = _only_years(normalise_columns(df), years)
    df = try_cast_columns(df, {"ano": "int", "id_municipio": "string", "rede": "tinyint"})
    df = df.withColumn("id_municipio", F.trim("id_municipio")).withColumn("rede_label", code_label(F.col("rede")))
    flags = ("presenca", "preenchimento_caderno", "alfabetizado")
    df = df.withColumns({c: as_boolean(F.col(c)) for c in flags if c in df.columns})
    return keep_last_of_few(df, ["ano", "id_municipio", "id_escola", "id_aluno"], order).drop(ORIGIN)


STREAM_ORDER: Order = ("recebido_em", "fluxo", "lote", "linha")
STREAM_COLUMNS = ("recebido_em", "fluxo", "lote", "linha", "data", "valor")


def typed_events(df: DataFrame, topic: str) -> DataFrame:
    """The texts of stored events as numbers and flags."""
    df = try_cast_columns(normalise_columns(df), EVENT_TYPES[topic])
    return df.withColumn("revisao", as_boolean(F.col("revisao"))) if "revisao" in df.columns else df


def _event_table(df: DataFrame, topic: str, entity: str, order: Order, keep: Sequence[str]) -> DataFrame:
    df = typed_events(df, topic)
    if "id_municipio" in df.columns:
        df = df.withColumn("id_municipio", F.trim("id_municipio"))
    df = df.withColumns({
        "sigla_uf": F.upper(F.trim("sigla_uf")),
        "timestamp": parse_event_time(F.col("timestamp")),
    })
    return keep_last(df, [entity, "ano", "timestamp"], order).drop(*(c for c in STREAM_COLUMNS if c not in keep))


def indicator_events(df: DataFrame, order: Order = STREAM_ORDER, keep: Sequence[str] = ()) -> DataFrame:
    """silver.indicador_streaming, kept apart from the official results. ``keep`` names columns of the stream to keep."""
    return _event_table(df, TOPIC_INDICATORS, "id_municipio", order, keep)


def target_events(df: DataFrame, order: Order = STREAM_ORDER, keep: Sequence[str] = ()) -> DataFrame:
    """silver.meta_streaming"""
    return _event_table(df, TOPIC_TARGETS, "sigla_uf", order, keep)


def with_hdi(df: DataFrame, hdi: DataFrame | None, vintage: int = HDI_YEAR) -> DataFrame:
    """LEFT join of one vintage of the enrichment, if there is any."""
    if hdi is None:
        return df
    reference = hdi.where(F.col("ano") == vintage)
    return df.join(select_present(reference, ["id_municipio", *HDI_COLUMNS]), "id_municipio", "left")


def integrate(
    results: DataFrame, directory: DataFrame, targets: DataFrame, hdi: DataFrame | None = None
) -> DataFrame:
    """silver.alfabetizacao_integrado: one row per (year, city).

    The comparison uses the result in the scope the target is set for, not the headline; of
    several series the first counts. It is null where either side is missing; a target whose
    result is null counts as not reached. Behind the pick a city has one row per year, so none of
    the joins has heavy keys.
    """
    picked = pick_network_with_scope(
        results, CITY_TARGET_SCOPE, "taxa_alfabetizacao", "taxa_alfabetizacao_municipal"
    )
    goals = targets.where(F.col("rede") == CITY_TARGET_SCOPE).select(
        "id_municipio",
        F.col("ano_meta").alias("ano"),
        F.col("valor_meta").alias("meta_alfabetizacao_municipal"),
        F.lit(True).alias("__tem_meta"),
    )
    compared = F.col("__no_escopo") & F.col("__tem_meta")
    joined = picked.join(goals, ["id_municipio", "ano"], "left").withColumns({
        c: F.when(compared, F.col(c)) for c in ("taxa_alfabetizacao_municipal", "meta_alfabetizacao_municipal")
    })
    gap = F.col("taxa_alfabetizacao_municipal") - F.col("meta_alfabetizacao_municipal")
    joined = joined.withColumn("gap_meta_municipal", gap).withColumn(
        "atingiu_meta_municipal", F.when(compared, at_least_zero(F.col("gap_meta_municipal")))
    )
    named = joined.drop("__no_escopo", "__tem_meta").join(directory, "id_municipio", "left")
    return with_hdi(named, hdi)


def coverage(integrated: DataFrame) -> DataFrame:
    """One row: integrated rows, rows with a target comparison, rows with enrichment."""
    hdi = F.count("idhm") if "idhm" in integrated.columns else F.lit(0).cast("bigint")
    return integrated.agg(
        F.count("*").alias("registros"), F.count("atingiu_meta_municipal").alias("com_meta"), hdi.alias("com_idhm")
    )
