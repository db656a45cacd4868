"""Gold: the analytic tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from degraus.functions import at_least_zero, band, percentage, round_even, select_present
from degraus.operators.lookups import by_year
from degraus.operators.reshape import union_levels
from degraus.spec import STATE_TARGET_SCOPE
from degraus.streaming.monitor import monitor_topics

# Columns of the city table, in their order.
CITY_COLUMNS = [
    "ano", "id_municipio", "nome_municipio", "sigla_uf", "nome_uf", "nome_regiao", "rede_label",
    "taxa_alfabetizacao", "taxa_alfabetizacao_municipal", "meta_alfabetizacao_municipal",
    "gap_meta_municipal", "atingiu_meta_municipal", "indicador_nacional", "gap_indicador_nacional",
    "faixa_risco", "idhm", "idhm_educacao", "idhm_longevidade", "idhm_renda",
]


def _only_years(df: DataFrame, years: Sequence[int] | None) -> DataFrame:
    return df.where(F.col("ano").isin(list(years))) if years else df


def with_national_gap(df: DataFrame, national: DataFrame) -> DataFrame:
    """Distance to the national rate of the year."""
    joined = by_year(df, national, "taxa_alfabetizacao", "indicador_nacional")
    return joined.withColumn("gap_indicador_nacional", F.col("taxa_alfabetizacao") - F.col("indicador_nacional"))


def city_indicator(integrated: DataFrame, national: DataFrame, years: Sequence[int] | None = None) -> DataFrame:
    """gold.indicador_alfabetizacao_municipio"""
    df = with_national_gap(_only_years(integrated, years), national)
    df = df.withColumn("faixa_risco", band(F.col("taxa_alfabetizacao")))
    return select_present(df, CITY_COLUMNS, {"rede_label": "escopo_rede_headline"})


def attainment_rollup(integrated: DataFrame) -> DataFrame:
    """Per (year, state): cities, cities with a comparison, cities that reached the target."""
    counted = (
        integrated.where(F.col("ano").isNotNull() & F.col("sigla_uf").isNotNull())
        .groupBy("ano", "sigla_uf")
        .agg(
            F.count_distinct("id_municipio").alias("total_municipios"),
            F.count("atingiu_meta_municipal").alias("municipios_avaliados_meta"),
            F.count_if("atingiu_meta_municipal").alias("municipios_meta_atingida"),
        )
    )
    share = percentage(F.col("municipios_meta_atingida"), F.col("municipios_avaliados_meta"))
    return counted.withColumn("pct_municipios_meta_atingida", share)


def state_comparison(
    state_results: DataFrame, state_targets: DataFrame, integrated: DataFrame, years: Sequence[int] | None = None
) -> DataFrame:
    """gold.comparacao_metas_resultados"""
    scoped = state_results.where(F.col("rede_label") == STATE_TARGET_SCOPE).select(
        "ano", "sigla_uf", "taxa_alfabetizacao"
    )
    goals = state_targets.where(F.col("rede") == STATE_TARGET_SCOPE).select(
        "sigla_uf", F.col("ano_meta").alias("ano"), F.col("valor_meta").alias("meta_alfabetizacao")
    )
    compared = _only_years(scoped, years).join(goals, ["ano", "sigla_uf"])
    gap = round_even(F.col("taxa_alfabetizacao") - F.col("meta_alfabetizacao"), 2)
    compared = compared.withColumn("gap", gap).withColumn("atingiu_meta", at_least_zero(F.col("gap")))
    return compared.join(attainment_rollup(_only_years(integrated, years)), ["ano", "sigla_uf"], "left")


def national_and_state_series(national: DataFrame, state_results: DataFrame) -> DataFrame:
    """National and state series under one shape: nivel, referencia, ano, indicador."""
    country = national.select(
        F.lit("BR").alias("referencia"), "ano", F.col("taxa_alfabetizacao").alias("indicador")
    )
    states = state_results.where(F.col("rede_label") == STATE_TARGET_SCOPE).select(
        F.col("sigla_uf").alias("referencia"), "ano", F.col("taxa_alfabetizacao").alias("indicador")
    )
    return union_levels([("brasil", country), ("uf", states)])


def yearly_change(series: DataFrame, years: Sequence[int] | None = None) -> DataFrame:
    """Difference to the previous year of the same series, taken before the years are filtered.

    The window needs no salt: it runs over a yearly series, whose length is the number of years.
    """
    window = Window.partitionBy("nivel", "referencia").orderBy("ano")
    change = round_even(F.col("indicador") - F.lag("indicador").over(window), 2)
    return _only_years(series.withColumn("variacao_yoy", change), years)


def evolution(national: DataFrame, state_results: DataFrame, years: Sequence[int] | None = None) -> DataFrame:
    """gold.evolucao_temporal"""
    return yearly_change(national_and_state_series(national, state_results), years)


def stream_monitoring(indicators: DataFrame | None, targets: DataFrame | None) -> DataFrame | None:
    """gold.monitoramento_streaming; None when no events were ever stored."""
    topics = [("indicadores", indicators, "id_municipio"), ("metas", targets, "sigla_uf")]
    known = [t for t in topics if t[1] is not None]
    return monitor_topics(known) if known else None
