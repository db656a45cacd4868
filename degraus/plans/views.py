"""Dashboard views: small aggregates over Gold and Silver tables.

Every figure list is a DataFrame of its own, so it can be exported, joined or compared. The inputs
are stored tables: several views read theirs more than once (bounds first, then rows).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from degraus.functions import percentage, round_even
from degraus.operators.profile import bin_number, with_empty_bins
from degraus.operators.ranking import best_and_worst, largest_changes, ranked_lists
from degraus.operators.reshape import first_and_last_year
from degraus.session import stored
from degraus.spec import MIN_STUDENTS, PROFICIENCY_BINS, TARGET_PATH_END, TARGET_PATH_FROM


def two_digits(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Round the figures of a view for display."""
    return df.withColumns({c: round_even(F.col(c), 2) for c in columns if c in df.columns})


def years_of(df: DataFrame, year: str = "ano") -> DataFrame:
    """Distinct years in order."""
    return df.select(year).where(F.col(year).isNotNull()).distinct().orderBy(year)


def latest_year(df: DataFrame, year: str = "ano") -> DataFrame:
    """Rows of the last year in the data."""
    return df.where(F.col(year) == df.agg(F.max(year)).scalar())


# --- Country --------------------------------------------------------------------------


def national_series(evolution: DataFrame) -> DataFrame:
    return (
        evolution.where(F.col("nivel") == "brasil").select("ano", "indicador", "variacao_yoy").orderBy("ano")
    )


def national_target_path(targets: DataFrame, start: int = TARGET_PATH_FROM) -> DataFrame:
    return targets.where(F.col("ano_meta") >= start).select(
        F.col("ano_meta").alias("ano"), F.col("valor_meta").alias("meta")
    ).orderBy("ano")


def national_headline(evolution: DataFrame, targets: DataFrame, horizon: int = TARGET_PATH_END) -> DataFrame:
    """One row: last value, its yearly change, the target of the horizon year, both distances."""
    series = evolution.where(F.col("nivel") == "brasil")
    goal = targets.where(F.col("ano_meta") == horizon).agg(F.max("valor_meta")).scalar()
    row = series.agg(
        F.max("ano").alias("ano_atual"),
        F.max_by("indicador", "ano").alias("indicador_atual"),
        F.max_by("variacao_yoy", "ano").alias("variacao_yoy"),
        F.min("ano").alias("ano_inicial"),
        F.min_by("indicador", "ano").alias("indicador_inicial"),
    ).withColumn("meta_final", goal)
    return row.select(
        "ano_atual",
        "indicador_atual",
        "variacao_yoy",
        "meta_final",
        (F.nullif(F.col("meta_final"), F.lit(0.0)) - F.col("indicador_atual")).alias("gap_meta_final"),
        (F.col("indicador_atual") - F.col("indicador_inicial")).alias("delta_periodo"),
        "ano_inicial",
    )


# --- States ---------------------------------------------------------------------------


def state_series(evolution: DataFrame) -> DataFrame:
    """Yearly series per state, ordered by state and year."""
    return (
        evolution.where(F.col("nivel") == "uf")
        .select(F.col("referencia").alias("sigla_uf"), "ano", "indicador")
        .orderBy("sigla_uf", "ano")
    )


def state_overview(evolution: DataFrame, comparison: DataFrame) -> DataFrame:
    """Per state: value of the last year, change since the first, and the last target comparison."""
    states = evolution.where(F.col("nivel") == "uf")
    ends = first_and_last_year(states, "referencia", ["indicador"]).select(
        F.col("referencia").alias("sigla_uf"),
        F.col("indicador_atual"),
        (F.col("indicador_atual") - F.col("indicador_inicial")).alias("delta"),
    )
    current = latest_year(comparison).select(
        "sigla_uf", "meta_alfabetizacao", "gap", "atingiu_meta", "pct_municipios_meta_atingida"
    )
    return ends.join(current, "sigla_uf", "left").select(
        "sigla_uf", "indicador_atual", "meta_alfabetizacao", "gap", "atingiu_meta",
        "pct_municipios_meta_atingida", "delta",
    )


def state_rankings(overview: DataFrame, size: int = 5) -> DataFrame:
    """The four state lists: best, worst, most improved, most declined."""
    return ranked_lists(
        overview,
        [
            ("melhores", "indicador_atual", False),
            ("piores", "indicador_atual", True),
            ("mais_melhoraram", "delta", False),
            ("mais_pioraram", "delta", True),
        ],
        "sigla_uf",
        size,
    )


# --- Cities ---------------------------------------------------------------------------


def city_rankings(cities: DataFrame, size: int = 10) -> DataFrame:
    """Best and worst cities of the last year."""
    wanted = ["id_municipio", "nome_municipio", "sigla_uf", "nome_regiao", "taxa_alfabetizacao", "faixa_risco"]
    hdi = F.col("idhm") if "idhm" in cities.columns else F.lit(None).cast("double")
    current = latest_year(cities).select(*wanted, hdi.alias("idhm"))
    return best_and_worst(current, "taxa_alfabetizacao", "id_municipio", size)


def city_changes(cities: DataFrame) -> DataFrame:
    """First against last year per city that has both, with its current directory columns."""
    ends = first_and_last_year(cities, "id_municipio", ["taxa_alfabetizacao"]).select(
        "id_municipio",
        F.col("taxa_alfabetizacao_inicial").alias("taxa_inicial"),
        F.col("taxa_alfabetizacao_atual").alias("taxa_atual"),
    )
    both = ends.where(F.col("taxa_inicial").isNotNull() & F.col("taxa_atual").isNotNull())
    names = latest_year(cities).select("id_municipio", "nome_municipio", "sigla_uf", "nome_regiao")
    return both.withColumn("delta", F.col("taxa_atual") - F.col("taxa_inicial")).join(names, "id_municipio", "left")


def city_change_rankings(cities: DataFrame, size: int = 10) -> DataFrame:
    return largest_changes(city_changes(cities), "delta", "id_municipio", size)


def attainment_summary(cities: DataFrame) -> DataFrame:
    """One row for the last year: cities, with a target comparison, target reached, share."""
    row = latest_year(cities).agg(
        F.max("ano").alias("ano"),
        F.count_distinct("id_municipio").alias("total_municipios_avaliados"),
        F.count("atingiu_meta_municipal").alias("total_com_meta"),
        F.count_if("atingiu_meta_municipal").alias("atingiram"),
    )
    return row.withColumn("pct_atingiram", percentage(F.col("atingiram"), F.col("total_com_meta")))


def worst_gaps(cities: DataFrame, year: int, size: int = 10) -> DataFrame:
    """Cities furthest below their own target in a year."""
    return (
        cities.where((F.col("ano") == year) & F.col("gap_meta_municipal").isNotNull())
        .select(
            "id_municipio", "nome_municipio", "sigla_uf", "taxa_alfabetizacao_municipal",
            "meta_alfabetizacao_municipal", "gap_meta_municipal",
        )
        .orderBy("gap_meta_municipal", "id_municipio")
        .limit(size)
    )


def state_moves(evolution: DataFrame, year: int, size: int = 6) -> DataFrame:
    """Largest rises and falls of the states in a year."""
    moves = evolution.where((F.col("nivel") == "uf") & (F.col("ano") == year)).select("referencia", "variacao_yoy")
    return ranked_lists(moves, [("altas", "variacao_yoy", False), ("quedas", "variacao_yoy", True)], "referencia", size)


# --- Students -------------------------------------------------------------------------

_SUMS = ["avaliados", "com_id", "alfabetizados", "com_resultado", "soma_proficiencia", "com_proficiencia"]


def student_totals(students: DataFrame, keys: Sequence[str] = ("ano", "id_municipio", "rede_label")) -> DataFrame:
    """Sums and counts of the students present, per key.

    The student views are built on these totals. Store them once and the microdata is scanned
    once for all views; it is reduced in the map tasks before anything is shuffled or joined.
    """
    passed = F.col("alfabetizado")
    return (
        students.where(F.col("presenca"))
        .groupBy(*keys)
        .agg(
            F.count("*").alias("avaliados"),
            F.count("id_aluno").alias("com_id"),
            F.count_if(passed).alias("alfabetizados"),
            F.count(passed).alias("com_resultado"),
            F.sum("proficiencia").alias("soma_proficiencia"),
            F.count("proficiencia").alias("com_proficiencia"),
        )
    )


def _sum_up(totals: DataFrame, keys: Sequence[str]) -> DataFrame:
    return totals.groupBy(*keys).agg(*(F.sum(c).alias(c) for c in _SUMS))


def _figures(totals: DataFrame, keys: Sequence[str], size: str = "avaliados") -> DataFrame:
    return _sum_up(totals, keys).select(
        *keys,
        F.col(size).alias("total_avaliados"),
        (F.try_divide(F.col("alfabetizados"), F.col("com_resultado")) * 100.0).alias("pct_alfabetizado"),
        F.try_divide(F.col("soma_proficiencia"), F.col("com_proficiencia")).alias("proficiencia_media"),
    )


def student_history(totals: DataFrame) -> DataFrame:
    """Per year: students assessed, share that passed, mean score."""
    return _figures(totals.where(F.col("ano").isNotNull()), ["ano"]).orderBy("ano")


def student_by_network(totals: DataFrame) -> DataFrame:
    """The same figures per network in the last year, largest first."""
    last = latest_year(totals).where(F.col("rede_label").isNotNull())
    return (
        _figures(last, ["rede_label"])
        .withColumnRenamed("rede_label", "rede")
        .orderBy(F.desc("total_avaliados"), "rede")
    )


def student_histogram(students: DataFrame) -> DataFrame:
    """Score distribution in the last year.

    Binned for every year in one scan; the last year is then picked among (years x bins) rows,
    the only rows that meet in one task.
    """
    binned = (
        students.where(F.col("presenca"))
        .groupBy("ano", bin_number("proficiencia", *PROFICIENCY_BINS).alias("faixa"))
        .agg(F.count("*").alias("contagem"))
    )
    last = F.max("ano").over(Window.partitionBy())
    counts = (
        binned.withColumn("ultimo", last)
        .where((F.col("ano") == F.col("ultimo")) & F.col("faixa").isNotNull())
        .select("faixa", "contagem")
    )
    return with_empty_bins(counts, *PROFICIENCY_BINS)


def student_by_state(totals: DataFrame, directory: DataFrame) -> DataFrame:
    """Figures per (year, state). The join sees the totals per city, so a city with a large
    share of all students is one row per year."""
    per_city = _sum_up(totals, ["ano", "id_municipio"])
    pairs = directory.select("id_municipio", "sigla_uf").distinct()
    placed = per_city.join(pairs, "id_municipio", "left")
    named = placed.where(F.col("ano").isNotNull() & F.col("sigla_uf").isNotNull())
    return _figures(named, ["ano", "sigla_uf"], size="com_id")


def student_state_ranking(
    totals: DataFrame, directory: DataFrame, size: int = 5, support: int = MIN_STUDENTS
) -> DataFrame:
    """States with the best and worst mean score of the last year, given enough students."""
    current = student_by_state(latest_year(totals), directory).where(F.col("total_avaliados") >= support)
    return best_and_worst(current.drop("ano"), "proficiencia_media", "sigla_uf", size)


def student_state_changes(
    totals: DataFrame, directory: DataFrame, size: int = 5, support: int = MIN_STUDENTS
) -> DataFrame:
    """States whose mean score changed most between the first and the last year."""
    bounds = totals.agg(F.min("ano").alias("primeiro"), F.max("ano").alias("ultimo"))
    first, last = bounds.select("primeiro").scalar(), bounds.select("ultimo").scalar()
    ends = totals.where((F.col("ano") == first) | (F.col("ano") == last))
    figures = student_by_state(ends, directory).withColumns({
        "inicial": F.col("ano") == first, "atual": F.col("ano") == last,
    })

    def at(end, column):
        return F.max(F.when(F.col(end), F.col(column)))

    compared = (
        figures.groupBy("sigla_uf")
        .agg(
            at("inicial", "proficiencia_media").alias("proficiencia_inicial"),
            at("atual", "proficiencia_media").alias("proficiencia_atual"),
            at("inicial", "total_avaliados").alias("n_inicial"),
            at("atual", "total_avaliados").alias("n_atual"),
        )
        .where((F.col("n_inicial") >= support) & (F.col("n_atual") >= support))
        .where(F.col("proficiencia_inicial").isNotNull() & F.col("proficiencia_atual").isNotNull())
        .select(
            "sigla_uf",
            "proficiencia_inicial",
            "proficiencia_atual",
            (F.col("proficiencia_atual") - F.col("proficiencia_inicial")).alias("delta"),
        )
    )
    return largest_changes(compared, "delta", "sigla_uf", size)


def dashboard(gold, silver) -> dict[str, DataFrame]:
    """All views by name. ``gold`` and ``silver`` read a table by name (see ``Layer.read``)."""
    evolution = gold("evolucao_temporal")
    comparison = gold("comparacao_metas_resultados")
    cities = gold("indicador_alfabetizacao_municipio")
    targets, students = silver("meta_brasil"), silver("alunos")
    directory = silver("diretorio_municipio")
    overview = stored(state_overview(evolution, comparison), "uf-ranking")
    totals = stored(student_totals(students), "aluno-totais")
    views = {
        "brasil_serie": national_series(evolution),
        "brasil_serie_meta": national_target_path(targets),
        "brasil_headline": national_headline(evolution, targets),
        "uf_anos": years_of(evolution.where(F.col("nivel") == "uf")),
        "uf_series": state_series(evolution),
        "uf_ranking": overview,
        "uf_listas": state_rankings(overview),
        "municipio_anos": years_of(cities),
        "municipio_meta": attainment_summary(cities),
        "municipio_listas": city_rankings(cities),
        "municipio_variacao": city_change_rankings(cities),
        "aluno_historico": student_history(totals),
        "aluno_distribuicao": student_histogram(students),
        "aluno_por_rede": student_by_network(totals),
        "aluno_uf_listas": student_state_ranking(totals, directory),
        "aluno_uf_variacao": student_state_changes(totals, directory),
    }
    figures = [
        "indicador", "variacao_yoy", "meta", "indicador_atual", "meta_final", "gap_meta_final", "delta_periodo",
        "meta_alfabetizacao", "gap", "pct_municipios_meta_atingida", "delta", "taxa_alfabetizacao", "idhm",
        "taxa_inicial", "taxa_atual", "pct_alfabetizado", "proficiencia_media", "proficiencia_inicial",
        "proficiencia_atual",
    ]
    return {name: two_digits(view, figures) for name, view in views.items()}
