"""One query per operator. Every query reads whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from degraus.functions import (
    band,
    code_label,
    decimal_comma,
    out_of_range,
    parse_event_time,
    round_even,
    select_present,
    try_cast_columns,
)
from degraus.operators import lookups, profile, reshape, selection
from degraus.plans import gold as g
from degraus.plans import silver as s
from degraus.plans import views as v
from degraus.quality import checks as q
from degraus.session import at_once, scratch_dir, stored
from degraus.sources.tables import read_table
from degraus.spec import RISK_BANDS, TOPIC_INDICATORS, TOPIC_TARGETS, Rule
from degraus.streaming import events as ev
from degraus.streaming.monitor import monitor_topics
from suite import analogs as a

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    """Register a query under its function name, without the underscore that avoids a name clash."""
    REGISTRY[fn.__name__.rstrip("_")] = fn
    return fn


def _rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Means of doubles depend on the order of addition in the last bits; compare six digits."""
    return df.withColumns({c: round_even(F.col(c), digits) for c in columns})


# --- Scans, projections, filters ------------------------------------------------------


@query
def scan_project(spark, sf):
    return select_present(
        a.table(spark, sf, "lineitem"),
        ["l_orderkey", "l_linenumber", "l_extendedprice", "not_a_column"],
        {"l_extendedprice": "valor"},
    )


@query
def scan_filter(spark, sf):
    rows = read_table(spark, f"{sf}/lineitem.parquet", {"l_returnflag": "R", "l_linenumber": 1})
    return rows.select("l_orderkey", "l_returnflag", "l_linenumber", "l_quantity")


@query
def filter_years(spark, sf):
    orders = a.table(spark, sf, "orders").select("o_orderkey", F.year("o_orderdate").alias("ano"))
    return orders.where(F.col("ano").isin([1996, 1998]))


@query
def cast_lenient(spark, sf):
    texts = a.table(spark, sf, "orders").select(
        "o_orderkey",
        F.col("o_orderpriority").alias("inteiro"),
        F.substring("o_orderpriority", 1, 1).alias("codigo"),
        F.concat(F.col("o_totalprice").cast("string"), F.when(F.col("o_orderstatus") == "P", F.lit("?")).otherwise(F.lit(""))).alias("preco"),
    )
    return try_cast_columns(texts, {"inteiro": "int", "codigo": "int", "preco": "double", "ausente": "int"})


@query
def key_normalise(spark, sf):
    messy = a.table(spark, sf, "customer").select("c_custkey", F.concat(F.lit("  "), F.lower("c_name"), F.lit(" ")).alias("chave"))
    return messy.withColumn("chave", F.upper(F.trim("chave")))


@query
def decode_label(spark, sf):
    orders = a.city_results_raw(spark, sf).select(F.col("ordem").alias("o_orderkey"), "rede")
    return orders.withColumn("rede_label", code_label(F.col("rede")))


@query
def unmapped_codes(spark, sf):
    parts = a.table(spark, sf, "part").select(F.col("p_size").alias("rede"))
    return lookups.unmapped_codes(parts.withColumn("rede_label", code_label(F.col("rede"))))


@query
def decimal_comma_(spark, sf):
    texts = a.table(spark, sf, "supplier").select(
        "s_suppkey",
        F.when(F.col("s_acctbal") < 0, F.lit("n/d")).otherwise(
            F.replace(F.col("s_acctbal").cast("string"), F.lit("."), F.lit(","))).alias("texto"),
    )
    return texts.select("s_suppkey", decimal_comma(F.col("texto")).alias("valor"))


@query
def ts_parse(spark, sf):
    texts = a.table(spark, sf, "events").select(
        "event_id",
        F.when(F.col("event_type") == "error", F.lit("sem data")).otherwise(
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")).alias("texto"),
    )
    return texts.select("event_id", parse_event_time(F.col("texto")).cast("timestamp_ntz").alias("instante"))


@query
def range_flag(spark, sf):
    orders = a.table(spark, sf, "orders")
    rate = F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice") / 4000.0)
    return orders.select("o_orderkey", out_of_range(rate, 0, 100).alias("flag_taxa_invalida"))


@query
def multi_range_count(spark, sf):
    return s.outside_unit_interval(a.hdi(spark, sf))


@query
def risk_band(spark, sf):
    orders = a.table(spark, sf, "orders")
    rate = F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice") / 4800.0)
    return orders.select("o_orderkey", band(rate).alias("faixa_risco"))


@query
def sample_limit(spark, sf):
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return profile.ordered_head(a.table(spark, sf, "lineitem").select(*keys), keys, 1000)


@query
def sample_seeded(spark, sf):
    orders = a.table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return profile.seeded_sample(orders, ["o_orderkey"], 42, 5)


@query
def latest_year(spark, sf):
    return v.latest_year(a.city_results_raw(spark, sf)).select("ano", F.col("ordem").alias("o_orderkey"))


@query
def years_available(spark, sf):
    return v.years_of(a.city_results_raw(spark, sf))


# --- Reshape, row selection -----------------------------------------------------------


@query
def unpivot_latest(spark, sf):
    return a.city_targets(spark, sf).select("id_municipio", "rede", "ano_referencia", "ano_meta", "valor_meta")


@query
def state_targets(spark, sf):
    return a.state_targets(spark, sf).select("sigla_uf", "rede", "ano_referencia", "ano_meta", "valor_meta")


@query
def national_targets(spark, sf):
    return a.national_targets(spark, sf).select("rede", "ano_referencia", "ano_meta", "valor_meta")


@query
def pivot_years(spark, sf):
    wide = reshape.pivot_years(a.city_results_raw(spark, sf), "id_municipio", "taxa_alfabetizacao", [1995, 2001])
    return _rounded(wide, "taxa_alfabetizacao_1995", "taxa_alfabetizacao_2001")


@query
def dedup_last(spark, sf):
    return a.city_results(spark, sf).select("ano", "id_municipio", "rede", "rede_label", "taxa_alfabetizacao", "flag_taxa_invalida")


@query
def dedup_removed(spark, sf):
    return selection.count_removed(a.city_results_raw(spark, sf), ["ano", "id_municipio", "serie", "rede"])


@query
def headline_pick(spark, sf):
    return selection.pick_network(a.city_results(spark, sf)).select("ano", "id_municipio", "rede", "taxa_alfabetizacao")


@query
def bool_cast(spark, sf):
    silver = s.students(a.students_raw(spark, sf), order=a.STUDENT_ORDER)
    return silver.select(
        "ano", "id_municipio", "id_escola", "id_aluno", "rede_label", "presenca", "alfabetizado", "proficiencia"
    )


@query
def directory_clean(spark, sf):
    raw = a.city_directory(spark, sf).select(
        F.concat(F.lit(" "), F.col("id_municipio")).alias("id_municipio"),
        F.col("nome_municipio").alias("nome"),
        F.lower("sigla_uf").alias("sigla_uf"),
        "nome_regiao",
    )
    return s.city_directory(raw, order=("nome_regiao",))


# --- Joins, set operations ------------------------------------------------------------


@query
def integrated(spark, sf):
    return a.integrated(spark, sf).select(
        "ano", "id_municipio", "rede", "rede_label", "taxa_alfabetizacao", "nome_municipio", "sigla_uf", "nome_regiao",
        "taxa_alfabetizacao_municipal", "meta_alfabetizacao_municipal", "gap_meta_municipal", "atingiu_meta_municipal",
    )


@query
def static_enrich(spark, sf):
    return s.with_hdi(a.city_results(spark, sf).select("ano", "id_municipio", "rede"), a.hdi(spark, sf))


@query
def enrich_coverage(spark, sf):
    full = s.integrate(
        a.city_results(spark, sf), a.city_directory(spark, sf), a.city_targets(spark, sf), a.hdi(spark, sf)
    )
    return s.coverage(full)


@query
def national_gap(spark, sf):
    results = a.city_results(spark, sf).select("ano", "id_municipio", "rede", "taxa_alfabetizacao")
    return g.with_national_gap(results, a.national_results(spark, sf))


@query
def dict_decode(spark, sf):
    orders = a.table(spark, sf, "orders")
    network = orders.select(
        F.lit("orders").alias("id_tabela"),
        F.lit("rede").alias("nome_coluna"),
        F.substring("o_orderpriority", 1, 1).alias("chave"),
        F.substring("o_orderpriority", 3, 30).alias("valor"),
    ).where(F.col("chave") != "4").distinct()
    status = spark.createDataFrame(
        [("orders", "situacao", "F", "Fechado"), ("orders", "situacao", "O", "Aberto"), ("lineitem", "situacao", "P", "x")],
        "id_tabela STRING, nome_coluna STRING, chave STRING, valor STRING",
    )
    coded = orders.select(
        "o_orderkey", "o_custkey", F.substring("o_orderpriority", 1, 1).cast("int").alias("rede"),
        F.col("o_orderstatus").alias("situacao"),
    )
    entries = stored(network.unionByName(status), "dicionario")
    decoded = lookups.decode_with_dictionary(coded, entries, "orders", {"rede": "rede_texto", "situacao": "situacao"})
    return lookups.with_directory_name(decoded, a.table(spark, sf, "customer"), "o_custkey", "c_custkey", "c_name", "nome")


@query
def ref_integrity(spark, sf):
    closed = a.table(spark, sf, "orders").where(F.col("o_orderstatus") != "P")
    return lookups.orphan_keys(a.table(spark, sf, "lineitem"), "l_orderkey", closed, "o_orderkey")


@query
def distinct_dim(spark, sf):
    return a.city_directory(spark, sf).select("sigla_uf", "nome_regiao").distinct()


@query
def domain_set(spark, sf):
    return lookups.outside_domain(a.table(spark, sf, "events"), "event_type", ["CLICK", "VIEW", "PURCHASE"])


@query
def union_levels(spark, sf):
    return g.national_and_state_series(a.national_results(spark, sf), a.state_results(spark, sf))


# --- Gold -----------------------------------------------------------------------------


@query
def gold_entity(spark, sf):
    return a.city_indicator(spark, sf)


@query
def uf_rollup(spark, sf):
    return g.attainment_rollup(a.integrated(spark, sf))


@query
def uf_comparison(spark, sf):
    return a.state_comparison(spark, sf)


@query
def yoy_change(spark, sf):
    return a.evolution(spark, sf)


# --- Views ----------------------------------------------------------------------------


def _gold_cities(spark, sf) -> DataFrame:
    """The views read stored Gold tables, as in a run; so the base is computed once."""
    return stored(a.city_indicator(spark, sf), "indicador-municipio")


def _evolution(spark, sf) -> DataFrame:
    return stored(a.evolution(spark, sf), "evolucao")


@query
def national_series(spark, sf):
    return v.national_series(a.evolution(spark, sf))


@query
def national_target_path(spark, sf):
    return v.national_target_path(a.national_targets(spark, sf), start=1997)


@query
def national_headline(spark, sf):
    return v.national_headline(a.evolution(spark, sf), a.national_targets(spark, sf), horizon=2001)


@query
def series_by_uf(spark, sf):
    return v.state_series(a.evolution(spark, sf))


def _overview(spark, sf) -> DataFrame:
    # The results of the states are stored once; what is built on them does not wait for one another.
    found = stored(a.state_results(spark, sf), "resultados-uf")
    built = at_once({
        "comparison": lambda: stored(a.state_comparison(spark, sf, found), "comparacao"),
        "evolution": lambda: stored(a.evolution(spark, sf, found), "evolucao"),
    })
    return _rounded(v.state_overview(built["evolution"], built["comparison"]), "indicador_atual", "delta")


@query
def uf_overview(spark, sf):
    return _overview(spark, sf)


@query
def uf_ranking(spark, sf):
    return v.state_rankings(stored(_overview(spark, sf), "uf-ranking"))


@query
def uf_moves(spark, sf):
    return v.state_moves(_evolution(spark, sf), 1998)


@query
def muni_rank(spark, sf):
    return v.city_rankings(_gold_cities(spark, sf))


@query
def muni_delta(spark, sf):
    return v.city_change_rankings(_gold_cities(spark, sf))


@query
def attainment_summary(spark, sf):
    return v.attainment_summary(_gold_cities(spark, sf))


@query
def worst_gap(spark, sf):
    return v.worst_gaps(a.city_indicator(spark, sf), 1998)


@query
def micro_history(spark, sf):
    totals = v.student_totals(a.students(spark, sf), ["ano"])
    return _rounded(v.student_history(totals), "pct_alfabetizado", "proficiencia_media")


@query
def micro_by_group(spark, sf):
    totals = stored(v.student_totals(a.students(spark, sf), ["ano", "rede_label"]), "aluno-totais")
    return _rounded(v.student_by_network(totals), "pct_alfabetizado", "proficiencia_media")


def _city_totals(spark, sf) -> DataFrame:
    return v.student_totals(a.students(spark, sf), ["ano", "id_municipio"])


@query
def micro_by_uf(spark, sf):
    figures = v.student_by_state(_city_totals(spark, sf), a.supplier_directory(spark, sf))
    return _rounded(figures, "pct_alfabetizado", "proficiencia_media")


@query
def micro_uf_rank(spark, sf):
    totals = stored(_city_totals(spark, sf), "aluno-totais")
    ranked = v.student_state_ranking(totals, a.supplier_directory(spark, sf), support=30)
    return _rounded(ranked, "pct_alfabetizado", "proficiencia_media")


@query
def micro_uf_delta(spark, sf):
    totals = stored(_city_totals(spark, sf), "aluno-totais")
    ranked = v.student_state_changes(totals, a.supplier_directory(spark, sf), support=30)
    return _rounded(ranked, "proficiencia_inicial", "proficiencia_atual", "delta")


@query
def histogram_fixed(spark, sf):
    return v.student_histogram(a.students(spark, sf))


# --- Profiling ------------------------------------------------------------------------


@query
def histogram_range(spark, sf):
    return profile.range_histogram(a.city_results_raw(spark, sf), "taxa_alfabetizacao", 30)


@query
def value_counts(spark, sf):
    labels = a.table(spark, sf, "orders").select(F.substring("o_orderpriority", 3, 30).alias("rotulo"))
    return _rounded(profile.value_counts(labels, "rotulo"), "proporcao")


@query
def value_counts_listed(spark, sf):
    bands = a.table(spark, sf, "orders").select(band(F.col("o_totalprice") / 6000.0).alias("faixa_risco"))
    order = [label for _, _, label in RISK_BANDS]
    return _rounded(profile.value_counts(bands, "faixa_risco", order), "proporcao")


@query
def median(spark, sf):
    return profile.exact_median(a.table(spark, sf, "lineitem"), "l_extendedprice")


@query
def corr_matrix(spark, sf):
    lines = a.table(spark, sf, "lineitem").select(
        F.when(F.col("l_discount") > 0, F.col("l_quantity")).alias("quantidade"),
        F.col("l_extendedprice").alias("preco"),
        F.when(F.col("l_tax") > 0, F.col("l_quantity") + F.col("l_tax") * 100.0).alias("imposto"),
    )
    return _rounded(profile.correlation_matrix(lines, ["quantidade", "preco", "imposto"]), "correlacao")


@query
def null_profile(spark, sf):
    return profile.null_profile(a.students(spark, sf))


@query
def table_profile(spark, sf):
    return profile.table_profile(a.students(spark, sf).drop("id_escola", "id_aluno"), "alunos")


# --- Quality --------------------------------------------------------------------------

STUDENT_RULE = Rule(
    ("ano", "id_escola", "id_aluno"),
    ("ano", "id_municipio", "alfabetizado", "proficiencia", "peso_aluno"),
    5.0,
    ranges={"proficiencia": (580.0, 900.0)},
)
CITY_RULE = Rule(
    ("ano", "id_municipio"),
    ("ano", "id_municipio", "sigla_uf", "taxa_alfabetizacao"),
    40.0,
    ranges={"taxa_alfabetizacao": (0.0, 100.0)},
    references={"sigla_uf": ("diretorio_uf", "sigla_uf")},
    domains={"nome_regiao": ["AFRICA", "AMERICA", "ASIA", "EUROPE"]},
)


@query
def dq_completeness(spark, sf):
    report = q.column_checks(a.students(spark, sf), STUDENT_RULE.required, STUDENT_RULE.max_null_pct)
    return report.select("tipo", "coluna", "medida", "pct", "limite", "registros", "falhou")


@query
def dq_uniqueness(spark, sf):
    return q.uniqueness_check(a.students(spark, sf), STUDENT_RULE.keys).select("tipo", "coluna", "medida", "falhou")


@query
def dq_uniqueness_large(spark, sf):
    """The way of tables with many wide rows: hashes first."""
    report = q.uniqueness_check(a.students(spark, sf), STUDENT_RULE.keys, large=True)
    return report.select("tipo", "coluna", "medida", "falhou")


@query
def dq_range(spark, sf):
    report = q.column_checks(a.students(spark, sf), ranges=STUDENT_RULE.ranges)
    return report.select("tipo", "coluna", "medida", "minimo", "maximo", "registros", "falhou")


@query
def dq_domain(spark, sf):
    report = q.domain_check(a.table(spark, sf, "events"), "event_type", ["CLICK", "VIEW", "PURCHASE"])
    return report.select("tipo", "coluna", "medida", "falhou", F.array_join("exemplos", ",").alias("exemplos"))


def _report(spark, sf):
    states = a.states(spark, sf).where(F.col("nome_regiao") != "ASIA")
    integrated = stored(a.integrated(spark, sf), "integrado")
    cities = q.check_table(integrated, "alfabetizacao_integrado", CITY_RULE, "silver", lambda _: states)
    students = q.check_table(a.students(spark, sf), "alunos", STUDENT_RULE, "bronze")
    national = q.check_table(
        a.national_results(spark, sf), "indicador_brasil", Rule(("ano",), ("ano", "taxa_alfabetizacao"), 0.0), "silver"
    )
    return cities.unionByName(students).unionByName(national)


@query
def dq_report(spark, sf):
    return _report(spark, sf).select(
        "camada", "tabela", "tipo", "coluna", "medida", "pct", "limite", "falhou",
        F.coalesce(F.array_join("exemplos", ","), F.lit("")).alias("exemplos"),
    )


@query
def dq_alerts(spark, sf):
    return q.alerts(_report(spark, sf))


@query
def dq_tables(spark, sf):
    return q.summarise(_report(spark, sf))


@query
def dq_summary(spark, sf):
    return q.roll_up(_report(spark, sf))


# --- Streaming ------------------------------------------------------------------------


def _ingested(spark, sf) -> str:
    """Run the events table through the stream; returns the Bronze folder."""
    work = scratch_dir(spark, "eventos")
    ev.ingest_available(a.event_stream(spark, sf), f"{work}/bronze", f"{work}/checkpoint")
    return f"{work}/bronze"


@query
def stream_valid(spark, sf):
    rows = s.typed_events(spark.read.parquet(f"{_ingested(spark, sf)}/streaming_indicadores"), TOPIC_INDICATORS)
    return rows.select(
        "evento", "timestamp", "id_municipio", "sigla_uf", "ano", "indicador_alfabetizacao",
        "total_alunos_avaliados", "ponto_corte_saeb", "fonte",
    )


@query
def stream_reject(spark, sf):
    rows = spark.read.parquet(f"{_ingested(spark, sf)}/streaming_rejeitados")
    return rows.select("topico", "campos_ausentes", F.get_json_object("evento_bruto", "$.evento").alias("evento")).groupBy(
        "topico", "campos_ausentes", "evento").agg(F.count("*").alias("eventos"))


@query
def stream_counts(spark, sf):
    return ev.event_counts(ev.check_events(a.table(spark, sf, "events").select(*a.event_columns())))


@query
def stream_dedup(spark, sf):
    silver = s.indicator_events(a.clean_events(spark, sf, TOPIC_INDICATORS), order=("linha",))
    return silver.select(
        "id_municipio", "ano", F.col("timestamp").cast("timestamp_ntz").alias("timestamp"), "evento",
        "indicador_alfabetizacao",
    )


@query
def stream_dedup_targets(spark, sf):
    silver = s.target_events(a.clean_events(spark, sf, TOPIC_TARGETS), order=("linha",))
    return silver.select(
        "sigla_uf", "ano", F.col("timestamp").cast("timestamp_ntz").alias("timestamp"), "meta_percentual", "revisao"
    )


@query
def stream_monitor(spark, sf):
    indicators = s.indicator_events(a.clean_events(spark, sf, TOPIC_INDICATORS), order=("linha",))
    targets = s.target_events(a.clean_events(spark, sf, TOPIC_TARGETS), order=("linha",))
    rows = monitor_topics([("indicadores", indicators, "id_municipio"), ("metas", targets, "sigla_uf")])
    return rows.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("primeiro_evento", "ultimo_evento")})
