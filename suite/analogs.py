"""The given tables in the shape of the indicator datasets.

Each function reads whole tables and only renames, scales or derives columns, so that the library
functions run on them unchanged. Facts are summed per entity before they are joined to anything.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from degraus.functions import as_boolean, code_label, round_even
from degraus.plans import gold as g
from degraus.plans import silver as s
from degraus.spec import TARGET_PREFIX, TOPIC_INDICATORS, TOPIC_TARGETS
from degraus.streaming.events import check_events, valid_events

YEARS = list(range(1996, 2002))
VINTAGES = [1995, 1997]
ORDER = ("ordem",)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def city_results_raw(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as published results: year, customer, priority code as network, scaled price."""
    return table(spark, sf, "orders").select(
        F.year("o_orderdate").alias("ano"),
        F.col("o_custkey").cast("string").alias("id_municipio"),
        F.lit("2").alias("serie"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("rede"),
        (F.col("o_totalprice") / 5000.0).alias("taxa_alfabetizacao"),
        F.col("o_orderkey").alias("ordem"),
    )


def city_results(spark: SparkSession, sf: str) -> DataFrame:
    return s.city_results(city_results_raw(spark, sf), order=ORDER).drop("ordem")


def states(spark: SparkSession, sf: str) -> DataFrame:
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    return nation.join(region, nation["n_regionkey"] == region["r_regionkey"], "left").select(
        "n_nationkey", F.col("n_name").alias("sigla_uf"), F.col("r_name").alias("nome_regiao")
    )


def city_directory(spark: SparkSession, sf: str) -> DataFrame:
    """Customers with their nation and region."""
    customer, nations = table(spark, sf, "customer"), states(spark, sf)
    return customer.join(nations, customer["c_nationkey"] == nations["n_nationkey"], "left").select(
        F.col("c_custkey").cast("string").alias("id_municipio"),
        F.col("c_name").alias("nome_municipio"),
        "sigla_uf",
        F.col("sigla_uf").alias("nome_uf"),
        "nome_regiao",
    )


def supplier_directory(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers with their nation."""
    supplier, nations = table(spark, sf, "supplier"), states(spark, sf)
    return supplier.join(nations, supplier["s_nationkey"] == nations["n_nationkey"], "left").select(
        F.col("s_suppkey").cast("string").alias("id_municipio"), "sigla_uf"
    )


def _wide_targets(df: DataFrame, base, missing) -> DataFrame:
    """Target columns per vintage: a yearly step, and a revision for the later vintage."""
    rows = df.withColumn("ano", F.explode(F.array(*map(F.lit, VINTAGES))))
    revision = (F.col("ano") - VINTAGES[0]).cast("double") * 0.25
    return rows.withColumns({
        f"{TARGET_PREFIX}{y}": F.when(~missing, base + float((y - YEARS[0]) * 1.5) + revision) for y in YEARS
    })


def city_targets_raw(spark: SparkSession, sf: str) -> DataFrame:
    """Two vintages of yearly targets per customer; none for a negative balance. One segment was
    not revised."""
    customer = table(spark, sf, "customer")
    wide = _wide_targets(customer, F.col("c_acctbal") / 100.0, F.col("c_acctbal") < 0)
    return wide.where((F.col("ano") == VINTAGES[0]) | (F.col("c_mktsegment") != "BUILDING")).select(
        "ano",
        F.col("c_custkey").cast("string").alias("id_municipio"),
        F.lit("Municipal").alias("rede"),
        *(f"{TARGET_PREFIX}{y}" for y in YEARS),
    )


def city_targets(spark: SparkSession, sf: str) -> DataFrame:
    return s.city_targets(city_targets_raw(spark, sf), order=())


def state_targets(spark: SparkSession, sf: str) -> DataFrame:
    """Targets per nation; one region publishes none."""
    wide = _wide_targets(
        states(spark, sf), F.col("n_nationkey").cast("double") + 35.0, F.col("nome_regiao") == "MIDDLE EAST"
    )
    raw = wide.select("ano", "sigla_uf", F.lit("Pública").alias("rede"), *(f"{TARGET_PREFIX}{y}" for y in YEARS))
    return s.state_targets(raw, order=())


def state_results(spark: SparkSession, sf: str) -> DataFrame:
    """Mean scaled price per year, nation and network, summed per customer before the join."""
    per_city = (
        city_results_raw(spark, sf)
        .groupBy("ano", "id_municipio", "rede")
        .agg(F.sum("taxa_alfabetizacao").alias("soma"), F.count("taxa_alfabetizacao").alias("n"))
    )
    raw = (
        per_city.join(city_directory(spark, sf).select("id_municipio", "sigla_uf"), "id_municipio")
        .groupBy("ano", "sigla_uf", "rede")
        .agg(round_even(F.sum("soma") / F.sum("n"), 2).alias("taxa_alfabetizacao"))
        .withColumn("serie", F.lit("2"))
    )
    return s.state_results(raw, order=("taxa_alfabetizacao",))


def national_raw(spark: SparkSession, sf: str) -> DataFrame:
    """One vintage per year: the observed mean and the targets of the following years."""
    yearly = city_results_raw(spark, sf).groupBy("ano").agg(
        round_even(F.avg("taxa_alfabetizacao"), 2).alias("taxa_alfabetizacao")
    )
    return yearly.select(
        "ano",
        F.lit("Pública").alias("rede"),
        "taxa_alfabetizacao",
        F.lit(87.5).alias("percentual_participacao"),
        *(
            F.when(F.lit(y) > F.col("ano"), F.col("taxa_alfabetizacao") + (F.lit(y) - F.col("ano")).cast("double") * 2.0)
            .alias(f"{TARGET_PREFIX}{y}")
            for y in YEARS
        ),
    )


def national_results(spark: SparkSession, sf: str) -> DataFrame:
    return s.national_results(national_raw(spark, sf), order=("taxa_alfabetizacao",))


def national_targets(spark: SparkSession, sf: str) -> DataFrame:
    return s.national_targets(national_raw(spark, sf), order=())


def integrated(spark: SparkSession, sf: str) -> DataFrame:
    return s.integrate(city_results(spark, sf), city_directory(spark, sf), city_targets(spark, sf))


def city_indicator(spark: SparkSession, sf: str) -> DataFrame:
    return g.city_indicator(integrated(spark, sf), national_results(spark, sf))


def evolution(spark: SparkSession, sf: str, states_found: DataFrame | None = None) -> DataFrame:
    return g.evolution(national_results(spark, sf), state_results(spark, sf) if states_found is None else states_found)


def state_comparison(spark: SparkSession, sf: str, states_found: DataFrame | None = None) -> DataFrame:
    results = state_results(spark, sf) if states_found is None else states_found
    return g.state_comparison(results, state_targets(spark, sf), integrated(spark, sf))


def _network_of_flag(flag):
    return F.when(flag == "A", 2).when(flag == "N", 3).when(flag == "R", 4)


def _score():
    """560 + 7 * quantity, missing where no discount was given."""
    return F.when(F.col("l_discount") > 0, F.lit(560.0) + F.col("l_quantity") * 7.0)


def _student_columns():
    return [
        _network_of_flag(F.col("l_returnflag")).alias("rede"),
        (F.col("l_linestatus") == "F").cast("int").alias("presenca"),
        F.when(F.col("l_tax") > 0, (F.coalesce(_score(), F.lit(0.0)) >= 743).cast("int")).alias("alfabetizado"),
        _score().alias("proficiencia"),
    ]


def students(spark: SparkSession, sf: str) -> DataFrame:
    """Line items as student records of the supplier, in Silver types."""
    return table(spark, sf, "lineitem").select(
        F.year("l_shipdate").alias("ano"),
        F.col("l_suppkey").cast("string").alias("id_municipio"),
        F.col("l_partkey").cast("string").alias("id_escola"),
        F.col("l_orderkey").cast("string").alias("id_aluno"),
        *_student_columns(),
    ).withColumns({
        "rede_label": code_label(F.col("rede")),
        "presenca": as_boolean(F.col("presenca")),
        "alfabetizado": as_boolean(F.col("alfabetizado")),
    })


def students_raw(spark: SparkSession, sf: str) -> DataFrame:
    """Line items of an order as student records with repeated keys (order, line number)."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("ano"))
    lines = table(spark, sf, "lineitem")
    return lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"]).select(
        "ano",
        F.col("o_custkey").cast("string").alias("id_municipio"),
        F.col("l_linenumber").cast("string").alias("id_escola"),
        F.col("l_orderkey").cast("string").alias("id_aluno"),
        *_student_columns(),
        "l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax",
        "l_returnflag", "l_linestatus",
    )


STUDENT_ORDER = (
    "l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus",
)


def hdi_raw(spark: SparkSession, sf: str) -> DataFrame:
    """Three census vintages per customer, indexes as text with a decimal comma."""
    rows = table(spark, sf, "customer").withColumn("ANO", F.explode(F.array(*map(F.lit, [1991, 2000, 2010]))))

    def text(divisor: float):
        return F.replace((F.col("c_acctbal") / divisor).cast("string"), F.lit("."), F.lit(","))

    return rows.select(
        "ANO",
        F.col("c_custkey").cast("string").alias("Codmun7"),
        text(10000.0).alias("IDHM"),
        text(9000.0).alias("IDHM_E"),
        text(12000.0).alias("IDHM_L"),
        text(11000.0).alias("IDHM_R"),
    )


def hdi(spark: SparkSession, sf: str) -> DataFrame:
    return s.city_hdi(hdi_raw(spark, sf), order=("idhm",))


def event_columns() -> list:
    """Events as JSON text per topic. Errors carry no measurement key, sign-ups a null one; purchases
    are target events, and those of a user below 10 lack the revision key."""
    hour = F.date_format(F.date_trunc("hour", F.col("ts")), "yyyy-MM-dd'T'HH:mm:ss")
    options = {"ignoreNullFields": "false"}
    common = [
        F.col("event_type").alias("evento"),
        hour.alias("timestamp"),
        F.concat(F.lit("U"), (F.col("user_id") % 27).cast("string")).alias("sigla_uf"),
        F.year("ts").alias("ano"),
        F.lit("eventos").alias("fonte"),
    ]
    city = [
        *common,
        F.col("user_id").cast("string").alias("id_municipio"),
        F.get_json_object("props", "$.k").cast("int").alias("total_alunos_avaliados"),
        F.lit(743).alias("ponto_corte_saeb"),
    ]
    value = F.when(F.col("event_type") != "signup", F.col("value")).alias("indicador_alfabetizacao")
    target = [*common, F.col("value").alias("meta_percentual")]
    revised = (F.col("value") > 50).alias("revisao")
    is_target = F.col("event_type") == "purchase"
    text = (
        F.when(is_target & (F.col("user_id") < 10), F.to_json(F.struct(*target), options))
        .when(is_target, F.to_json(F.struct(*target, revised), options))
        .when(F.col("event_type") == "error", F.to_json(F.struct(*city), options))
        .otherwise(F.to_json(F.struct(*city, value), options))
    )
    topic = F.when(is_target, F.lit(TOPIC_TARGETS)).otherwise(F.lit(TOPIC_INDICATORS))
    return [topic.alias("topico"), text.alias("valor")]


def event_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The events table as a file stream of (topico, valor)."""
    schema = table(spark, sf, "events").schema
    # A glob, because a file stream takes a folder or a pattern.
    return spark.readStream.schema(schema).parquet(f"{sf}/{{events}}.parquet").select(*event_columns())


def clean_events(spark: SparkSession, sf: str, topic: str) -> DataFrame:
    """Valid events of a topic, straight from the table, in arrival order."""
    events = table(spark, sf, "events").select(*event_columns(), F.col("event_id").alias("linha"))
    return valid_events(check_events(events), topic)
