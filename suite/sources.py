"""CSV sources of a whole installation, derived from the given tables.

For timing and testing the gated run: line items as student records, customers as cities, nations
as states. All keys are unique, so the run passes its gates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from degraus.functions import round_even
from degraus.spec import SOURCES, STATES
from suite import analogs as a


def _state(key: str):
    return F.element_at(F.array(*map(F.lit, STATES)), F.col(key) + 1)


def _with_state(df: DataFrame, spark: SparkSession, sf: str) -> DataFrame:
    """Replace nation names by state codes."""
    nations = a.table(spark, sf, "nation").select(F.col("n_name").alias("sigla_uf"), _state("n_nationkey").alias("__uf"))
    return df.join(nations, "sigla_uf").drop("sigla_uf").withColumnRenamed("__uf", "sigla_uf")


def source_tables(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    results = a.city_results_raw(spark, sf).groupBy("ano", "id_municipio", "serie", "rede").agg(
        F.max("taxa_alfabetizacao").alias("taxa_alfabetizacao")
    )
    states = results.join(a.city_directory(spark, sf).select("id_municipio", "sigla_uf"), "id_municipio").groupBy(
        "ano", "sigla_uf", "serie", "rede"
    ).agg(round_even(F.avg("taxa_alfabetizacao"), 2).alias("taxa_alfabetizacao"))
    nation, region = a.table(spark, sf, "nation"), a.table(spark, sf, "region")
    goals = a.table(spark, sf, "nation").select(
        F.explode(F.array(*map(F.lit, a.VINTAGES))).alias("ano"), _state("n_nationkey").alias("sigla_uf"),
        F.lit("Pública").alias("rede"),
        *(F.lit(40.0 + y - a.YEARS[0]).alias(f"meta_alfabetizacao_{y}") for y in a.YEARS),
    )
    keys = ["ano", "id_municipio", "id_escola", "id_aluno"]
    students = a.table(spark, sf, "lineitem").select(
        F.year("l_shipdate").alias("ano"),
        F.col("l_suppkey").cast("string").alias("id_municipio"),
        F.concat_ws("-", "l_partkey", F.date_format("l_shipdate", "MMdd")).alias("id_escola"),
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("id_aluno"),
        F.lit(1).alias("caderno"),
        F.lit(2).alias("serie"),
        F.when(F.col("l_returnflag") == "A", 2).when(F.col("l_returnflag") == "N", 3).otherwise(4).alias("rede"),
        (F.col("l_linestatus") == "F").cast("int").alias("presenca"),
        (F.col("l_linestatus") == "F").cast("int").alias("preenchimento_caderno"),
        (F.col("l_quantity") >= 26).cast("int").alias("alfabetizado"),
        F.when(F.col("l_linestatus") == "F", F.col("l_quantity") * 7.0 + 560.0).alias("proficiencia"),
        F.when(F.col("l_linestatus") == "F", F.lit(1.0)).alias("peso_aluno"),
    ).dropDuplicates(keys)
    return {
        "indicador_municipio": results,
        "indicador_uf": _with_state(states, spark, sf),
        "meta_brasil": a.national_raw(spark, sf),
        "meta_uf": goals,
        "meta_municipio": a.city_targets_raw(spark, sf),
        "alunos": students,
        "diretorio_municipio": _with_state(
            a.city_directory(spark, sf).withColumnRenamed("nome_municipio", "nome"), spark, sf),
        "diretorio_uf": nation.join(region, nation["n_regionkey"] == region["r_regionkey"]).select(
            F.col("n_nationkey").alias("id_uf"), _state("n_nationkey").alias("sigla"), F.col("n_name").alias("nome"),
            F.col("r_name").alias("regiao")),
    }


def write_sources(spark: SparkSession, sf: str, folder: str) -> str:
    """Write the CSV files; the optional enrichment is left out."""
    for name, df in source_tables(spark, sf).items():
        df.write.option("header", True).csv(f"{folder}/{SOURCES[name].file}")
    return folder
