"""Every registered query against its SQL text, on the smallest given tables and on skewed ones."""

import os

import pytest

from suite.compare import TABLES, compare
from suite.oracle import oracle_sql
from suite.queries import REGISTRY
from suite.sources import source_tables

DATA = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")

# The same tables with one customer, order, supplier, user, day and price in a third of the rows or more.
SKEWED = {
    "customer": "SELECT * REPLACE (CAST(CASE WHEN c_custkey % 3 = 0 THEN 7 ELSE c_nationkey END AS INTEGER) AS c_nationkey)",
    "orders": "SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 42 ELSE o_custkey END AS o_custkey, "
              "CASE WHEN o_orderkey % 2 = 0 THEN TIMESTAMP '1998-05-01' ELSE o_orderdate END AS o_orderdate)",
    "lineitem": "SELECT * REPLACE (CASE WHEN l_partkey % 3 = 0 THEN 77 ELSE l_orderkey END AS l_orderkey, "
                "CASE WHEN l_partkey % 3 = 1 THEN 5 ELSE l_suppkey END AS l_suppkey, "
                "CASE WHEN l_partkey % 3 = 0 THEN 1000.5e0 ELSE l_extendedprice END AS l_extendedprice)",
    "events": "SELECT * REPLACE (CASE WHEN event_id % 3 = 0 THEN TIMESTAMP '2024-01-05 10:00:00' ELSE ts END AS ts, "
              "CASE WHEN event_id % 3 = 0 THEN 11 ELSE user_id END AS user_id)",
}

# The queries with joins, selections or groupings on the heavy keys.
ON_HEAVY_KEYS = {
    "dedup_last", "headline_pick", "bool_cast", "integrated", "static_enrich", "national_gap", "dict_decode",
    "ref_integrity", "uf_rollup", "uf_comparison", "micro_by_uf", "micro_uf_rank", "median", "table_profile",
    "dq_uniqueness", "stream_dedup", "stream_monitor",
}


def test_every_query_has_sql():
    assert set(REGISTRY) == set(oracle_sql())


@needs_data
def test_queries_match_sql(spark):
    wrong = {name: message for name, message, *_ in compare(spark, DATA) if message not in (None, "no sql")}
    assert wrong == {}


@needs_data
def test_skewed_tables_without_automatic_broadcast(spark, tmp_path):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        select = SKEWED.get(t, "SELECT *")
        con.execute(f"COPY ({select} FROM '{DATA}/{t}.parquet') TO '{tmp_path}/{t}.parquet' (FORMAT parquet)")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8KB",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        wrong = {n: m for n, m, *_ in compare(spark, str(tmp_path), ON_HEAVY_KEYS) if m is not None}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    assert wrong == {}


@needs_data
def test_derived_sources_pass_the_gates(spark, tmp_path):
    from degraus.plans.run import Lake, run
    from suite.sources import write_sources

    assert set(source_tables(spark, DATA)) >= {"alunos", "diretorio_municipio"}
    result = run(Lake(spark, str(tmp_path / "lake"), write_sources(spark, DATA, str(tmp_path / "raw"))))
    assert result.published, result
