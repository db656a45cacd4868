import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from degraus.operators import lookups, profile, ranking, reshape, selection


def rows(df, *columns):
    return sorted((tuple(r[c] for c in (columns or df.columns)) for r in df.collect()), key=str)


# --- Row selection --------------------------------------------------------------------


def test_keep_last(frame):
    df = frame([("1", 10, 1), ("1", 20, 2), ("2", 30, 3)], "id STRING, valor INT, ordem INT")
    assert rows(selection.keep_last(df, ["id"], ["ordem"]), "id", "valor") == [("1", 20), ("2", 30)]


def test_keep_last_equals_pandas_with_null_keys_and_a_dominant_key(spark):
    rng = np.random.default_rng(7)
    key = np.where(rng.random(5000) < 0.4, 3.0, rng.integers(0, 300, 5000)).astype(float)
    key[rng.random(5000) < 0.05] = np.nan
    pdf = pd.DataFrame({"k": key, "v": rng.integers(0, 99, 5000), "ordem": np.arange(5000)})
    want = pdf.drop_duplicates("k", keep="last")["ordem"].tolist()
    df = spark.createDataFrame(pdf.astype({"k": object}).where(pdf.notna(), None), "k DOUBLE, v INT, ordem INT")
    got = selection.keep_last(df.repartition(8), ["k"], ["ordem"])
    assert sorted(r.ordem for r in got.collect()) == sorted(want)
    removed = selection.count_removed(df, ["k"]).first().removidos
    assert removed == len(pdf) - len(want)


def test_keep_last_of_few_gives_the_same_rows(spark):
    rng = np.random.default_rng(11)
    pdf = pd.DataFrame({"a": rng.integers(0, 3000, 4000), "b": rng.choice(["x", "y"], 4000), "ordem": np.arange(4000)})
    df = spark.createDataFrame(pdf).withColumn("b", F.when(F.col("ordem") % 50 != 0, F.col("b"))).repartition(8)
    want = rows(selection.keep_last(df, ["a", "b"], ["ordem"]))
    assert rows(selection.keep_last_of_few(df, ["a", "b"], ["ordem"])) == want
    removed = selection.count_removed(df, ["a", "b"]).first()
    assert selection.count_removed_of_few(df, ["a", "b"]).first() == removed


def test_keep_last_of_few_does_not_shuffle_unique_rows(spark):
    df = spark.range(100).withColumn("x", F.col("id") * 2)
    plan = selection.keep_last_of_few(df, ["id"], ["x"])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan and "Exchange hashpartitioning(id" not in plan.split("Union")[0]


def test_keep_last_reduces_before_the_shuffle(frame):
    df = selection.keep_last(frame([(1, 1)], "k INT, o INT"), ["k"], ["o"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Exchange hashpartitioning"):]
    assert "WindowGroupLimit" in below and "Partial" in below


@pytest.mark.parametrize(
    "networks, best",
    [(["Municipal", "Pública"], "Pública"), (["Privada"], "Privada"), ([None, "Federal"], "Federal"),
     (["Total", "Estadual", "Privada"], "Estadual"), ([None], None)],
)
def test_headline(frame, networks, best):
    data = [(2024, "1100015", "2", i, n, float(i)) for i, n in enumerate(networks)]
    df = frame(data, "ano INT, id_municipio STRING, serie STRING, rede INT, rede_label STRING, taxa_alfabetizacao DOUBLE")
    got = selection.pick_network(df).collect()
    assert len(got) == 1 and got[0].rede_label == best


# --- Reshape --------------------------------------------------------------------------


def test_targets_latest_vintage(frame):
    df = frame(
        [(2023, "1100015", 80.0, 82.0), (2024, "1100015", 85.0, 87.0)],
        "ano INT, id_municipio STRING, meta_alfabetizacao_2024 DOUBLE, meta_alfabetizacao_2025 DOUBLE",
    )
    got = reshape.targets_in_force(df, ["id_municipio"])
    assert set(got.columns) == {"id_municipio", "ano_meta", "valor_meta", "ano_referencia"}
    assert rows(got, "ano_meta", "valor_meta", "ano_referencia") == [(2024, 85.0, 2024), (2025, 87.0, 2024)]


def test_targets_without_value_disappear(frame):
    df = frame([(2023, None, 90.0)], "ano INT, meta_alfabetizacao_2024 DOUBLE, meta_alfabetizacao_2025 DOUBLE")
    assert rows(reshape.targets_in_force(df, []), "ano_meta", "valor_meta") == [(2025, 90.0)]


def test_a_missing_revision_keeps_the_older_target(frame):
    df = frame([(2023, 80.0), (2024, None)], "ano INT, meta_alfabetizacao_2024 DOUBLE")
    assert rows(reshape.targets_in_force(df, []), "ano_referencia", "valor_meta") == [(2023, 80.0)]


def test_first_and_last_year(frame):
    df = frame([("a", 2020, 1.0), ("a", 2022, 4.0), ("b", 2021, 9.0), ("b", 2022, 2.0), ("c", 2021, 5.0)],
               "id STRING, ano INT, x DOUBLE")
    got = reshape.first_and_last_year(df, "id", ["x"])
    assert rows(got, "id", "x_inicial", "x_atual") == [("a", 1.0, 4.0), ("b", None, 2.0)]


def test_pivot_years(frame):
    df = frame([("a", 2020, 1.0), ("a", 2020, 3.0), ("a", 2021, 5.0)], "id STRING, ano INT, x DOUBLE")
    assert rows(reshape.pivot_years(df, "id", "x", [2020, 2021, 2022])) == [("a", 2.0, 5.0, None)]


# --- Lookups --------------------------------------------------------------------------


def test_series_by_year(frame):
    facts = frame([(2023, 1), (2024, 2), (2030, 3)], "ano INT, x INT")
    series = frame([(2023, 55.9), (2024, 59.2)], "ano INT, taxa DOUBLE")
    got = lookups.by_year(facts, series, "taxa", "nacional")
    assert rows(got, "ano", "nacional") == [(2023, 55.9), (2024, 59.2), (2030, None)]


def test_dictionary_decode(frame):
    facts = frame([(1, 2), (3, None), (9, 2)], "rede INT, serie INT")
    entries = frame(
        [("uf", "rede", "1", "Federal"), ("uf", "rede", "3", "Municipal"), ("alunos", "rede", "9", "x"), ("uf", "serie", "2", "2º ano")],
        "id_tabela STRING, nome_coluna STRING, chave STRING, valor STRING",
    )
    got = lookups.decode_with_dictionary(facts, entries, "uf", ["rede", "serie"])
    assert got.columns.count("rede") == 1
    assert rows(got, "rede", "serie") == [("Federal", "2º ano"), ("Municipal", None), (None, "2º ano")]


def test_directory_names_do_not_multiply_rows(frame):
    facts = frame([("RS",), ("XX",)], "sigla_uf STRING")
    directory = frame([("RS", "Rio Grande do Sul"), ("RS", "Rio Grande do Sul")], "sigla STRING, nome STRING")
    got = lookups.with_directory_name(facts, directory, "sigla_uf", "sigla", "nome", "sigla_uf_nome")
    assert rows(got, "sigla_uf", "sigla_uf_nome") == [("RS", "Rio Grande do Sul"), ("XX", None)]


def test_broadcast_depends_on_the_measured_size(frame):
    df = frame([("a" * 100, "b")] * 10, "chave STRING, valor STRING")
    hinted = lookups.broadcast_if_small(df, 10 * 140)._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" in hinted
    assert "ResolvedHint" not in lookups.broadcast_if_small(df, 1000)._jdf.queryExecution().analyzed().toString()


def test_orphans_and_domains(frame):
    facts = frame([("SP",), ("zz",), ("zz",), (None,)], "sigla_uf STRING")
    known = frame([("SP",), ("RJ",)], "sigla STRING")
    assert rows(lookups.orphan_keys(facts, "sigla_uf", known, "sigla")) == [("zz",)]
    assert rows(lookups.outside_domain(facts, "sigla_uf", ["SP"])) == [("ZZ",)]


# --- Rankings -------------------------------------------------------------------------


def test_ranked_lists_break_ties_by_key(frame):
    df = frame([("b", 1.0), ("a", 1.0), ("c", 2.0), ("d", None)], "id STRING, x DOUBLE")
    got = ranking.best_and_worst(df, "x", "id", 2)
    assert rows(got, "lista", "posicao", "id") == [
        ("melhores", 1, "c"), ("melhores", 2, "a"), ("piores", 1, "a"), ("piores", 2, "b")]


# --- Profiles -------------------------------------------------------------------------

QUIET = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


@QUIET
@given(st.lists(st.floats(-1e6, 1e6), min_size=1, max_size=60))
def test_median_equals_numpy(spark, values):
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "x DOUBLE")
    assert profile.exact_median(df, "x").first().mediana == pytest.approx(float(np.median(values)), rel=1e-12, abs=1e-12)


@pytest.mark.parametrize(
    "n, accuracy, most",
    [(9999, 10_000, 10**6), (20_001, 1000, 100), (50_000, 200, 1000), (5000, 10_000, 3), (50_000, 100, 2), (30_000, 1000, 10)],
)
def test_median_of_many_skewed_values(spark, n, accuracy, most):
    rng = np.random.default_rng(n)
    values = np.where(rng.random(n) < 0.35, 7.0, rng.lognormal(2, 3, n))
    df = spark.createDataFrame(pd.DataFrame({"x": values})).repartition(8)
    assert profile.exact_median(df, "x", accuracy, most).first().mediana == float(np.median(values))


def test_median_next_to_a_dominant_value(spark):
    values = np.concatenate([np.full(20_000, 5.0), np.arange(6, 20_006, dtype=float)])
    df = spark.createDataFrame(pd.DataFrame({"x": values})).repartition(8)
    assert profile.exact_median(df, "x", 500, 10).first().mediana == 5.5


@pytest.mark.parametrize("most", [100_000, 50])
def test_median_reads_its_input_twice(spark, most):
    """Counted row by row on the way from the source, whatever is left to be searched afterwards."""
    read = spark.sparkContext.accumulator(0)

    def counting(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    rng = np.random.default_rng(9)
    values = rng.normal(size=60_000)
    df = spark.createDataFrame(pd.DataFrame({"x": values})).repartition(8).mapInArrow(counting, "x double")
    assert profile.exact_median(df, "x", most=most).first().mediana == float(np.median(values))
    assert read.value == 2 * len(values)


def test_median_of_infinities_and_ties(frame):
    inf = float("inf")
    df = frame([(-inf,), (-inf,), (1.0,), (inf,), (inf,), (inf,)], "x DOUBLE")
    assert profile.exact_median(df, "x").first().mediana == inf
    assert profile.exact_median(frame([(-inf,), (2.0,), (2.0,), (2.0,), (inf,)], "x DOUBLE"), "x").first().mediana == 2.0


def test_median_of_nothing(frame):
    assert profile.exact_median(frame([(None,)], "x DOUBLE"), "x").first().mediana is None


@QUIET
@given(st.lists(st.floats(-1e3, 1e3), min_size=1, max_size=60))
def test_range_histogram_equals_numpy(spark, values):
    got = profile.range_histogram(spark.createDataFrame([(v,) for v in values], "x DOUBLE"), "x", 30)
    want, _ = np.histogram(values, bins=30)
    assert [r.contagem for r in got.orderBy("faixa").collect()] == list(want)


def test_fixed_histogram_equals_numpy(spark):
    rng = np.random.default_rng(3)
    values = np.concatenate([rng.uniform(500, 980, 3000), [560.0, 580.0, 919.999, 920.0, 920.1, 559.9]])
    df = spark.createDataFrame(pd.DataFrame({"x": values}))
    got = profile.fixed_histogram(df, "x", 560, 920, 20).orderBy("faixa_min").collect()
    want, edges = np.histogram(values, bins=np.arange(560, 921, 20))
    assert [r.contagem for r in got] == list(want)
    assert [r.faixa_min for r in got] == list(edges[:-1])


def test_value_counts_with_listed_order(frame):
    df = frame([("a",), ("a",), ("b",), (None,)], "x STRING")
    got = profile.value_counts(df, "x", ["z", "b", "a"], digits=3).orderBy("ordem")
    assert [tuple(r) for r in got.collect()] == [("z", 0, None, None), ("b", 1, 1, 0.333), ("a", 2, 2, 0.667)]


def test_correlation_is_pairwise_complete(spark):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"a": rng.normal(size=300), "b": rng.normal(size=300), "c": rng.normal(size=300)})
    pdf.loc[::7, "b"] = None
    pdf.loc[::5, "c"] = None
    df = spark.createDataFrame([tuple(None if pd.isna(x) else float(x) for x in r) for r in pdf.to_numpy()],
                               "a DOUBLE, b DOUBLE, c DOUBLE")
    want = pdf.corr()
    for r in profile.correlation_matrix(df, ["a", "b", "c"]).collect():
        assert r.correlacao == pytest.approx(want.loc[r.variavel_a, r.variavel_b])


def test_null_profile(frame):
    df = frame([(1, None), (2, None), (3, "x")], "a INT, b STRING")
    assert rows(profile.null_profile(df)) == [("b", 2, 66.7)]


def test_table_profile(frame):
    df = frame([(1, None), (1, None), (1, None), (2, "x")], "a INT, b STRING")
    got = profile.table_profile(df, "t").first().asDict()
    assert got == {"tabela": "t", "registros": 4, "colunas": 2, "nulos_total": 3, "pct_nulos": 37.5, "duplicatas": 2}


def test_profile_of_an_empty_table(frame):
    got = profile.table_profile(frame([], "a INT"), "t").first()
    assert (got.registros, got.nulos_total, got.pct_nulos, got.duplicatas) == (0, 0, 0.0, 0)


def test_seeded_sample_is_repeatable(spark):
    df = spark.range(1000).withColumn("x", F.col("id") * 2)
    one = profile.seeded_sample(df, ["id"], 42, 5).collect()
    two = profile.seeded_sample(df.repartition(7), ["id"], 42, 5).collect()
    assert one == two and len(one) == 5
    assert one != profile.seeded_sample(df, ["id"], 43, 5).collect()
