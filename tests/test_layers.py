import pytest
from lake import FILES, write_sources

from degraus.operators import lookups
from degraus.plans import run as r
from degraus.plans import silver, views
from degraus.plans.report import export_report
from degraus.quality.layers import quality_view, validate_layer
from degraus.sources.alerts import read_alerts
from degraus.sources.csv import ORIGIN, read_csv
from degraus.sources.tables import Layer
from degraus.spec import SOURCES


def make(spark, tmp_path, changes=None):
    return r.Lake(spark, str(tmp_path / "lake"), write_sources(tmp_path / "raw", changes))


@pytest.fixture(scope="module")
def done(spark, tmp_path_factory):
    lake = make(spark, tmp_path_factory.mktemp("done"))
    return lake, r.run(lake)


def test_run_publishes(done):
    lake, result = done
    assert result.stopped_at is None and result.published
    assert {v.passed for v in result.verdicts.values()} == {True}
    assert result.tables["gold.monitoramento_streaming"]["status"] == "pulado"
    assert result.tables["bronze.alunos"] == {"status": "sucesso", "fonte": "raw", "registros": 5}
    assert read_alerts(lake.spark, lake.alert_log).count() == 0


def test_silver_results(done):
    lake, _ = done
    rows = {(x.ano, x.id_municipio, x.rede): x for x in lake.silver.read("indicador_municipio").collect()}
    assert len(rows) == 7 and rows[2024, "4300001", 5].taxa_alfabetizacao == 52.5
    assert rows[2023, "4300001", 5].rede_label == "Pública"
    assert "_origem" not in lake.silver.read("indicador_municipio").columns


def test_duplicates_keep_the_last_row_of_the_file(spark, tmp_path):
    rows = [*FILES["indicador_municipio"], "2024,4300001,2,5,77.0,730.0", "2024, 4300001,2,5,78.0,730.0"]
    lake = make(spark, tmp_path, {"indicador_municipio": rows})
    r.ingest_bronze(lake)
    got = silver.city_results(lake.bronze.read("indicador_municipio"))
    assert got.count() == 7
    assert got.where("ano = 2024 and id_municipio = '4300001' and rede = 5").first().taxa_alfabetizacao == 78.0


def test_integration(done):
    lake, _ = done
    rows = {(x.ano, x.id_municipio): x for x in lake.silver.read("alfabetizacao_integrado").collect()}
    assert set(rows) == {(2023, "4300001"), (2024, "4300001"), (2024, "3500002"), (2024, "3500003"), (2023, "3500002")}
    bage = rows[2024, "4300001"]
    assert (bage.rede_label, bage.taxa_alfabetizacao, bage.taxa_alfabetizacao_municipal) == ("Pública", 52.5, 64.36)
    assert bage.meta_alfabetizacao_municipal == 64.0 and bage.atingiu_meta_municipal is True
    assert (bage.nome_municipio, bage.sigla_uf, bage.idhm) == ("Bagé", "RS", 0.74)
    assert rows[2024, "3500002"].atingiu_meta_municipal is False
    assert rows[2024, "3500003"].atingiu_meta_municipal is None and rows[2024, "3500003"].idhm is None
    assert silver.coverage(lake.silver.read("alfabetizacao_integrado")).first().asDict() == {
        "registros": 5, "com_meta": 2, "com_idhm": 4}


def test_gold_tables(done):
    lake, _ = done
    city = {(x.ano, x.id_municipio): x for x in lake.gold.read("indicador_alfabetizacao_municipio").collect()}
    assert city[2024, "3500002"].faixa_risco == "Meta próxima/atingida"
    assert city[2024, "4300001"].indicador_nacional == 59.2
    state = {x.sigla_uf: x for x in lake.gold.read("comparacao_metas_resultados").collect()}
    assert (state["RS"].gap, state["RS"].atingiu_meta, state["RS"].pct_municipios_meta_atingida) == (-21.53, False, 100.0)
    assert (state["SP"].gap, state["SP"].total_municipios, state["SP"].municipios_avaliados_meta) == (0.6, 2, 1)
    moves = {(x.nivel, x.referencia, x.ano): x.variacao_yoy for x in lake.gold.read("evolucao_temporal").collect()}
    assert moves["brasil", "BR", 2024] == 3.3 and moves["brasil", "BR", 2025] == 6.8
    assert moves["uf", "RS", 2024] == -18.76 and moves["uf", "RS", 2023] is None


def test_national_view(done):
    """Published figures of the national series."""
    lake, _ = done
    got = {name: view.collect() for name, view in views.dashboard(lake.gold.read, lake.silver.read).items()}
    assert [(x.ano, x.indicador, x.variacao_yoy) for x in got["brasil_serie"]] == [
        (2023, 55.9, None), (2024, 59.2, 3.3), (2025, 66.0, 6.8)]
    assert [(x.ano, x.meta) for x in got["brasil_serie_meta"]] == [
        (2024, 60.0), (2025, 64.0), (2026, 67.0), (2027, 71.0), (2028, 74.0), (2029, 77.0), (2030, 80.0)]
    assert got["brasil_headline"][0].asDict() == {
        "ano_atual": 2025, "indicador_atual": 66.0, "variacao_yoy": 6.8, "meta_final": 80.0, "gap_meta_final": 14.0,
        "delta_periodo": 10.1, "ano_inicial": 2023}
    lists = {(x.lista, x.posicao): x for x in got["uf_listas"]}
    assert lists["mais_pioraram", 1].sigla_uf == "RS" and lists["mais_pioraram", 1].delta == -18.76
    assert got["municipio_meta"][0].asDict() == {
        "ano": 2024, "total_municipios_avaliados": 3, "total_com_meta": 2, "atingiram": 1, "pct_atingiram": 50.0}
    assert {(x.lista, x.posicao): x.id_municipio for x in got["municipio_variacao"]} == {
        ("mais_melhoraram", 1): "3500002", ("mais_melhoraram", 2): "4300001",
        ("mais_pioraram", 1): "4300001", ("mais_pioraram", 2): "3500002"}
    assert [(x.ano, x.total_avaliados, x.pct_alfabetizado, x.proficiencia_media) for x in got["aluno_historico"]] == [
        (2023, 2, 50.0, 725.25), (2024, 2, 100.0, 752.5)]
    assert sum(x.contagem for x in got["aluno_distribuicao"]) == 2
    assert [x.rede for x in got["aluno_por_rede"]] == ["Estadual", "Municipal"]
    assert got["aluno_uf_listas"] == []  # too few students


def test_quality_view(done):
    lake, _ = done
    got = {x.camada: tuple(x)[1:] for x in quality_view([lake.bronze, lake.silver, lake.gold]).collect()}
    assert got == {"bronze": (9, 9, 0, 0), "silver": (11, 11, 0, 0), "gold": (3, 3, 0, 0), "total": (23, 23, 0, 0)}


def test_the_report_has_the_quality_of_the_layers(done, tmp_path):
    lake, _ = done
    names = export_report(lake, str(tmp_path / "painel"))
    assert {"brasil_headline", "uf_listas", "aluno_por_rede", "qualidade"} <= set(names)
    rows = {x.camada: x for x in lake.spark.read.json(str(tmp_path / "painel/qualidade")).collect()}
    assert (rows["total"].tabelas_verificadas, rows["total"].tabelas_ok, rows["gold"].total_alertas) == (23, 23, 0)
    assert lake.spark.read.json(str(tmp_path / "painel/brasil_headline")).first().gap_meta_final == 14.0


def test_a_one_year_run_keeps_the_history(spark, tmp_path):
    lake = make(spark, tmp_path)
    assert r.run(lake).published
    result = r.run(lake, years=[2024])
    assert result.published
    moves = {(x.nivel, x.referencia, x.ano): x.variacao_yoy for x in lake.gold.read("evolucao_temporal").collect()}
    assert moves["brasil", "BR", 2023] is None and moves["brasil", "BR", 2024] == 3.3
    assert moves["uf", "RS", 2024] == -18.76
    assert lake.gold.read("indicador_alfabetizacao_municipio").count() == 5


def test_bad_bronze_stops_the_run(spark, tmp_path):
    lake = make(spark, tmp_path, {"diretorio_uf": ["id_uf,sigla,nome,regiao", "43,RS,,Sul"]})
    result = r.run(lake)
    assert result.stopped_at == "gate.bronze" and not result.published
    assert result.verdicts["bronze"].failing == ["diretorio_uf"]
    assert lake.silver.read("indicador_uf") is None
    levels = sorted(a.nivel for a in read_alerts(spark, lake.alert_log).collect())
    assert levels == ["CRITICAL", "WARNING"]


def test_a_missing_mandatory_source_is_an_error(spark, tmp_path):
    lake = make(spark, tmp_path, {"meta_municipio": None})
    result = r.run(lake)
    assert result.stopped_at == "bronze" and result.tables["bronze.meta_municipio"]["status"] == "erro"


def test_the_warehouse_comes_first_and_falls_back_to_files(spark, frame, tmp_path):
    lake = make(spark, tmp_path)
    lake.warehouse = {"connector": "parquet", "project": str(tmp_path / "projeto"), "table_option": "path"}
    frame([("11", "RO", "Rondônia", "Norte")], "id_uf STRING, sigla STRING, nome STRING, regiao STRING").write.parquet(
        f"{tmp_path}/projeto.br_bd_diretorios_brasil.uf")
    broken = tmp_path / "projeto.br_inep_avaliacao_alfabetizacao.uf"
    broken.mkdir()
    (broken / "x.parquet").write_bytes(b"not parquet")
    results = r.ingest_bronze(lake)
    assert results["diretorio_uf"] == {"status": "sucesso", "fonte": "warehouse"}
    assert lake.bronze.read("diretorio_uf").first().sigla == "RO"
    assert results["indicador_uf"]["fonte"] == results["alunos"]["fonte"] == "raw"
    assert lake.bronze.read("indicador_uf").count() == 5


def test_a_run_from_the_warehouse_publishes(spark, tmp_path, done):
    files = make(spark, tmp_path)
    lake = r.Lake(spark, str(tmp_path / "armazem"), str(tmp_path / "nothing"),
                  {"connector": "parquet", "project": str(tmp_path / "projeto"), "table_option": "path"})
    for source in SOURCES.values():
        if source.warehouse:  # everything as text, in order: types are the reader's work
            rows = read_csv(spark, f"{files.raw}/{source.file}").drop(ORIGIN).coalesce(1)
            rows.write.parquet(f"{tmp_path}/projeto.{source.warehouse}")
    result = r.run(lake)
    assert result.published and result.tables["bronze.alunos"]["fonte"] == "warehouse"
    name = "comparacao_metas_resultados"
    want, got = (sorted(map(str, x.gold.read(name).drop("dt_processamento").collect())) for x in (done[0], lake))
    assert got == want


def test_a_corrupt_optional_source_is_an_error_with_alerts(spark, tmp_path):
    lake = make(spark, tmp_path, {"idhm_municipio": None})
    broken = tmp_path / "raw" / SOURCES["idhm_municipio"].file
    broken.mkdir()
    (broken / "_metadata.crc").write_bytes(b"x")
    assert r.ingest_bronze(lake)["idhm_municipio"]["status"] == "erro"
    assert read_alerts(spark, lake.alert_log).where("origem = 'bronze.idhm_municipio'").count() == 2


def test_an_odd_year_and_integration_errors_do_not_end_the_run(spark, frame, tmp_path, monkeypatch):
    facts = frame([(2024, 1.0)], "ano INT, x DOUBLE")
    series = frame([(2024, 2.0), (202400, 3.0), (None, 4.0)], "ano INT, v DOUBLE")
    assert lookups.by_year(facts, series, "v", "nacional").first().nacional == 2.0
    lake = make(spark, tmp_path)
    r.ingest_bronze(lake)
    monkeypatch.setattr(r.s, "integrate", lambda *tables: frame([(1,)], "a INT").select("missing"))
    assert r.build_silver(lake)["alfabetizacao_integrado"]["status"] == "erro"


def test_a_full_refresh_drops_years_that_vanished(spark, tmp_path):
    lake = make(spark, tmp_path)
    r.ingest_bronze(lake)
    only_2024 = [row for row in FILES["indicador_municipio"] if not row.startswith("2023")]
    for full, years in ((False, {2023, 2024}), (True, {2024})):
        again = r.Lake(spark, lake.root, write_sources(tmp_path / f"raw-{full}", {"indicador_municipio": only_2024}), full_refresh=full)
        r.ingest_bronze(again)
        assert {x.ano for x in again.bronze.read("indicador_municipio").collect()} == years
    with pytest.raises(ValueError):
        r.run(again, [2024])


def test_a_missing_optional_source_is_skipped(spark, tmp_path):
    lake = make(spark, tmp_path, {"idhm_municipio": None})
    result = r.run(lake)
    assert result.published and result.tables["bronze.idhm_municipio"]["status"] == "ausente_na_bronze"
    assert "idhm" not in lake.gold.read("indicador_alfabetizacao_municipio").columns
    got = views.city_rankings(lake.gold.read("indicador_alfabetizacao_municipio")).first()
    assert got.idhm is None


def test_a_rejected_gold_leaves_the_published_one(spark, tmp_path):
    lake = make(spark, tmp_path)
    assert r.run(lake).published
    before = sorted(map(tuple, lake.gold.read("comparacao_metas_resultados").drop("dt_processamento").collect()))
    candidate = Layer(spark, f"{lake.root}/gold_candidata", "teste")
    assert r.build_gold(lake, candidate)["evolucao_temporal"]["status"] == "sucesso"
    broken = candidate.read("comparacao_metas_resultados").selectExpr(
        "ano", "sigla_uf", "taxa_alfabetizacao", "cast(null as double) as meta_alfabetizacao")
    spoiled = Layer(spark, f"{lake.root}/gold_candidata", "ruim")
    for name in ("indicador_alfabetizacao_municipio", "evolucao_temporal"):
        spoiled.write(candidate.read(name), name)
    spoiled.write(broken, "comparacao_metas_resultados")
    outcome = r.RunResult("ruim")
    assert not r.publish(lake, spoiled, outcome)
    assert outcome.stopped_at == "gate.gold"
    kept = Layer(spark, f"{lake.root}/gold_rejeitada", "ruim").read("comparacao_metas_resultados")
    assert kept.count() == 2
    after = sorted(map(tuple, lake.gold.read("comparacao_metas_resultados").drop("dt_processamento").collect()))
    assert [x[:6] for x in after] == [x[:6] for x in before]


def test_two_series_give_one_comparison_per_city(frame):
    results = frame(
        [(2024, "1", "2", 3, "Municipal", 50.0), (2024, "1", "5", 3, "Municipal", 70.0)],
        "ano INT, id_municipio STRING, serie STRING, rede INT, rede_label STRING, taxa_alfabetizacao DOUBLE")
    targets = frame([("1", "Municipal", 2024, 60.0)], "id_municipio STRING, rede STRING, ano_meta INT, valor_meta DOUBLE")
    directory = frame([("1", "SP")], "id_municipio STRING, sigla_uf STRING")
    got = silver.integrate(results, directory, targets).collect()
    assert len(got) == 1 and got[0].gap_meta_municipal == -10.0


def test_a_null_result_with_a_target_counts_as_not_reached(frame):
    results = frame([(2024, "1", "2", 3, "Municipal", None)],
                    "ano INT, id_municipio STRING, serie STRING, rede INT, rede_label STRING, taxa_alfabetizacao DOUBLE")
    targets = frame([("1", "Municipal", 2024, 60.0)], "id_municipio STRING, rede STRING, ano_meta INT, valor_meta DOUBLE")
    got = silver.integrate(results, frame([("1", "SP")], "id_municipio STRING, sigla_uf STRING"), targets).first()
    assert got.gap_meta_municipal is None and got.atingiu_meta_municipal is False


def test_no_comparison_without_a_result_in_scope(frame):
    results = frame([(2024, "1", "2", 5, "Pública", 70.0), (2024, "1", "2", 9, None, 80.0)],
                    "ano INT, id_municipio STRING, serie STRING, rede INT, rede_label STRING, taxa_alfabetizacao DOUBLE")
    targets = frame([("1", "Municipal", 2024, 60.0)], "id_municipio STRING, rede STRING, ano_meta INT, valor_meta DOUBLE")
    got = silver.integrate(results, frame([("1", "SP")], "id_municipio STRING, sigla_uf STRING"), targets).first()
    assert got.rede_label == "Pública" and got.taxa_alfabetizacao == 70.0
    assert got.meta_alfabetizacao_municipal is None and got.atingiu_meta_municipal is None


def test_missing_mandatory_table_fails_a_layer(spark, tmp_path):
    verdict = validate_layer(Layer(spark, str(tmp_path), "gold"))
    assert not verdict.passed and "evolucao_temporal" in verdict.missing_mandatory
    assert "monitoramento_streaming" not in verdict.missing_mandatory
