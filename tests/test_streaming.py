import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from degraus.plans import gold, silver
from degraus.sources.alerts import read_alerts
from degraus.spec import REQUIRED_KEYS, TOPIC_INDICATORS, TOPIC_TARGETS
from degraus.streaming import events as ev


def indicator(**changes):
    event = {
        "evento": "atualizacao_indicador", "timestamp": "2024-05-01T10:00:00.500000", "id_municipio": " 4300001",
        "sigla_uf": "rs", "ano": 2024, "indicador_alfabetizacao": 61.5, "total_alunos_avaliados": 100,
        "ponto_corte_saeb": 743, "fonte": "teste",
    }
    event.update(changes)
    return json.dumps({k: v for k, v in event.items() if v != "DROP"})


def target(**changes):
    event = {
        "evento": "atualizacao_meta", "timestamp": "2024-05-01T10:00:00", "sigla_uf": "SP", "ano": 2024,
        "meta_percentual": 80.0, "revisao": True, "fonte": "teste",
    }
    event.update(changes)
    return json.dumps({k: v for k, v in event.items() if v != "DROP"})


@pytest.fixture
def folders(tmp_path):
    found = {TOPIC_INDICATORS: tmp_path / "in" / "indicadores", TOPIC_TARGETS: tmp_path / "in" / "metas"}
    for f in found.values():
        f.mkdir(parents=True)
    return found


def put(folder: Path, name: str, lines):
    (folder / name).write_text("\n".join(lines) + "\n", encoding="utf-8")


def ingest(spark, folders, tmp_path, **kw):
    stream = ev.read_event_files(spark, {t: str(f) for t, f in folders.items()}, kw.pop("files_per_batch", None))
    return ev.ingest_available(
        stream, str(tmp_path / "bronze"), str(tmp_path / "checkpoint"), str(tmp_path / "alertas"), **kw)


def test_split_counts_and_alert(spark, folders, tmp_path):
    put(folders[TOPIC_INDICATORS], "a.json", [
        indicator(), indicator(indicador_alfabetizacao=None), indicator(fonte="DROP", ano="DROP"), "{not json", "",
        indicator(timestamp="ontem"),
    ])
    put(folders[TOPIC_TARGETS], "b.json", [target(), target(revisao="DROP")])
    totals = ingest(spark, folders, tmp_path)
    assert (totals.processed, totals.invalid) == (4, 4)
    rejected = {
        (r.topico, r.campos_ausentes): r.evento_bruto
        for r in spark.read.parquet(str(tmp_path / "bronze/streaming_rejeitados")).collect()
    }
    everything = ",".join(REQUIRED_KEYS[TOPIC_INDICATORS])
    assert set(rejected) == {
        (TOPIC_INDICATORS, "ano,fonte"), (TOPIC_INDICATORS, everything), (TOPIC_TARGETS, "revisao")}
    stored = spark.read.parquet(str(tmp_path / "bronze/streaming_indicadores"))
    assert stored.count() == 3 and stored.where("indicador_alfabetizacao is null").count() == 1 and "valor" in stored.columns
    assert {str(r.data) for r in stored.collect()} == {"2024-05-01", "None"}
    alert = read_alerts(spark, str(tmp_path / "alertas")).collect()
    assert [a.origem for a in alert] == ["streaming.consumer"]
    assert json.loads(alert[0].contexto) == {"total_processados": 4, "total_invalidos": 4}


def test_no_alert_without_rejects_and_restart_reads_only_new_files(spark, folders, tmp_path):
    put(folders[TOPIC_TARGETS], "a.json", [target()])
    assert ingest(spark, folders, tmp_path).processed == 1
    put(folders[TOPIC_TARGETS], "b.json", [target(sigla_uf="RJ"), target(sigla_uf="MG")])
    assert ingest(spark, folders, tmp_path).processed == 2
    assert spark.read.parquet(str(tmp_path / "bronze/streaming_metas")).count() == 3
    assert read_alerts(spark, str(tmp_path / "alertas")).count() == 0


def test_a_replayed_batch_replaces_its_rows(spark, folders, tmp_path):
    put(folders[TOPIC_TARGETS], "a.json", [target(), target(sigla_uf="RJ")])
    ingest(spark, folders, tmp_path)
    # The checkpoint is lost after the batch was written: the batch runs again.
    stream = ev.read_event_files(spark, {t: str(f) for t, f in folders.items()})
    ev.ingest_available(stream, str(tmp_path / "bronze"), str(tmp_path / "checkpoint2"))
    assert spark.read.parquet(str(tmp_path / "bronze/streaming_metas")).count() == 2


def test_no_cell_of_an_event_is_lost(spark, folders, tmp_path):
    odd = json.loads(target(ano="2024", meta_percentual="61.5", revisao=0)) | {"extra": "x"}
    put(folders[TOPIC_TARGETS], "a.json", [json.dumps(odd), target(sigla_uf="RJ", ano=2024.0)])
    ingest(spark, folders, tmp_path)
    stored = spark.read.parquet(str(tmp_path / "bronze/streaming_metas"))
    assert {json.loads(r.valor).get("extra") for r in stored.collect()} == {"x", None}
    got = {r.sigla_uf: (r.ano, r.meta_percentual, r.revisao) for r in silver.target_events(stored).collect()}
    assert got == {"SP": (2024, 61.5, False), "RJ": (2024, 80.0, True)}


def test_a_batch_replayed_another_day_replaces_its_rejects(spark, folders, tmp_path, monkeypatch):
    put(folders[TOPIC_TARGETS], "a.json", [target(revisao="DROP"), target(sigla_uf="RJ")])
    for day in ("2024-05-01T23:59:59", "2024-05-02T00:00:01"):
        monkeypatch.setattr(ev, "now_text", lambda day=day: day)
        stream = ev.read_event_files(spark, {t: str(f) for t, f in folders.items()})
        ev.ingest_available(stream, str(tmp_path / "bronze"), str(tmp_path / f"checkpoint-{day[8:10]}"))
    rejected = spark.read.parquet(str(tmp_path / "bronze/streaming_rejeitados")).collect()
    assert [r.timestamp_rejeicao for r in rejected] == ["2024-05-02T00:00:01"]


def test_the_later_of_two_streams_counts(spark, folders, tmp_path, monkeypatch):
    for name, when, value in (("eventos", "2024-05-02T08:00:00", 2.0), ("a_novo", "2024-05-03T08:00:00", 3.0)):
        put(folders[TOPIC_TARGETS], f"{name}.json", [target(meta_percentual=value)])
        monkeypatch.setattr(ev, "now_text", lambda when=when: when)
        stream = ev.read_event_files(spark, {t: str(f) for t, f in folders.items()})
        ev.ingest_available(stream, str(tmp_path / "bronze"), str(tmp_path / f"checkpoint-{name}"), name=name)
        (folders[TOPIC_TARGETS] / f"{name}.json").unlink()
    goals = silver.target_events(spark.read.parquet(str(tmp_path / "bronze/streaming_metas")))
    assert [r.meta_percentual for r in goals.collect()] == [3.0]


def test_small_batches_give_the_same_rows(spark, folders, tmp_path):
    for i in range(4):
        put(folders[TOPIC_TARGETS], f"{i}.json", [target(ano=2020 + i), target(ano=2020 + i, revisao="DROP")])
    totals = ingest(spark, folders, tmp_path, files_per_batch=1)
    assert (totals.processed, totals.invalid) == (4, 4)
    rows = spark.read.parquet(str(tmp_path / "bronze/streaming_metas"))
    assert rows.select("lote").distinct().count() == 4


def test_unknown_topic_is_kept_as_rejected(frame):
    checked = ev.check_events(frame([("outro", "{}")], "topico STRING, valor STRING"))
    assert [r.campos_ausentes for r in ev.rejected_events(checked).collect()] == ["topico"]


def test_deduplicated_events_and_monitoring(spark, folders, tmp_path):
    put(folders[TOPIC_INDICATORS], "a.json", [
        indicator(indicador_alfabetizacao=1.0), indicator(indicador_alfabetizacao=2.0),
        indicator(timestamp="2024-05-01T10:00:10.500000"), indicator(id_municipio="9", timestamp="2024-05-01T10:00:05"),
    ])
    put(folders[TOPIC_TARGETS], "b.json", [target()])
    ingest(spark, folders, tmp_path)
    cities = silver.indicator_events(spark.read.parquet(str(tmp_path / "bronze/streaming_indicadores")))
    assert cities.count() == 3
    first = cities.where(F.col("id_municipio") == "4300001").orderBy("timestamp").first()
    assert (first.indicador_alfabetizacao, first.sigla_uf) == (2.0, "RS")
    goals = silver.target_events(spark.read.parquet(str(tmp_path / "bronze/streaming_metas")))
    got = {r.topico: r for r in gold.stream_monitoring(cities, goals).collect()}
    i, m = got["indicadores"], got["metas"]
    assert (i.total_eventos, i.cobertura_distinta, i.janela_segundos, i.eventos_por_segundo) == (3, 2, 10.0, 0.3)
    assert (m.total_eventos, m.janela_segundos, m.eventos_por_segundo) == (1, 0.0, None)
    assert gold.stream_monitoring(None, None) is None
