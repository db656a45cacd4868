import json
from datetime import datetime, timedelta, timezone
from pathlib import Path

from degraus.sources.alerts import raise_alert, read_alerts


def test_one_json_line_with_upper_cased_level(spark, tmp_path):
    log = str(tmp_path / "alertas")
    alert = raise_alert(spark, log, "error", "teste.origem", "algo falhou", {"tabela": "x"})
    assert alert["nivel"] == "ERROR"
    lines = [line for f in Path(log).rglob("*.json") for line in f.read_text("utf-8").splitlines()]
    assert len(lines) == 1
    stored = json.loads(lines[0])
    assert (stored["origem"], stored["mensagem"]) == ("teste.origem", "algo falhou")
    assert json.loads(stored["contexto"]) == {"tabela": "x"}


def test_alerts_accumulate(spark, tmp_path):
    log = str(tmp_path / "alertas")
    raise_alert(spark, log, "WARNING", "a", "1")
    raise_alert(spark, log, "ERROR", "b", "2")
    assert sorted(r.nivel for r in read_alerts(spark, log).collect()) == ["ERROR", "WARNING"]


def test_absent_log_is_empty(spark, tmp_path):
    assert read_alerts(spark, str(tmp_path / "nada")).count() == 0


def test_read_back_since(spark, tmp_path):
    log = str(tmp_path / "alertas")
    raise_alert(spark, log, "CRITICAL", "x", "falha grave")
    now = datetime.now(timezone.utc).replace(tzinfo=None)
    assert [r.nivel for r in read_alerts(spark, log, now - timedelta(hours=1)).collect()] == ["CRITICAL"]
    assert read_alerts(spark, log, now + timedelta(hours=1)).count() == 0
