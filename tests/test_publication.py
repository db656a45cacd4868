"""Publication by manifest, declared schemas, and rules measured while a table is written."""

import pytest
from lake import FILES, write_sources

from degraus.plans import run as r
from degraus.quality import checks, layers
from degraus.quality.layers import table_report, validate_layer, write_measured
from degraus.sources import files, snapshots, tables
from degraus.sources.snapshots import PublicationConflict, PublishedLayer
from degraus.sources.tables import Layer, SchemaConflict
from degraus.spec import GOLD_PARTITIONS, RULES, Rule

PLAN = {"a": ("ano",), "b": ()}


def make(spark, tmp_path, changes=None):
    return r.Lake(spark, str(tmp_path / "lake"), write_sources(tmp_path / "raw", changes))


def seen(layer):
    return {t: None if layer.read(t) is None else sorted(map(tuple, layer.read(t).collect())) for t in PLAN}


def put(layer, frame, version, a, b):
    candidate = layer.candidate(version)
    candidate.write(frame(a, "x INT, ano INT"), "a", ["ano"])
    if b is not None:
        candidate.write(frame(b, "y STRING"), "b")
    return candidate


# --- Manifest -----------------------------------------------------------------------------


def test_all_tables_become_visible_at_once(spark, frame, tmp_path, monkeypatch):
    gold = PublishedLayer(spark, str(tmp_path), "gold")
    assert seen(gold) == {"a": None, "b": None}
    first = put(gold, frame, "v1", [(1, 2023), (2, 2024)], [("one",)])
    assert seen(gold) == {"a": None, "b": None}
    assert gold.publish(first, PLAN, "v1") == 1
    before = {"a": [(1, 2023), (2, 2024)], "b": [("one",)]}
    assert seen(gold) == before
    # A failure between two tables, and one while the manifest is written: the old version stays readable as a whole.
    second = put(gold, frame, "v2", [(3, 2024)], None)
    assert seen(gold) == before
    monkeypatch.setattr(snapshots, "write_new", lambda *a: (_ for _ in ()).throw(OSError("store is gone")))
    with pytest.raises(OSError):
        gold.publish(second, PLAN, "v2")
    monkeypatch.undo()
    assert seen(gold) == before and gold.numbers() == [1]


def test_partitions_that_a_version_lacks_are_taken_over(spark, frame, tmp_path):
    gold = PublishedLayer(spark, str(tmp_path), "gold")
    gold.publish(put(gold, frame, "v1", [(1, 2023), (2, 2024)], [("one",)]), PLAN, "v1")
    gold.publish(put(gold, frame, "v2", [(3, 2024)], None), PLAN, "v2")
    assert seen(gold) == {"a": [(1, 2023), (3, 2024)], "b": [("one",)]}
    folders = gold.manifest()["tabelas"]["a"]["particoes"]
    assert folders == {"ano=2023": "gold_versoes/v1/a", "ano=2024": "gold_versoes/v2/a"}
    plan = gold.read("a").where("ano = 2024")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ano" in plan
    whole = PublishedLayer(spark, str(tmp_path), "gold", full_refresh=True)
    whole.publish(put(whole, frame, "v3", [(9, 2025)], None), PLAN, "v3")
    assert seen(gold) == {"a": [(9, 2025)], "b": [("one",)]}


def test_versions_with_other_columns_are_read_together(spark, frame, tmp_path):
    gold = PublishedLayer(spark, str(tmp_path), "gold")
    gold.publish(put(gold, frame, "v1", [(1, 2023)], None), PLAN, "v1")
    candidate = gold.candidate("v2")
    candidate.write(frame([(2, "new", 2024)], "x INT, z STRING, ano INT"), "a", ["ano"])
    gold.publish(candidate, PLAN, "v2")
    assert {(x.x, x.z, x.ano) for x in gold.read("a").collect()} == {(1, None, 2023), (2, "new", 2024)}


def test_one_of_two_publishers_wins(spark, frame, tmp_path, monkeypatch):
    gold = PublishedLayer(spark, str(tmp_path), "gold")
    mine, theirs = (put(gold, frame, v, [(n, 2024)], None) for n, v in ((1, "v1"), (2, "v2")))
    numbers = gold.numbers()
    gold.publish(theirs, PLAN, "v2")
    monkeypatch.setattr(PublishedLayer, "numbers", lambda self: numbers)  # read before the other one published
    with pytest.raises(PublicationConflict):
        gold.publish(mine, PLAN, "v1")
    monkeypatch.undo()
    assert seen(gold)["a"] == [(2, 2024)]


def test_older_versions_come_back_and_expire(spark, frame, tmp_path):
    gold = PublishedLayer(spark, str(tmp_path), "gold")
    for i in (1, 2, 3):
        gold.publish(put(gold, frame, f"v{i}", [(i, 2020 + i)], [(str(i),)]), PLAN, f"v{i}")
    put(gold, frame, "v4", [(4, 2024)], None)
    assert gold.restore(1) == 4
    assert seen(gold) == {"a": [(1, 2021)], "b": [("1",)]}
    with pytest.raises(FileNotFoundError):
        gold.restore(77)
    # Manifests 3 and 4 stay; v2 still holds a partition that 3 names; v4 is being written.
    assert gold.expire(keep=2, under_way=["v4"]) == []
    assert gold.numbers() == [3, 4]
    gold.restore(4)
    assert gold.expire(keep=1, under_way=["v4"]) == ["v2", "v3"]
    assert seen(gold) == {"a": [(1, 2021)], "b": [("1",)]}
    assert gold.expire(keep=1) == ["v4"]


def test_a_run_publishes_without_copying(spark, tmp_path):
    lake = make(spark, tmp_path)
    first, second = r.run(lake), r.run(lake, years=[2024])
    assert first.published and second.published and lake.gold.numbers() == [1, 2]
    manifest = lake.gold.manifest()["tabelas"]["indicador_alfabetizacao_municipio"]["particoes"]
    assert {p: f.split("/")[1] for p, f in manifest.items()} == {"ano=2023": first.run, "ano=2024": second.run}
    # Gold is written once: nothing but manifests lies in its folder.
    assert [n for n, _ in files.names_in(spark, lake.gold.folder)] == []
    assert set(GOLD_PARTITIONS) - {"monitoramento_streaming"} == set(lake.gold.manifest()["tabelas"])


# --- Files ------------------------------------------------------------------------------------


def test_small_files(spark, tmp_path):
    path = f"{tmp_path}/deep/er/x.json"
    assert files.read_text(spark, path) is None
    assert files.write_new(spark, path, "é") and not files.write_new(spark, path, "other")
    assert files.read_text(spark, path) == "é"
    files.write_text(spark, path, "y")
    assert files.read_text(spark, path) == "y"
    assert files.names_in(spark, f"{tmp_path}/deep/er") == [("x.json", False)]
    assert files.names_in(spark, f"{tmp_path}/none") == []
    assert files.rename(spark, f"{tmp_path}/deep", f"{tmp_path}/a/b") and not files.rename(spark, f"{tmp_path}/a", f"{tmp_path}/a/b")


# --- Declared schemas ------------------------------------------------------------------------------


def test_reads_use_the_declared_columns(spark, frame, tmp_path, monkeypatch):
    layer = Layer(spark, str(tmp_path), "bronze")
    layer.write(frame([(1, 2023)], "x INT, ano INT"), "t", ["ano"])
    layer.write(frame([("new", 2, 2024)], "novo STRING, x INT, ano INT"), "t", ["ano"])

    def no_inference(*a, **k):
        raise AssertionError("footers are opened to find the columns")

    monkeypatch.setattr(tables, "read_if_present", no_inference)
    got = layer.read("t")
    assert dict(got.dtypes) == {"x": "int", "novo": "string", "ano": "int"}
    assert {(x.x, x.novo, x.ano) for x in got.collect()} == {(1, None, 2023), (2, "new", 2024)}
    assert Layer(spark, str(tmp_path), "bronze").schema("t") == layer.schema("t")
    with pytest.raises(SchemaConflict):
        layer.write(frame([("text", 2024)], "x STRING, ano INT"), "t", ["ano"])
    assert layer.read("t").count() == 2  # the conflict shows before anything is replaced
    layer.write(frame([("text", 2024)], "x STRING, ano INT"), "t", ["ano"], full_refresh=True)
    assert dict(layer.read("t").dtypes) == {"x": "string", "ano": "int"}


def test_a_table_stored_by_other_means_is_still_read(spark, frame, tmp_path):
    layer = Layer(spark, str(tmp_path), "bronze")
    frame([(1, 2023)], "x INT, ano INT").write.partitionBy("ano").parquet(layer.path("t"))
    assert layer.schema("t") is None and layer.read("t").count() == 1
    assert layer.read("absent") is None


# --- Rules measured while writing -----------------------------------------------------------------


def test_the_gates_scan_no_table_for_measured_rules(spark, tmp_path, monkeypatch):
    lake = make(spark, tmp_path)

    def scan(*a, **k):
        raise AssertionError("a table is scanned for rules that its write has measured")

    monkeypatch.setattr(checks, "column_checks", scan)
    result = r.run(lake)
    assert result.published
    counted = {t: v["registros"] for verdict in result.verdicts.values() for t, v in verdict.tables.items()}
    assert counted["alunos"] == 5 and counted["diretorio_uf"] == 2


def test_measured_reports_equal_scans(spark, tmp_path):
    """Nulls beyond the limit, numbers out of range and texts that are no numbers."""
    rows = [*FILES["idhm_municipio"], '2010,4300009,X,"1,5",abc,,"0,1"', "2010,,Y,,,,"]
    lake = make(spark, tmp_path, {"idhm_municipio": rows})
    r.ingest_bronze(lake)
    assert "idhm_municipio" in lake.bronze.measured
    for table, rule in RULES["bronze"].items():
        measured = lake.bronze.measured.get(table)
        if measured:
            reports = [table_report(lake.bronze, table, rule, m) for m in (measured, None)]
            got, want = (sorted(map(str, x.collect())) for x in reports)
            assert got == want
    verdict = validate_layer(lake.bronze, measured=lake.bronze.measured)
    assert {a["tipo"] for a in verdict.tables["idhm_municipio"]["alertas"]} == {
        "NULOS_ACIMA_LIMITE", "DOMINIO_NUMERICO_INVALIDO", "VALOR_ILEGIVEL"}


def test_a_write_of_some_partitions_measures_nothing_about_the_others(spark, frame, tmp_path):
    layer = Layer(spark, str(tmp_path), "bronze")
    rule = Rule(("x",), ("x",), 0.0)
    assert write_measured(layer, frame([(1, 2023), (None, 2024)], "x INT, ano INT"), "t", ["ano"], rule)["nulos_0"] == 1
    assert write_measured(layer, frame([(5, 2023)], "x INT, ano INT"), "t", ["ano"], rule) is None
    assert layer.measured == {}
    report = {x.tipo: x.medida for x in table_report(layer, "t", rule, layer.measured.get("t")).collect()}
    assert report["NULOS_ACIMA_LIMITE"] == 1
    layer.write(frame([(5, 2023)], "x INT, ano INT"), "u", ["ano"])
    assert "u" not in layer.measured


def test_an_empty_table_does_not_wait_for_measures(spark, frame, tmp_path, monkeypatch):
    monkeypatch.setattr(layers, "WAIT", 1.0)
    layer = Layer(spark, str(tmp_path), "bronze")
    write_measured(layer, frame([(1,)], "x INT").where("false"), "t", (), Rule(("x",), ("x",), 0.0))
    report = table_report(layer, "t", Rule(("x",), ("x",), 0.0), layer.measured.get("t"))
    assert not [x for x in report.collect() if x.falhou]


def test_a_run_reports_removed_rows_and_unknown_codes(spark, tmp_path):
    rows = [*FILES["indicador_municipio"], "2024,4300001,2,5,77.0,730.0", "2024,3500003,2,9,48.0,720.0"]
    lake = make(spark, tmp_path, {"indicador_municipio": rows})
    r.ingest_bronze(lake)
    result = r.RunResult("x")
    r._step(lake, "silver", r.build_silver(lake), result)
    r._removed_rows(lake, result)
    assert result.tables["silver.indicador_municipio"]["duplicatas_removidas"] == 1
    assert result.tables["silver.indicador_municipio"]["codigos_sem_rotulo"] == [9]
    assert result.tables["silver.alunos"]["duplicatas_removidas"] == 0
