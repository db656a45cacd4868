"""The gated run: Bronze, check, Silver, check, Gold staged, check, publish or withdraw."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone
from functools import partial

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from degraus.functions import try_cast_columns
from degraus.plans import gold as g
from degraus.plans import silver as s
from degraus.quality.layers import Verdict, validate_layer, write_measured
from degraus.session import at_once
from degraus.sources.alerts import now_text, raise_alert
from degraus.sources.csv import ORIGIN, arrival, read_csv
from degraus.sources.external import SourceError, first_available, read_warehouse
from degraus.sources.files import path_exists, read_text, rename, write_text
from degraus.sources.snapshots import PublishedLayer
from degraus.sources.tables import Layer
from degraus.spec import EVENT_TABLES, GOLD_PARTITIONS, RULES, SILVER_PARTITIONS, SOURCES, SourceTable
from degraus.streaming.history import EventHistory, read_history


class BronzeLayer(Layer):
    """Source tables, and event tables with their compacted days."""

    def read(self, table: str) -> DataFrame | None:
        if table in EVENT_TABLES.values():
            return read_history(self.spark, self.folder, table)
        return super().read(table)


@dataclass
class Lake:
    """Folders of one installation."""

    spark: SparkSession
    root: str
    raw: str
    warehouse: Mapping[str, str] | None = None  # connector, project, further options
    full_refresh: bool = False  # replace whole tables, not only the partitions that the sources hold

    def __post_init__(self):
        self.root = self.root.rstrip("/")
        self.bronze = BronzeLayer(self.spark, self.root, "bronze", self.full_refresh)
        self.silver = Layer(self.spark, self.root, "silver", self.full_refresh)
        self.gold = PublishedLayer(self.spark, self.root, "gold", self.full_refresh)
        self.alert_log = f"{self.root}/monitoramento/alertas"

    def alert(self, level: str, origin: str, message: str, context: Mapping | None = None) -> None:
        raise_alert(self.spark, self.alert_log, level, origin, message, context)


@dataclass
class RunResult:
    run: str
    published: bool = False
    stopped_at: str | None = None
    tables: dict[str, dict] = field(default_factory=dict)
    verdicts: dict[str, Verdict] = field(default_factory=dict)


def stamped(df: DataFrame, stamp: str) -> DataFrame:
    """Processing time of the run, the same for every row."""
    return df.withColumn("dt_processamento", F.lit(stamp))


def _from_warehouse(lake: Lake, source: SourceTable, years):
    def attempt():
        if not lake.warehouse or not source.warehouse:
            raise FileNotFoundError("no warehouse configured")
        options = dict(lake.warehouse)
        connector, project = options.pop("connector"), options.pop("project", "")
        option = options.pop("table_option", "table")
        table = f"{project}.{source.warehouse}" if project else source.warehouse
        wanted = years if "ano" in source.partitions else None
        try:
            df = read_warehouse(lake.spark, connector, table, wanted, option=option, options=options)
        except AnalysisException as error:
            if error.getCondition() in ("PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND"):
                raise FileNotFoundError(table) from error
            raise
        # Typed and numbered like rows of a file, so Silver does not see where they came from.
        return try_cast_columns(df, source.types).withColumn(ORIGIN, arrival(F.lit(table), F.lit(0)))

    return attempt


def _ingest(lake: Lake, name: str, years: Sequence[int] | None) -> dict:
    """Store a source table from the warehouse; if that cannot be opened or read, from its CSV file.

    Only a source that does not exist is absent; one that exists and fails is an error, of an optional table too.
    """
    source = SOURCES[name]
    path = f"{lake.raw.rstrip('/')}/{source.file}"

    def from_file() -> DataFrame:
        if not path_exists(lake.spark, path):
            raise FileNotFoundError(path)
        return read_csv(lake.spark, path, source.types, years, utf8=source.utf8, multiline=source.multiline)

    def failed(tag: str, error: Exception) -> None:
        lake.alert("WARNING", f"bronze.{name}", f"Fonte não lida: {error}", {"fonte": tag})

    openers = {"warehouse": _from_warehouse(lake, source, years), "raw": from_file}

    def store(opener: Callable[[], DataFrame]) -> None:
        write_measured(lake.bronze, opener(), name, source.partitions, RULES["bronze"][name])

    try:
        steps = ((tag, partial(store, opener)) for tag, opener in openers.items())
        _, origin = first_available(*steps, on_failure=failed)
        return {"status": "sucesso", "fonte": origin}
    except FileNotFoundError as error:
        if not source.mandatory:
            return {"status": "ausente_na_bronze"}
        lake.alert("ERROR", f"bronze.{name}", f"Falha na ingestão: {error}", {"obrigatoria": True})
        return {"status": "erro", "erro": str(error)}
    except SourceError as error:
        lake.alert("ERROR", f"bronze.{name}", f"Falha na ingestão: {error}", {"obrigatoria": source.mandatory})
        return {"status": "erro", "erro": str(error)}


def ingest_bronze(lake: Lake, years: Sequence[int] | None = None) -> dict[str, dict]:
    """Store every source table. A missing optional table is skipped, a missing mandatory one is an error."""
    return at_once({name: partial(_ingest, lake, name, years) for name in SOURCES})


def silver_plan(years: Sequence[int] | None = None) -> dict[str, tuple[str, Callable[[DataFrame], DataFrame]]]:
    """Silver table -> (Bronze table, cleaning function)."""
    return {
        "indicador_municipio": ("indicador_municipio", lambda df: s.city_results(df, years)),
        "indicador_uf": ("indicador_uf", lambda df: s.state_results(df, years)),
        "indicador_brasil": ("meta_brasil", lambda df: s.national_results(df, years)),
        "meta_brasil": ("meta_brasil", s.national_targets),
        "meta_uf": ("meta_uf", s.state_targets),
        "meta_municipio": ("meta_municipio", s.city_targets),
        "diretorio_municipio": ("diretorio_municipio", s.city_directory),
        "diretorio_uf": ("diretorio_uf", s.state_directory),
        "alunos": ("alunos", lambda df: s.students(df, years)),
        "indicador_streaming": ("streaming_indicadores", lambda df: s.indicator_events(df, keep=("data",))),
        "meta_streaming": ("streaming_metas", lambda df: s.target_events(df, keep=("data",))),
        "idhm_municipio": ("idhm_municipio", s.city_hdi),
    }


UNSTAMPED = {"diretorio_municipio", "diretorio_uf"}

#: Silver tables that hold one row per key of one Bronze table, so the difference are the repeated rows that went.
ROW_BY_ROW = ("indicador_municipio", "indicador_uf", "diretorio_municipio", "diretorio_uf", "alunos", "idhm_municipio")


def _removed_rows(lake: Lake, result: RunResult) -> None:
    """Note how many repeated rows each cleaning removed, from what both writes counted."""
    for name in ROW_BY_ROW:
        before, after = lake.bronze.measured.get(name), lake.silver.measured.get(name)
        if before and after and f"silver.{name}" in result.tables:
            result.tables[f"silver.{name}"]["duplicatas_removidas"] = before["registros"] - after["registros"]


def _merge_events(lake: Lake, name: str, source: str, clean: Callable[[DataFrame], DataFrame], stamp: str) -> dict:
    """Clean the days of an event table that changed since the last run, and replace them in Silver.

    Two events with one key have one time and so one day, which is why a day can be cleaned without the others. The days
    and batches that Silver holds are noted after the write; if a run breaks off before that, the next one merges the
    same days again.
    """
    history = EventHistory(lake.spark, lake.bronze.folder, source)
    days = history.days()
    if not days:
        return {"status": "ausente_na_bronze"}
    ledger = f"{lake.silver.folder}/_lotes/{name}.json"
    stored = path_exists(lake.spark, lake.silver.path(name)) and not lake.full_refresh
    text = read_text(lake.spark, ledger) if stored else None
    changed = history.changed(days, json.loads(text) if text else {})
    try:
        if changed:
            df = stamped(clean(history.read(changed)), stamp)
            write_measured(lake.silver, df, name, SILVER_PARTITIONS[name], RULES["silver"][name])
        write_text(lake.spark, ledger, json.dumps(days))
        return {"status": "sucesso", "dias": len(changed)}
    except PySparkException as error:
        lake.alert("ERROR", f"silver.{name}", f"Falha no processamento: {error}")
        return {"status": "erro", "erro": str(error)}


def compact_events(lake: Lake, before: str) -> dict[str, list[str]]:
    """Compact the closed days of all event tables; see ``EventHistory.compact``."""
    return {t: EventHistory(lake.spark, lake.bronze.folder, t).compact(before) for t in EVENT_TABLES.values()}


def _clean(lake: Lake, name: str, source: str, clean: Callable[[DataFrame], DataFrame], stamp: str) -> dict:
    bronze = lake.bronze.read(source)
    if bronze is None:
        return {"status": "ausente_na_bronze"}
    try:
        df = clean(bronze)
        coded = {"rede", "rede_label"} <= set(df.columns)
        unknown = F.when(F.col("rede_label").isNull(), F.col("rede").cast("int")) if coded else None
        measured = write_measured(
            lake.silver, df if name in UNSTAMPED else stamped(df, stamp), name, SILVER_PARTITIONS[name],
            RULES["silver"][name], [F.collect_set(unknown).alias("codigos_sem_rotulo")] if coded else [],
        )
        result = {"status": "sucesso"}
        if measured and measured.get("codigos_sem_rotulo"):
            result["codigos_sem_rotulo"] = sorted(measured["codigos_sem_rotulo"])
            lake.alert("WARNING", f"silver.{name}", "Códigos de rede sem rótulo", {"codigos": result["codigos_sem_rotulo"]})
        return result
    except PySparkException as error:
        lake.alert("ERROR", f"silver.{name}", f"Falha no processamento: {error}")
        return {"status": "erro", "erro": str(error)}


def build_silver(lake: Lake, years: Sequence[int] | None = None, stamp: str | None = None) -> dict[str, dict]:
    """Clean every Bronze table that exists, then integrate if the needed ones do."""
    stamp = stamp or now_text()
    results = at_once({
        name: partial(_merge_events if source in EVENT_TABLES.values() else _clean, lake, name, source, clean, stamp)
        for name, (source, clean) in silver_plan(years).items()
    })
    stored = {name for name, result in results.items() if result["status"] == "sucesso"}
    absent = [t for t in ("indicador_municipio", "diretorio_municipio", "meta_municipio") if t not in stored]
    if absent:
        results["alfabetizacao_integrado"] = {"status": "pulado", "motivo": f"ausentes: {absent}"}
        return results
    name = "alfabetizacao_integrado"
    try:
        integrated = s.integrate(
            lake.silver.read("indicador_municipio").drop("dt_processamento"),
            lake.silver.read("diretorio_municipio"),
            lake.silver.read("meta_municipio"),
            lake.silver.read("idhm_municipio") if "idhm_municipio" in stored else None,
        )
        write_measured(lake.silver, stamped(integrated, stamp), name, SILVER_PARTITIONS[name], RULES["silver"][name])
        results[name] = {"status": "sucesso"}
    except PySparkException as error:
        lake.alert("ERROR", f"silver.{name}", f"Falha na integração: {error}")
        results[name] = {"status": "erro", "erro": str(error)}
    return results


def gold_plan(silver: Callable[[str], DataFrame | None], years: Sequence[int] | None = None):
    """Gold table -> function that builds it, or gives None when there is nothing to build."""
    return {
        "indicador_alfabetizacao_municipio": lambda: g.city_indicator(
            silver("alfabetizacao_integrado"), silver("indicador_brasil"), years),
        "comparacao_metas_resultados": lambda: g.state_comparison(
            silver("indicador_uf"), silver("meta_uf"), silver("alfabetizacao_integrado"), years),
        "evolucao_temporal": lambda: g.evolution(silver("indicador_brasil"), silver("indicador_uf"), years),
        "monitoramento_streaming": lambda: g.stream_monitoring(
            silver("indicador_streaming"), silver("meta_streaming")),
    }


def _build(lake: Lake, target: Layer, name: str, build: Callable[[], DataFrame | None], stamp: str) -> dict:
    try:
        df = build()
        if df is None:
            return {"status": "pulado", "motivo": "sem eventos"}
        write_measured(target, stamped(df, stamp), name, GOLD_PARTITIONS[name], RULES["gold"][name], compact=True)
        return {"status": "sucesso"}
    except (PySparkException, AttributeError) as error:  # AttributeError: a needed table is absent
        lake.alert("ERROR", f"gold.{name}", str(error))
        return {"status": "erro", "erro": str(error)}


def build_gold(
    lake: Lake, target: Layer, years: Sequence[int] | None = None, stamp: str | None = None
) -> dict[str, dict]:
    """Build the Gold tables into ``target``."""
    stamp = stamp or now_text()
    plan = gold_plan(lake.silver.read, years)
    return at_once({name: partial(_build, lake, target, name, build, stamp) for name, build in plan.items()})


def _gate(lake: Lake, layer: Layer, name: str, result: RunResult) -> bool:
    verdict = validate_layer(layer, lake.alert_log, RULES[name], name, layer.measured)
    result.verdicts[name] = verdict
    for table, found in verdict.tables.items():
        if f"{name}.{table}" in result.tables:
            result.tables[f"{name}.{table}"]["registros"] = found["registros"]
    if verdict.passed:
        return True
    result.stopped_at = f"gate.{name}"
    lake.alert(
        "CRITICAL", f"gate.{name}", f"Camada '{name}' não passou no gate de qualidade",
        {"tabelas_com_alerta": verdict.failing, "tabelas_ausentes": verdict.missing_mandatory},
    )
    return False


def _step(lake: Lake, name: str, results: dict[str, dict], result: RunResult) -> bool:
    result.tables.update({f"{name}.{t}": r for t, r in results.items()})
    errors = [t for t, r in results.items() if r["status"] == "erro"]
    if not errors:
        return True
    result.stopped_at = name
    lake.alert("CRITICAL", f"orquestrador.{name}", f"Etapa {name} falhou", {"tabelas": errors})
    return False


def publish(lake: Lake, candidate: Layer, result: RunResult) -> bool:
    """Check a Gold candidate; publish it where it lies, or set it apart and leave the published tables alone."""
    if not _gate(lake, candidate, "gold", result):
        # No reader knows the candidate, so moving it is not seen half done.
        rename(lake.spark, candidate.folder, f"{lake.root}/gold_rejeitada/{result.run}")
        return False
    lake.gold.publish(candidate, GOLD_PARTITIONS, result.run)
    result.published = True
    return True


def run(lake: Lake, years: Sequence[int] | None = None) -> RunResult:
    """All layers with a quality gate behind each.

    Gold is built in ``gold_versoes/<run>``. A candidate that passes is published by one manifest, so readers see all
    of its tables or none; one that fails is kept in ``gold_rejeitada/<run>`` and the published tables stay as they were.
    """
    if years and lake.full_refresh:
        raise ValueError("a full refresh replaces all years and cannot be limited to some")
    run_id = datetime.now(timezone.utc).strftime("%Y%m%d_%H%M%S_") + uuid.uuid4().hex[:8]
    result = RunResult(run_id)
    stamp = now_text()
    if not _step(lake, "bronze", ingest_bronze(lake, years), result):
        return result
    if not _gate(lake, lake.bronze, "bronze", result):
        return result
    if not _step(lake, "silver", build_silver(lake, years, stamp), result):
        return result
    _removed_rows(lake, result)
    if not _gate(lake, lake.silver, "silver", result):
        return result
    candidate = lake.gold.candidate(run_id)
    if not _step(lake, "gold", build_gold(lake, candidate, years, stamp), result):
        return result
    publish(lake, candidate, result)
    return result
