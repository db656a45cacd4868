"""Run the rules over stored layers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import partial, reduce
from threading import Thread

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from degraus.quality.checks import check_table, column_measures, described, roll_up
from degraus.session import at_once
from degraus.sources.alerts import raise_alert
from degraus.sources.tables import Layer
from degraus.spec import RULES, Rule


#: Seconds to wait for what a write has measured. It is there when the write ends, unless Spark found the data to be empty
#: and measured nothing.
WAIT = 3.0


def write_measured(
    layer: Layer, df: DataFrame, table: str, partitions: Sequence[str] = (), rule: Rule | None = None,
    further: Sequence[Column] = (), **options: object,
) -> dict[str, object] | None:
    """Store a table and measure its rule's columns, and ``further`` aggregates, in the same pass.

    The result, also noted in ``layer.measured``, is None if the table holds partitions of earlier writes too, or nothing
    could be measured; then a check has to read it.
    """
    observation = Observation()
    measures = column_measures(df.columns, rule.required, rule.ranges) if rule else [F.count("*").alias("registros")]
    layer.write(df, table, partitions, measures=[*measures, *further], observation=observation, **options)
    found: list[dict] = []
    waiting = Thread(target=lambda: found.append(observation.get), daemon=True)
    waiting.start()
    waiting.join(WAIT)
    if not found or not found[0] or not layer.written_at_once(table):
        return None
    layer.measured[table] = dict(found[0])
    return layer.measured[table]


def table_report(
    layer: Layer, table: str, rule: Rule, measured: Mapping[str, int] | None = None
) -> DataFrame | None:
    """The report of a stored table; None when it is not there."""
    df = layer.read(table)
    return None if df is None else check_table(df, table, rule, layer.name, layer.read, measured)


def layer_report(layer: Layer, rules: Mapping[str, Rule] | None = None) -> DataFrame | None:
    """The reports of a layer in one table; None when nothing is stored."""
    found = [table_report(layer, table, rule) for table, rule in (rules or RULES[layer.name]).items()]
    reports = [r for r in found if r is not None]
    return reduce(DataFrame.unionByName, reports) if reports else None


@dataclass
class Verdict:
    """Outcome of a layer check: table -> (status, rows, failed checks)."""

    tables: dict[str, dict] = field(default_factory=dict)
    missing_mandatory: list[str] = field(default_factory=list)

    @property
    def failing(self) -> list[str]:
        return sorted(t for t, v in self.tables.items() if v["status"] == "ALERTA")

    @property
    def passed(self) -> bool:
        return not self.failing and not self.missing_mandatory


def validate_layer(
    layer: Layer,
    alert_log: str | None = None,
    rules: Mapping[str, Rule] | None = None,
    name: str | None = None,
    measured: Mapping[str, Mapping[str, int] | None] | None = None,
) -> Verdict:
    """Check a layer and raise one alert per failing table. ``measured`` has what the writes of its tables counted.

    A report has one row per rule, so it is collected as a whole. Unlike a table that is
    optional, a missing mandatory table fails the layer.
    """
    name = name or layer.name
    rules = rules or RULES[name]
    verdict = Verdict()

    def lines_of(table: str):
        report = table_report(layer, table, rules[table], (measured or {}).get(table))
        return None if report is None else described(report).collect()

    for table, lines in at_once({table: partial(lines_of, table) for table in rules}).items():
        if lines is None:
            continue
        failed = [line.asDict() for line in lines if line["falhou"]]
        verdict.tables[table] = {
            "status": "ALERTA" if failed else "OK",
            "registros": max((line["registros"] or 0 for line in lines), default=0),
            "alertas": failed,
        }
    for table, rule in rules.items():
        if table not in verdict.tables:
            verdict.tables[table] = {"status": "nao_encontrada", "registros": 0, "alertas": []}
            if rule.mandatory:
                verdict.missing_mandatory.append(table)
    if alert_log:
        for table in verdict.failing:
            found = verdict.tables[table]["alertas"]
            raise_alert(
                layer.spark, alert_log, "WARNING", f"qualidade.{name}.{table}",
                f"{len(found)} alerta(s) de qualidade de dados", {"tipos": [a["tipo"] for a in found]},
            )
    return verdict


def full_report(layers: list[Layer]) -> DataFrame | None:
    """The reports of several layers in one table."""
    reports = [r for r in map(layer_report, layers) if r is not None]
    return reduce(DataFrame.unionByName, reports) if reports else None


def quality_view(layers: list[Layer]) -> DataFrame | None:
    """Dashboard roll-up over all layers."""
    report = full_report(layers)
    return roll_up(report) if report is not None else None
