"""The dashboard of a lake: all views and the quality roll-up, as JSON folders."""

from __future__ import annotations

from pyspark.sql import DataFrame

from degraus.plans.run import Lake
from degraus.plans.views import dashboard
from degraus.quality.layers import quality_view
from degraus.sources.export import export_json


def report(lake: Lake) -> dict[str, DataFrame]:
    """All views by name, ``qualidade`` among them: tables checked, fine and failing per layer and in total."""
    views = dashboard(lake.gold.read, lake.silver.read)
    quality = quality_view([lake.bronze, lake.silver, lake.gold])
    return views if quality is None else {**views, "qualidade": quality}


def export_report(lake: Lake, folder: str) -> list[str]:
    """Write the report, one folder of JSON lines per view, and return the names."""
    views = report(lake)
    export_json(views, folder)
    return sorted(views)
