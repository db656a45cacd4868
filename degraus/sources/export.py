"""Small result tables as JSON."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame


def export_json(views: Mapping[str, DataFrame], folder: str) -> None:
    """One JSON-lines folder per view. Views are aggregates of bounded size, hence one file each."""
    for name, view in views.items():
        view.coalesce(1).write.mode("overwrite").option("ignoreNullFields", "false").json(f"{folder.rstrip('/')}/{name}")
