"""Append-only alert log in JSON lines."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from degraus.sources.tables import AnalysisException

ALERT_SCHEMA = "timestamp STRING, nivel STRING, origem STRING, mensagem STRING, contexto STRING"


def now_text() -> str:
    """UTC time as text without a zone."""
    return datetime.now(timezone.utc).replace(tzinfo=None).isoformat()


def raise_alert(
    spark: SparkSession, log: str, level: str, origin: str, message: str, context: Mapping | None = None
) -> dict:
    """Append one alert in a folder of its own, so steps that fail at once do not meet; the context is JSON text."""
    alert = {
        "timestamp": now_text(),
        "nivel": level.upper(),
        "origem": origin,
        "mensagem": message,
        "contexto": json.dumps(dict(context or {}), ensure_ascii=False, default=str),
    }
    spark.createDataFrame([tuple(alert.values())], ALERT_SCHEMA).coalesce(1).write.json(
        f"{log.rstrip('/')}/{uuid.uuid4().hex}")
    return alert


def read_alerts(spark: SparkSession, log: str, since: datetime | None = None) -> DataFrame:
    """All alerts, or those not older than ``since``; an absent log is empty."""
    try:
        alerts = spark.read.schema(ALERT_SCHEMA).option("recursiveFileLookup", True).json(log)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], ALERT_SCHEMA)
    if since is not None:
        alerts = alerts.where(F.try_to_timestamp("timestamp") >= F.lit(since))
    return alerts
