"""Volume, coverage and time span of the ingested events."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from degraus.functions import round_even


def monitor_topics(topics: Sequence[tuple[str, DataFrame, str]]) -> DataFrame:
    """One row per topic that has events. ``topics`` holds (name, events, coverage column).

    The distinct count is taken in two steps by Spark, on (topic, entity) first, so a topic with
    most of the events is not counted by a single task.
    """
    parts = [
        df.select(F.lit(name).alias("topico"), F.col(entity).cast("string").alias("entidade"), "timestamp")
        for name, df, entity in topics
    ]
    events = reduce(DataFrame.unionByName, parts)
    summary = events.groupBy("topico").agg(
        F.count("*").alias("total_eventos"),
        F.count_distinct("entidade").alias("cobertura_distinta"),
        F.min("timestamp").alias("primeiro_evento"),
        F.max("timestamp").alias("ultimo_evento"),
    )
    seconds = (F.unix_micros("ultimo_evento") - F.unix_micros("primeiro_evento")) / F.lit(1e6)
    return summary.withColumn("janela_segundos", seconds).withColumn(
        "eventos_por_segundo",
        round_even(F.try_divide(F.col("total_eventos").cast("double"), F.col("janela_segundos")), 3),
    )
