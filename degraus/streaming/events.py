"""Structured Streaming ingestion of JSON events.

A stream is a DataFrame with ``topico`` and ``valor`` (JSON text). An event is valid when all keys
its topic requires are present, even with a null value. Valid events go to one table per topic,
the others to a table that keeps the text and the reason.

A stored event keeps its text (``valor``) next to the required keys, which stay text as well: numbers written as
text, other number formats and keys nobody asked for are not lost, and Silver does the casts.

Valid events are written under (data, fluxo, lote) by the day of the event, rejected ones under (fluxo, lote), so a batch
replayed after a failure replaces its own rows, whenever it runs. The name of a stream must therefore be its own.
``recebido_em``, the time of the batch, tells which of two streams brought an event later.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from degraus.sources.alerts import now_text, raise_alert
from degraus.sources.tables import Layer
from degraus.spec import EVENT_TABLES, REJECTED_TABLE, REQUIRED_KEYS


def missing_keys(topic: Column, value: Column, required: Mapping[str, Sequence[str]] = REQUIRED_KEYS) -> Column:
    """Required keys the JSON text lacks; unreadable text lacks them all, an unknown topic its name."""
    present = F.coalesce(F.json_object_keys(value), F.array().cast("array<string>"))
    branch = None
    for name, keys in required.items():
        lacking = F.array_except(F.array(*map(F.lit, keys)), present)
        branch = (F if branch is None else branch).when(topic == name, lacking)
    return branch.otherwise(F.array(F.lit("topico")))


def check_events(events: DataFrame, required: Mapping[str, Sequence[str]] = REQUIRED_KEYS) -> DataFrame:
    """Add ``campos_ausentes``, an array that is empty for a valid event."""
    return events.withColumn("campos_ausentes", missing_keys(F.col("topico"), F.col("valor"), required))


def valid_events(
    checked: DataFrame, topic: str, required: Mapping[str, Sequence[str]] = REQUIRED_KEYS
) -> DataFrame:
    """Valid events of a topic: required keys as text, and all columns of the stream, ``valor`` too."""
    parsed = F.from_json("valor", ", ".join(f"`{key}` STRING" for key in required[topic]))
    extra = [c for c in checked.columns if c not in ("topico", "campos_ausentes")]
    return (
        checked.where((F.col("topico") == topic) & (F.size("campos_ausentes") == 0))
        .select(parsed.alias("evento"), *extra)
        .select("evento.*", *extra)
    )


def rejected_events(checked: DataFrame) -> DataFrame:
    """Invalid events with the missing keys as a comma list."""
    extra = [c for c in checked.columns if c not in ("topico", "valor", "campos_ausentes")]
    return checked.where(F.size("campos_ausentes") > 0).select(
        "topico",
        F.col("valor").alias("evento_bruto"),
        F.concat_ws(",", "campos_ausentes").alias("campos_ausentes"),
        *extra,
    )


def event_counts(checked: DataFrame) -> DataFrame:
    """Stored and rejected events per topic."""
    return checked.groupBy("topico").agg(
        F.count_if(F.size("campos_ausentes") == 0).alias("processados"),
        F.count_if(F.size("campos_ausentes") > 0).alias("invalidos"),
    )


def read_event_files(spark: SparkSession, folders: Mapping[str, str], files_per_batch: int | None = None) -> DataFrame:
    """JSON-lines folders, one per topic, as a stream."""
    stream = None
    for topic, folder in folders.items():
        reader = spark.readStream.format("text")
        if files_per_batch:
            reader = reader.option("maxFilesPerTrigger", files_per_batch)
        lines = reader.load(folder).select(F.lit(topic).alias("topico"), F.col("value").alias("valor"))
        stream = lines if stream is None else stream.union(lines)
    return stream


@dataclass
class StreamTotals:
    """What a run has stored and rejected so far."""

    processed: int = 0
    invalid: int = 0


def start_ingestion(
    events: DataFrame,
    bronze: str,
    checkpoint: str,
    name: str = "eventos",
    interval: str | None = None,
    required: Mapping[str, Sequence[str]] = REQUIRED_KEYS,
    tables: Mapping[str, str] = EVENT_TABLES,
) -> tuple[StreamingQuery, StreamTotals]:
    """Start the stream. Without ``interval`` it works off what is there and stops."""
    totals = StreamTotals()
    root, _, layer_name = bronze.rstrip("/").rpartition("/")
    layer = Layer(events.sparkSession, root, layer_name)

    def append(df: DataFrame, table: str, *parts: str) -> None:
        layer.declare(table, df.schema)
        # The rebalance joins small pieces and splits large ones by their bytes.
        (
            df.hint("rebalance", *parts)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*parts)
            .parquet(layer.path(table))
        )

    def store(batch: DataFrame, batch_id: int) -> None:
        checked = (
            check_events(batch, required)
            .withColumn("linha", F.monotonically_increasing_id())
            .withColumn("fluxo", F.lit(name))
            .withColumn("lote", F.lit(batch_id).cast("bigint"))
            .withColumn("recebido_em", F.lit(now_text()))
            .persist()
        )
        try:
            counts = event_counts(checked).collect()  # one row per topic
            stored = {row["topico"]: row["processados"] for row in counts}
            for topic, table in tables.items():
                if stored.get(topic):
                    day = F.to_date(F.try_to_timestamp("timestamp"))
                    append(valid_events(checked, topic, required).withColumn("data", day), table, "data", "fluxo", "lote")
            invalid = sum(row["invalidos"] for row in counts)
            if invalid:
                rejected = rejected_events(checked).withColumnRenamed("recebido_em", "timestamp_rejeicao")
                append(rejected, REJECTED_TABLE, "fluxo", "lote")
            totals.processed += sum(row["processados"] for row in counts)
            totals.invalid += invalid
        finally:
            checked.unpersist()

    writer = events.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start(), totals


def ingest_available(
    events: DataFrame, bronze: str, checkpoint: str, alert_log: str | None = None, **options
) -> StreamTotals:
    """Work off all events that are there; an alert is raised when any was rejected."""
    query, totals = start_ingestion(events, bronze, checkpoint, **options)
    query.awaitTermination()
    if totals.invalid and alert_log:
        raise_alert(
            events.sparkSession, alert_log, "WARNING", "streaming.consumer",
            f"{totals.invalid} evento(s) inválido(s) rejeitados",
            {"total_processados": totals.processed, "total_invalidos": totals.invalid},
        )
    return totals
