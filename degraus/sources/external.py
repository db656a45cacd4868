"""Sources outside the lake: a warehouse table and broker topics. Both need a connector on the
class path; the calls only declare the source."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_warehouse(
    spark: SparkSession,
    connector: str,
    table: str,
    years: Sequence[int] | None = None,
    year: str = "ano",
    option: str = "table",
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """A warehouse table through any Spark connector; the year filter is pushed down by it."""
    reader = spark.read.format(connector).options(**dict(options or {}))
    df = reader.load(table) if option == "path" else reader.option(option, table).load()
    if years and year in df.columns:
        df = df.where(F.col(year).isin(list(years)))
    return df


def read_broker(
    spark: SparkSession, servers: str, topics: Sequence[str], per_batch: int | None = None, at_least: int | None = None,
    wait: str | None = None,
) -> DataFrame:
    """Topics as a stream of (topico, valor), from the earliest offset; offsets live in the
    checkpoint of the query, so they advance only with the written batch.

    A batch takes ``per_batch`` events at most. With ``at_least`` it starts as soon as so many events wait, or ``wait``
    (such as ``3 seconds``) after the last one, whichever comes first.
    """
    options = {
        "kafka.bootstrap.servers": servers, "subscribe": ",".join(topics), "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": per_batch, "minOffsetsPerTrigger": at_least,
        "maxTriggerDelay": wait if at_least else None,
    }
    reader = spark.readStream.format("kafka").options(**{k: v for k, v in options.items() if v is not None})
    return reader.load().select(F.col("topic").alias("topico"), F.col("value").cast("string").alias("valor"))


class SourceError(Exception):
    """No source of a table could be read, though one is there."""


def first_available(*attempts, on_failure: Callable[[str, Exception], None] = lambda tag, error: None):
    """Try steps in order: ``(tag, callable)``. Returns (result, tag) of the first that works.

    A step whose source does not exist raises ``FileNotFoundError``. If none works, the error is that only when no
    source exists; otherwise it is a ``SourceError``. ``on_failure`` hears of every source that exists but fails.
    """
    failures, broken = [], False
    for tag, attempt in attempts:
        try:
            return attempt(), tag
        except FileNotFoundError as error:
            failures.append(f"{tag}: {error}")
        except Exception as error:  # connectors raise errors of their own
            failures.append(f"{tag}: {error}")
            broken = True
            on_failure(tag, error)
    text = "no source could be read: " + " | ".join(failures)
    raise SourceError(text) if broken else FileNotFoundError(text)
