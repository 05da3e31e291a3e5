"""Extension: the error history fed by a stream of attempts.

The model itself is batch only; this is the append of the history for jobs that receive attempts as they end. Rows delivered
again under one history_id within the delay are dropped, with state that the watermark bounds; errors are stored as keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from vericorpus.operators.history import distinct_keys

STREAM_SCHEMA = "history_id bigint, contract_hash string, run_id string, attempt int, spec_snapshot string, errors array<string>, created_at timestamp, ingested_at timestamp"


def attempts(stream: DataFrame, delay: str = "1 day") -> DataFrame:
    """A stream of attempts (STREAM_SCHEMA) as history rows, each once. Rows without a time of arrival count as arrived now."""
    arrived = stream.withColumn("ingested_at", F.coalesce(F.col("ingested_at").cast("timestamp"), F.current_timestamp()))
    once = arrived.withWatermark("ingested_at", delay).dropDuplicatesWithinWatermark(["history_id"])
    return once.select(
        "history_id", "contract_hash", "run_id", "attempt", "spec_snapshot", distinct_keys("errors").alias("errors"), F.coalesce(F.col("created_at").cast("timestamp"), F.col("ingested_at")).alias("created_at"), "ingested_at"
    )


def ingest(stream: DataFrame, path: str, checkpoint: str, delay: str = "1 day", once: bool = True) -> StreamingQuery:
    """Appends the stream's attempts to the history at a path; with ``once`` what is there now, else without end."""
    writer = attempts(stream, delay).writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="30 seconds")).start()
