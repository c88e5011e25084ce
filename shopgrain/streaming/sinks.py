"""Append sinks for streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

# How often each feed looks for new files when it runs continuously.
TRIGGERS = {
    "orders": "5 minutes",
    "customers": "10 minutes",
    "products": "5 minutes",
    "order_items": "3 minutes",
    "payments": "5 minutes",
}


def start_append(
    df: DataFrame,
    path: str,
    checkpoint: str,
    *,
    every: str | None = None,
    partition_by: Sequence[str] = (),
    table: str | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Append a stream to parquet files; a restart with the same ``checkpoint`` goes on where the
    last run stopped. ``every`` keeps it running; without it the query takes what has landed, in
    rate-limited batches, and ends."""
    writer = (
        df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if name:
        writer = writer.queryName(name)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    if table:
        return writer.option("path", path).toTable(table)
    return writer.start(path)


def run_to_end(query: StreamingQuery) -> StreamingQuery:
    """Wait for an available-now query; its error, if any, is raised here."""
    query.awaitTermination()
    return query
