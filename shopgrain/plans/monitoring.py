"""Audit events of table runs and the report over them."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from shopgrain.schemas import table_schema

# Fixed values.
SUCCESS, FAILED, PARTIAL_FAILURE = "SUCCESS", "FAILED", "PARTIAL_FAILURE"
PIPELINE = "PIPELINE"  # the event a failed run logs about itself, beside the failed module's


def audit_events(spark: SparkSession, rows: Iterable[dict | tuple | Row]) -> DataFrame:
    """Events as a table; counts are text ("Streaming" is one), errors may be NULL."""
    return spark.createDataFrame(list(rows), table_schema("pipeline_audit_log"))


def run_report(audit: DataFrame, run_id: str | None = None) -> DataFrame:
    """Start, end, module counts and outcome of one run, or of every run. The run's own event is no
    module, but a run that reports its failure there is not a success."""
    events = audit if run_id is None else audit.filter(F.col("run_id") == run_id)
    module = F.coalesce(F.col("module") != PIPELINE, F.lit(True))
    # An event's time and its seconds since the start give the start of the run.
    started = F.col("timestamp") - F.make_dt_interval(
        secs=F.col("execution_time_seconds").cast("decimal(18,6)")
    )
    return (
        events.groupBy("run_id")
        .agg(
            F.min(started).alias("start_time"),
            F.max("timestamp").alias("end_time"),
            F.count_if(module & (F.col("status") == SUCCESS)).alias("ok"),
            F.count_if(module & (F.col("status") == FAILED)).alias("bad"),
            F.count_if(F.col("status") == FAILED).alias("failures"),
        )
        .select(
            F.col("run_id").alias("pipeline_run_id"),
            "start_time",
            "end_time",
            (
                (F.unix_micros("end_time") - F.unix_micros("start_time")).cast("double") / 1e6
            ).alias("duration_seconds"),
            F.col("ok").cast("int").alias("successful_modules"),
            F.col("bad").cast("int").alias("failed_modules"),
            F.when(F.col("failures") == 0, SUCCESS).otherwise(PARTIAL_FAILURE).alias("status"),
        )
    )
