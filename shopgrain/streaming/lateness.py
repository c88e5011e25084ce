"""An append sink that counts the rows of each micro-batch, and those of them that came late."""

from __future__ import annotations

from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from shopgrain.plans.monitoring import SUCCESS

COUNTS = "rows BIGINT, late_rows BIGINT, mark TIMESTAMP, written_at TIMESTAMP, batch BIGINT"


def start_counted(
    rows: DataFrame, path: str, checkpoint: str, time: str, counts: str, *,
    delay: str = "24 hours", every: str | None = None,
) -> StreamingQuery:
    """Append a stream below ``path`` and, below ``counts``, one row for each micro-batch: its rows, those whose
    ``time`` is more than ``delay`` behind the mark, and the mark after it (the largest time so far).

    A batch is held against the mark of the batches before it, as a watermark is, but its late rows are
    written like the others: a watermark without state drops nothing and counts nothing. Rows are counted
    while they are written (``observe``). Both folders are named by the batch id and replaced by a replay,
    which finds the same earlier mark; so nothing is written or counted twice. A NULL time is not late.
    """
    spark = rows.sparkSession

    def write(batch: DataFrame, number: int) -> None:
        mark = read_counts(spark, counts).filter(F.col("batch") < number).agg(F.max("mark")).first()[0]
        before = F.lit(mark).cast("timestamp")
        late = F.col(time) < before - F.expr(f"INTERVAL {delay}")
        seen = _observed(
            batch, lambda df: df.write.mode("overwrite").parquet(f"{path}/batch={number:012d}"),
            {"rows": F.count(F.lit(1)), "late_rows": F.count_if(late), "newest": F.max(time)},
        )
        row = [(seen["rows"], seen["late_rows"], seen["newest"])]
        spark.createDataFrame(row, "rows BIGINT, late_rows BIGINT, newest TIMESTAMP").select(
            "rows", "late_rows", F.greatest(before, "newest").alias("mark"),
            F.current_timestamp().alias("written_at"),
        ).write.mode("overwrite").parquet(f"{counts}/batch={number:012d}")

    writer = (
        rows.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(write)
    )
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def _observed(df: DataFrame, write: Callable[[DataFrame], None], counted: dict) -> dict:
    seen = Observation()
    write(df.observe(seen, *[c.alias(name) for name, c in counted.items()]))
    try:
        return seen.get
    except Py4JJavaError:
        if df.isEmpty():  # without any row the plan may have lost the counters
            return {"rows": 0, "late_rows": 0, "newest": None}
        raise


def _folder(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not root.getFileSystem(spark._jsc.hadoopConfiguration()).exists(root):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def read_counts(spark: SparkSession, counts: str) -> DataFrame:
    """What ``start_counted`` has counted, one row for each micro-batch."""
    return _folder(spark, counts, StructType.fromDDL(COUNTS))


def read_counted(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The rows that ``start_counted`` has written, with their ``batch``."""
    return _folder(spark, path, StructType(list(schema.fields)).add("batch", "long"))


def late_events(spark: SparkSession, counts: str, run_id: str, module: str) -> DataFrame:
    """The counts as audit events of a run: one for the rows of a batch, one (``<module>_late``) for the late
    ones. Append them to the audit table that ``run_report`` reads."""
    found = read_counts(spark, counts)

    def event(name: str, number: str) -> DataFrame:
        return found.select(
            F.lit(run_id).alias("run_id"), F.col("written_at").alias("timestamp"), F.lit(name).alias("module"),
            F.lit(SUCCESS).alias("status"), F.col(number).cast("string").alias("records_processed"),
            F.lit(None).cast("string").alias("error"), F.lit(0.0).alias("execution_time_seconds"),
        )

    return event(module, "rows").unionByName(event(f"{module}_late", "late_rows"))
