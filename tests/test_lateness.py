"""Late rows counted by micro-batch, replays included."""

import shutil

from helpers import rows
from pyspark.sql import functions as F

from shopgrain.plans.monitoring import run_report
from shopgrain.streaming.lateness import late_events, read_counted, read_counts, start_counted
from shopgrain.streaming.sinks import run_to_end

SCHEMA = "id BIGINT, at TIMESTAMP"


def load(spark, base, data):
    df = spark.createDataFrame(data, "id BIGINT, t STRING").select("id", F.col("t").cast("timestamp").alias("at"))
    df.coalesce(1).write.mode("append").parquet(f"{base}/in")
    run(spark, base)


def run(spark, base):
    raw = spark.readStream.schema(SCHEMA).parquet(f"{base}/in")
    run_to_end(start_counted(raw, f"{base}/out", f"{base}/checkpoint", "at", f"{base}/counts"))


def test_late_rows_are_written_and_counted(spark, tmp_path):
    base = str(tmp_path)
    load(spark, base, [(1, "2020-01-05"), (2, "2020-01-01"), (3, None)])  # nothing before: nothing late
    load(spark, base, [(4, "2020-01-04"), (5, "2020-01-03 23:59:59"), (6, "2020-01-09")])
    load(spark, base, [(7, "2020-01-05"), (8, None)])
    want = [(0, 3, 0, "2020-01-05 00:00:00"), (1, 3, 1, "2020-01-09 00:00:00"), (2, 2, 1, "2020-01-09 00:00:00")]
    got = lambda: rows(
        read_counts(spark, f"{base}/counts").withColumn("mark", F.col("mark").cast("string")),
        "batch", "rows", "late_rows", "mark",
    )
    assert got() == want
    schema = spark.read.parquet(f"{base}/in").schema
    out = lambda: rows(read_counted(spark, f"{base}/out", schema), "id", "batch")
    written = [(1, 0), (2, 0), (3, 0), (4, 1), (5, 1), (6, 1), (7, 2), (8, 2)]
    assert out() == written
    # The last batch is not committed: it is replayed and leaves what it left before.
    for name in ("2", ".2.crc"):
        (tmp_path / "checkpoint" / "commits" / name).unlink()
    shutil.rmtree(f"{base}/counts/batch=000000000002")
    run(spark, base)
    assert got() == want and out() == written
    events = late_events(spark, f"{base}/counts", "r1", "orders")
    assert events.filter("module = 'orders_late'").agg(F.sum(F.col("records_processed").cast("int"))).first()[0] == 2
    assert run_report(events).first()["successful_modules"] == 6


def test_no_rows_and_no_counts(spark, tmp_path):
    assert read_counts(spark, f"{tmp_path}/none").count() == 0
    assert read_counted(spark, f"{tmp_path}/none", spark.range(1).schema).columns == ["id", "batch"]
