"""Durable marks: how far each source has been taken into each target."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shopgrain.operators.incremental import high_water_mark, incremental
from shopgrain.session import stored
from shopgrain.sources import tables

SCHEMA = "source STRING, target STRING, mark TIMESTAMP, written_at TIMESTAMP"


def ensure_marks(spark: SparkSession, name: str, location: str | None = None) -> None:
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({SCHEMA}) USING parquet{place}")


def mark_of(spark: SparkSession, marks: str, source: str, target: str) -> Column:
    """The largest mark written for the pair, the epoch before the first one."""
    own = spark.table(marks).filter((F.col("source") == source) & (F.col("target") == target))
    return high_water_mark(own, "mark")


def take_new(
    rows: DataFrame, time: str, marks: str, source: str, target: str, write: Callable[[DataFrame], int]
) -> int:
    """Give ``write`` the rows of a source whose ``time`` is after the pair's mark, and move the mark to
    the largest of their times once it has returned. Returns what ``write`` does, 0 without new rows.

    The mark is the source's time, not the target's: a batch that changes nothing in the target is not
    read again. ``write`` must be repeatable, as a merge is: if it fails, or the run stops before the
    mark is written, the same rows come again. Rows with a NULL time are not taken. A source must not
    add rows at or before its largest time; use ``incremental`` with ``lookback_days`` where it does.
    """
    spark = rows.sparkSession
    new = stored(incremental(rows, time, mark_of(spark, marks, source, target)), "new_rows")
    reached = new.agg(F.max(time).alias("mark")).first()["mark"]
    if reached is None:
        return 0
    written = write(new)
    row = new.agg(F.max(time).cast("timestamp").alias("mark"))
    tables.append(
        row.select(F.lit(source).alias("source"), F.lit(target).alias("target"), "mark", F.current_timestamp().alias("written_at")),
        marks,
    )
    return written
