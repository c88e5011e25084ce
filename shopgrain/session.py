"""Session settings the operators are written for, and the shared scratch folder."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings that change results (time zone, ANSI) or the physical plan (AQE). Sizes such as
# shuffle partitions and executor memory belong to the cluster and are left to it.
ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join even where the next step then needs another shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

_written: list[str] = []


def build_session(app: str = "shopgrain", master: str | None = None, **conf: str) -> SparkSession:
    """A session with ``ENGINE_CONF``; keyword ``conf`` uses ``__`` for the dots in setting names."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            builder = builder.config("spark.driver.host", "127.0.0.1").config(
                "spark.driver.bindAddress", "127.0.0.1"
            )
    for key, value in {**ENGINE_CONF, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Where it is unset, a folder below the warehouse, which executors share as well.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    return root or os.path.join(spark.conf.get("spark.sql.warehouse.dir"), "_scratch")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name below the shared folder."""
    path = os.path.join(scratch_root(spark), f"{name}-{uuid.uuid4().hex}")
    _written.append(path)
    return path


def release_scratch(spark: SparkSession) -> int:
    """Delete the folders this process named below the shared folder; call it when the results
    that read them are written. Returns how many there were."""
    conf = spark._jsc.hadoopConfiguration()
    removed = 0
    while _written:
        path = spark._jvm.org.apache.hadoop.fs.Path(_written.pop())
        removed += path.getFileSystem(conf).delete(path, True)
    return removed


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """On leaving, delete what was stored inside, and nothing stored before."""
    global _written
    before, _written = _written, []
    try:
        yield
    finally:
        release_scratch(spark)
        _written = before


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once below the shared folder and read back.

    For a reduced result that several branches of a plan read, or that rows with hot keys are joined
    to. Branches read files instead of computing it again, and lost executors cost only the tasks in
    flight. A join sees the real size, so it broadcasts only what is small, and adaptive execution
    can split a hot key: it does so only where both join sides come straight from a shuffle, which
    an aggregate in the same plan does not. Runs a job.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
