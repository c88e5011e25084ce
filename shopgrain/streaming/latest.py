"""The latest version of each key as a table that a stream keeps up, replays and late files included."""

from __future__ import annotations

import pickle
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import BinaryType, StructField, StructType

from shopgrain.operators.history import latest_per_key

# Settings of a query whose state ends by time. An available-now query would else run batches
# without data for ever, waiting for that; it is freed with the next data instead.
_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}
GROUPS = 1 << 14  # of keys whose state is one value


class _Newer(StatefulProcessor):
    """Lets a version through if it is later than what was seen of its key; forgets idle keys. What was
    seen of a group of keys is one value: a call to the state's process and back serves them all."""

    def __init__(self, key: int, columns: list[str], idle_ms: int) -> None:
        self.key, self.columns, self.idle_ms = key, columns, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        kinds = StructType([StructField("keys", BinaryType())])
        self.seen = handle.getValueState("seen", kinds, self.idle_ms)

    def handleInputRows(self, group, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        now, held = timerValues.getCurrentProcessingTimeInMs(), self.seen.get()
        known = pickle.loads(held[0]) if held is not None else {}
        seen = {k: v for k, v in known.items() if v[2] > now - self.idle_ms}
        size, newer = len(self.columns), {}
        for row in rows:
            k, t, h = row[self.key], row[size], row[size + 1]
            before = seen.get(k)
            if before is None or (t, h) > before[:2]:
                seen[k], newer[k] = (t, h, now), row
            else:
                seen[k] = (*before[:2], now)
        self.seen.update((pickle.dumps(seen, pickle.HIGHEST_PROTOCOL),))
        made = Row(*self.columns)
        for row in newer.values():
            yield made(*row[:size])

    def close(self) -> None:
        pass


def newer_versions(
    versions: DataFrame, key: str, time: str, *, idle_hours: float = 24 * 30, groups: int = GROUPS
) -> DataFrame:
    """The rows of a stream that are later in ``time`` than all rows of their ``key`` before them, at
    most one for each key and micro-batch; equal times are decided by a hash of the row.

    State is the key and three numbers for each key that had a row within ``idle_hours``; it is freed when
    its group is met again, or with the group when none of its keys had a row for so long.
    There is no watermark, as one would drop late rows. A row of a freed key comes through whatever its
    time, so the reader must compare it with what is stored, as ``read_latest`` does: nothing is lost,
    however late. A NULL time is the earliest of all. Keys are dealt to ``groups`` by hash, which must stay
    the same for a checkpoint; a group's state is read and written as one, so take some hundred keys for
    each. The rows of a group in a micro-batch stream through one task; limit the batch by ``max_files``.
    """
    stamped = versions.withColumns(
        {
            "_t": F.coalesce(F.unix_micros(time), F.lit(-(1 << 63))),
            "_h": F.xxhash64(*versions.columns),
            "_group": F.pmod(F.xxhash64(key), F.lit(groups)),
        }
    )
    newer = _Newer(versions.columns.index(key), versions.columns, round(idle_hours * 3_600_000))
    return stamped.groupBy("_group").transformWithState(newer, versions.schema, "update", "processingTime")


def start_latest(
    versions: DataFrame, path: str, checkpoint: str, key: str, time: str, *, every: str | None = None, **state
) -> StreamingQuery:
    """Keep the latest version of each ``key`` below ``path``; read it with ``read_latest``.

    Each micro-batch writes its newer versions to a folder named by the batch id and replaces that
    folder, so a batch that is replayed after a stop leaves what it left before. Nothing is rewritten;
    ``compact`` brings the folders together.
    """
    spark = versions.sparkSession

    def write(batch: DataFrame, number: int) -> None:
        latest_per_key(batch, key, time).write.mode("overwrite").parquet(f"{path}/batch={number:012d}")

    writer = (
        newer_versions(versions, key, time, **state).writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint).foreachBatch(write)
    )
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    before = {k: spark.conf.get(k, None) for k in _SETTINGS}
    for k, v in _SETTINGS.items():  # a query takes the settings of its start
        spark.conf.set(k, v)
    try:
        return writer.start()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _folders(spark: SparkSession, path: str) -> tuple[str | None, list[str], list[str]]:
    """The newest whole base, the batches after it, and what neither reader needs any more."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    names = sorted(s.getPath().getName() for s in fs.listStatus(root)) if fs.exists(root) else []
    whole = [n for n in names if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{n}/_SUCCESS"))]
    base = max((n for n in whole if n.startswith("base=")), default=None)
    upto = base.split("=")[1] if base else ""
    batches = [n for n in whole if n.startswith("batch=") and n.split("=")[1] > upto]
    spent = [n for n in names if n != base and n.split("=")[1] <= upto]
    return base, batches, spent


def read_latest(spark: SparkSession, path: str, key: str, time: str, schema: StructType) -> DataFrame:
    """The latest version of each key of what ``start_latest`` has written, late rows in their place."""
    base, batches, _ = _folders(spark, path)
    found = [f"{path}/{n}" for n in ([base] if base else []) + batches]
    if not found:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).parquet(*found)
    return latest_per_key(rows, key, time)


def compact(spark: SparkSession, path: str, key: str, time: str, schema: StructType) -> None:
    """Write base and batches as one new base and delete what the base before it replaced.

    The new base counts once it is whole, and the folders that it replaces go with the next call: a
    reader that has listed them can end, and a stop at any step leaves the same latest versions. Run
    it between the stream's runs or beside them: it takes whole batches only.
    """
    base, batches, spent = _folders(spark, path)
    if batches:
        upto = batches[-1].split("=")[1]
        read_latest(spark, path, key, time, schema).write.mode("overwrite").parquet(f"{path}/base={upto}")
    for name in spent:
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
