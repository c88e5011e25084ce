"""The latest version of each key kept by a stream: batches, replays, late files, idle keys, compaction."""

import json
from time import sleep

from helpers import rows
from pyspark.sql import functions as F

from shopgrain.sources.files import read_file_stream
from shopgrain.streaming.latest import compact, read_latest, start_latest
from shopgrain.streaming.sinks import run_to_end

SCHEMA = "k BIGINT, t TIMESTAMP, v INT"


def land(spark, folder, data):
    spark.createDataFrame(data, "k BIGINT, t STRING, v INT").withColumn("t", F.col("t").cast("timestamp")).coalesce(
        1
    ).write.mode("append").parquet(folder)


class Feed:
    def __init__(self, spark, root, **state):
        self.spark, self.root, self.state = spark, str(root), state
        self.schema = spark.createDataFrame([], SCHEMA).schema

    def run(self, data, folder="out"):
        land(self.spark, f"{self.root}/in", data)
        stream = read_file_stream(self.spark, f"{self.root}/in", "parquet", self.schema, max_files=1)
        args = (f"{self.root}/{folder}", f"{self.root}/cp", "k", "t")
        query = run_to_end(start_latest(stream, *args, **self.state))
        return query, rows(self.latest(folder).select("k", "v"))

    def latest(self, folder="out"):
        return read_latest(self.spark, f"{self.root}/{folder}", "k", "t", self.schema)


def test_batches_late_files_and_replays(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    assert feed.latest().count() == 0
    assert feed.run([(1, "2020-01-01", 1), (1, "2020-01-03", 3), (2, "2020-01-02", 5), (None, "2020-01-01", 9)])[1] == [
        (1, 3), (2, 5), (None, 9)
    ]
    query, got = feed.run([(1, "2020-01-02", 2), (2, "2020-01-05", 6), (3, None, 7)])
    assert got == [(1, 3), (2, 6), (3, 7), (None, 9)]
    last = max(p.name for p in (tmp_path / "out").glob("batch=*"))
    written = rows(spark.read.parquet(str(tmp_path / "out" / last)), "k", "v")
    assert (1, 2) not in written  # the state kept the late row back
    # The batch is replayed, as after a stop before its commit: its folder is replaced.
    (tmp_path / "cp" / "commits" / str(int(last.split("=")[1]))).unlink()
    for crc in (tmp_path / "cp" / "commits").glob(f".{int(last.split('=')[1])}.crc"):
        crc.unlink()
    assert feed.run([(4, "2020-01-01", 8)])[1] == [(1, 3), (2, 6), (3, 7), (4, 8), (None, 9)]
    assert feed.latest().count() == 5


def test_idle_keys_are_freed_and_late_rows_of_theirs_change_nothing(spark, tmp_path):
    feed = Feed(spark, tmp_path, idle_hours=1 / 3600)
    feed.run([(k, "2020-01-01", k) for k in range(20)])
    sleep(1.5)
    feed.run([(100, "2020-02-01", 1)])
    sleep(1.5)
    query, _ = feed.run([(100, "2020-02-02", 2)])
    held = [json.loads(p.json)["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress]
    assert min(held) <= 6  # the state of key 100 and its timer, not of the twenty
    assert (7, 7) in feed.run([(7, "2019-12-01", -1)])[1]


def test_compaction_at_any_time(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    args = (spark, f"{tmp_path}/out", "k", "t", feed.schema)
    feed.run([(1, "2020-01-01", 1), (2, "2020-01-01", 1)])
    _, got = feed.run([(1, "2020-01-02", 2)])
    compact(*args)
    assert rows(feed.latest(), "k", "v") == got == [(1, 2), (2, 1)]
    feed.run([(2, "2020-01-03", 3)])
    (tmp_path / "out" / "base=999999999999").mkdir()  # a compaction that stopped before its end
    assert rows(feed.latest(), "k", "v") == [(1, 2), (2, 3)]
    (tmp_path / "out" / "base=999999999999").rmdir()
    compact(*args)
    compact(*args)
    assert rows(feed.latest(), "k", "v") == [(1, 2), (2, 3)]
    assert len([p for p in (tmp_path / "out").iterdir() if p.is_dir()]) == 1
