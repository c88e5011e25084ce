"""Refresh, merge and marks stopped at each step: the old state or the new one, and nothing lost."""

import pytest
from helpers import rows
from pyspark.sql import functions as F

from shopgrain.operators.merge import upsert_all
from shopgrain.sources import marks, tables


class Stop(Exception):
    pass


@pytest.fixture
def name(spark, request, tmp_path):
    table = "stops_" + request.node.originalname[-40:]
    spark.sql(
        f"CREATE TABLE {table} (k INT, v STRING, month STRING) USING parquet "
        f"PARTITIONED BY (month) LOCATION '{tmp_path / 'table'}'"
    )
    yield table
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def months(spark, data):
    return spark.createDataFrame(data, "k INT, v STRING, month STRING")


OLD = [(1, "a", "m1"), (2, "b", "m2"), (3, "c", "m3")]
NEW = [(1, "a", "m1"), (2, "B", "m4"), (3, "c", "m3"), (5, "e", "m1")]  # the row of m2 moves to m4


def stop_at(monkeypatch, step):
    def stopped(*args, **kw):
        raise Stop

    monkeypatch.setattr(tables, step, stopped)


@pytest.mark.parametrize("step", ["recover", "_overwrite", "_drop_emptied"])
def test_a_merge_that_stops(spark, name, monkeypatch, step):
    tables.append(months(spark, OLD), name)
    source = months(spark, [(2, "B", "m4"), (5, "e", "m1")])
    merge = lambda: tables.merge_partitions(source, name, ["k"], "month", upsert_all)
    with monkeypatch.context() as patch:
        if step == "recover":  # before the table is touched: the second call, after the intent is whole
            calls, real = [], tables.recover

            def second(*args):
                calls.append(args)
                if len(calls) == 2:
                    raise Stop
                return real(*args)

            patch.setattr(tables, "recover", second)
        else:
            stop_at(patch, step)
        with pytest.raises(Stop):
            merge()
    seen = {r[0] for r in rows(spark.table(name), "k")}
    assert seen >= {1, 2, 3}  # no row is in no partition
    if step != "_drop_emptied":
        assert rows(spark.table(name)) == OLD
    tables.recover(spark, name)
    assert rows(spark.table(name)) == NEW
    assert tables.recover(spark, name) == 0
    merge()
    assert rows(spark.table(name)) == NEW


def test_a_merge_that_stops_before_its_rows_are_whole(spark, name, monkeypatch):
    tables.append(months(spark, OLD), name)
    bad = lambda old, new, keys: upsert_all(old, new, keys).withColumn("v", F.raise_error(F.lit("stop")).cast("string"))
    with pytest.raises(Exception, match="stop"):
        tables.merge_partitions(months(spark, [(2, "B", "m4")]), name, ["k"], "month", bad)
    assert rows(spark.table(name)) == OLD
    assert tables.recover(spark, name) == 0 and rows(spark.table(name)) == OLD
    tables.merge_partitions(months(spark, [(2, "B", "m4"), (5, "e", "m1")]), name, ["k"], "month", upsert_all)
    assert rows(spark.table(name)) == NEW


def test_a_refresh_of_partitions_that_stops(spark, name, monkeypatch):
    tables.append(months(spark, OLD), name)
    with monkeypatch.context() as patch:
        stop_at(patch, "_overwrite")
        with pytest.raises(Stop):
            tables.refresh(months(spark, NEW), name, partition_by=["month"])
    assert rows(spark.table(name)) == OLD
    assert tables.recover(spark, name) == 4
    assert rows(spark.table(name)) == NEW


def test_a_refresh_swaps_the_folder(spark, tmp_path, monkeypatch):
    spark.sql(f"CREATE TABLE swapped (k INT) USING parquet LOCATION '{tmp_path / 'swapped'}'")
    one = lambda k: spark.createDataFrame([(k,)], "k INT")
    tables.refresh(one(1), "swapped")
    reader = spark.table("swapped")
    reader.count()
    with monkeypatch.context() as patch:
        stop_at(patch, "_point")
        with pytest.raises(Stop):
            tables.refresh(one(2), "swapped")
    assert rows(spark.table("swapped")) == [(1,)]
    assert tables.refresh(spark.table("swapped").withColumn("k", F.col("k") + 2), "swapped") == 1
    assert rows(spark.table("swapped")) == [(3,)]
    assert len([p for p in tmp_path.iterdir() if p.name.startswith("swapped__v")]) == 2  # this and the last
    spark.sql("DROP TABLE swapped")


def test_a_lost_counter_is_an_error_unless_nothing_was_written(spark, monkeypatch, tmp_path):
    from py4j.protocol import Py4JJavaError

    class Lost:
        @property
        def get(self):
            raise Py4JJavaError.__new__(Py4JJavaError)

    class Seen(Lost):
        def __init__(self):
            pass

    monkeypatch.setattr(tables, "Observation", Seen)
    df = spark.range(3)
    monkeypatch.setattr(type(df), "observe", lambda self, *a: self)
    assert tables._counted(df.filter("id < 0"), lambda d: None) == 0
    with pytest.raises(Py4JJavaError):
        tables._counted(df, lambda d: None)


def test_marks(spark, tmp_path):
    marks.ensure_marks(spark, "own_marks", str(tmp_path / "marks"))
    at = lambda *days: spark.createDataFrame([(f"2020-01-{d:02d}",) for d in days], "t STRING").select(
        F.col("t").cast("timestamp").alias("t")
    )
    got = []

    def write(new):
        got.append(sorted(r.t.day for r in new.collect()))
        return len(got[-1])

    def fails(new):
        raise Stop

    take = lambda df, how, target="b": marks.take_new(df, "t", "own_marks", "a", target, how)
    assert take(at(1, 2), write) == 2 and take(at(1, 2), write) == 0
    with pytest.raises(Stop):
        take(at(1, 2, 3), fails)
    assert take(at(1, 2, 3, 4), write) == 2 and take(at(1, 2), write, "other") == 2
    assert got == [[1, 2], [3, 4], [1, 2]]
    spark.sql("DROP TABLE own_marks")
