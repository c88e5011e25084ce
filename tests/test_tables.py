from pathlib import Path

import pytest
from helpers import plan, rows
from pyspark.sql import functions as F

from shopgrain.operators.merge import upsert_all
from shopgrain.schemas import TABLES, table_schema
from shopgrain.session import release_scratch, scratch_path, scratch_root, stored
from shopgrain.sources import tables


@pytest.fixture
def name(spark, request):
    table = f"t_{request.node.originalname}"
    yield table
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def months(spark, data):
    return spark.createDataFrame(data, "k INT, v STRING, month STRING")


@pytest.mark.parametrize("contract", sorted(TABLES))
def test_every_contract_makes_a_table(spark, contract):
    table = f"c_{contract}"
    tables.ensure_table(spark, table, contract)
    tables.ensure_table(spark, table, contract)
    assert spark.table(table).schema.simpleString() == table_schema(contract).simpleString()
    parts = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    assert parts == TABLES[contract][1]
    spark.sql(f"DROP TABLE {table}")


def test_namespaces(spark):
    tables.ensure_namespaces(spark, ["raw_zone", "raw_zone", "mart_zone"], use="raw_zone")
    assert spark.catalog.currentDatabase() == "raw_zone"
    tables.ensure_namespaces(spark, [], use="default")
    assert spark.catalog.databaseExists("mart_zone")


def test_scd2_table_rewrites_only_current_versions(spark, name, tmp_path):
    from shopgrain.plans.cleaned import customers_scd2

    place = tmp_path / "dim"
    tables.ensure_table(spark, name, "customers_scd2", str(place))
    cols = ("customer_id BIGINT, customer_unique_id STRING, customer_zip_code_prefix INT, "
            "customer_city STRING, customer_state STRING, customer_phone STRING, "
            "customer_email STRING, updated_at INT")

    def load(at, *people):
        feed = spark.createDataFrame([(k, "u", z, "c", "s", "p", "e", at) for k, z in people], cols)
        tables.write_scd2(
            customers_scd2(spark.table(name), feed, as_of=f"202{at}-01-01", current_only=True), name
        )
        return rows(spark.table(name), "customer_id", "version", "customer_zip_code_prefix", "is_current")

    assert load(0, (1, 10), (2, 20)) == [(1, 1, 10, True), (2, 1, 20, True)]
    assert load(1, (1, 11), (3, 30)) == [
        (1, 1, 10, False), (1, 2, 11, True), (2, 1, 20, True), (3, 1, 30, True)]
    closed = {p: p.stat().st_mtime_ns for p in (place / "is_current=false").glob("*.parquet")}
    assert load(2, (1, 12), (2, 20)) == [
        (1, 1, 10, False), (1, 2, 11, False), (1, 3, 12, True), (2, 1, 20, True), (3, 1, 30, True)]
    after = {p: p.stat().st_mtime_ns for p in (place / "is_current=false").glob("*.parquet")}
    assert closed and closed.items() <= after.items()


def test_existing(spark, name):
    assert tables.existing(spark, name) is None
    tables.append(months(spark, [(1, "a", "m")]), name)
    assert tables.existing(spark, name).count() == 1


def test_append_goes_by_column_name(spark, name):
    tables.append(months(spark, [(1, "a", "2020-01")]), name, partition_by=["month"])
    tables.append(months(spark, [(2, "b", "2020-02")]).select("month", "v", "k"), name)
    assert rows(spark.table(name), "k", "v", "month") == [(1, "a", "2020-01"), (2, "b", "2020-02")]


def test_refresh_may_read_its_own_table_and_change_the_schema(spark, name):
    tables.refresh(months(spark, [(1, "a", "m"), (2, "b", "m")]), name)
    tables.refresh(spark.table(name).filter("k = 2").withColumn("more", F.lit(5)), name)
    assert rows(spark.table(name), "k", "more") == [(2, 5)]


def test_refresh_of_a_partitioned_table(spark, name):
    spark.sql(f"CREATE TABLE {name} (k INT, v STRING, month STRING) USING parquet PARTITIONED BY (month)")
    for k in (1, 2, 3):
        new = months(spark, [(k, "a", f"m{k % 2}")])
        tables.refresh(spark.table(name).unionByName(new), name, partition_by=["month"])
    assert rows(spark.table(name), "k", "month") == [(1, "m1"), (2, "m0"), (3, "m1")]
    assert rows(spark.table(name).filter("month = 'm0'"), "k") == [(2,)]
    tables.refresh(months(spark, [(9, "a", "m9")]), name)
    assert rows(spark.table(name), "k", "month") == [(9, "m9")]


def test_files_may_gain_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.append_evolving(spark.createDataFrame([(1,)], "k INT"), path)
    tables.append_evolving(spark.createDataFrame([(2, "x")], "k INT, extra STRING"), path)
    assert rows(tables.read_evolving(spark, path), "k", "extra") == [(1, None), (2, "x")]


def test_merge_touches_only_its_partitions(spark, name, tmp_path):
    place = tmp_path / "table"
    spark.sql(
        f"CREATE TABLE {name} (k INT, v STRING, month STRING) USING parquet "
        f"PARTITIONED BY (month) LOCATION '{place}'"
    )
    tables.append(months(spark, [(1, "a", "2020-01"), (2, "b", "2020-02"), (3, "c", "2020-02")]), name)
    untouched = {p: p.stat().st_mtime_ns for p in (place / "month=2020-01").glob("*.parquet")}
    source = months(spark, [(2, "B", "2020-02"), (4, "d", "2020-03")])
    tables.merge_partitions(source, name, ["k"], "month", upsert_all)
    assert rows(spark.table(name), "k", "v", "month") == [
        (1, "a", "2020-01"), (2, "B", "2020-02"), (3, "c", "2020-02"), (4, "d", "2020-03"),
    ]
    assert {p: p.stat().st_mtime_ns for p in (place / "month=2020-01").glob("*.parquet")} == untouched
    tables.merge_partitions(source.limit(0), name, ["k"], "month", upsert_all)
    assert spark.table(name).count() == 4


@pytest.mark.parametrize("mode", ["static", "dynamic"])
def test_writes_do_not_lean_on_the_session_overwrite_mode(spark, name, mode):
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, mode)
    try:
        tables.append(months(spark, [(1, "a", "x"), (2, "b", "y")]), name, partition_by=["month"])
        tables.merge_partitions(months(spark, [(2, "B", "y")]), name, ["k"], "month", upsert_all)
        assert rows(spark.table(name), "k", "v") == [(1, "a"), (2, "B")]
        tables.refresh(spark.table(name).filter("k = 2"), name, partition_by=["month"])
        assert rows(spark.table(name), "k", "v") == [(2, "B")]
        assert spark.conf.get(key) == mode
    finally:
        spark.conf.set(key, before)


def test_merge_of_a_null_partition(spark, name):
    tables.append(months(spark, [(1, "a", None), (2, "b", "m")]), name, partition_by=["month"])
    tables.merge_partitions(months(spark, [(1, "A", None)]), name, ["k"], "month", upsert_all)
    assert rows(spark.table(name), "k", "v", "month") == [(1, "A", None), (2, "b", "m")]


def test_a_partitioned_write_makes_few_files(spark, name):
    df = spark.range(0, 4000, numPartitions=16).select(
        F.col("id").cast("int").alias("k"), F.lit("v").alias("v"),
        F.concat(F.lit("m"), F.col("id") % 5).alias("month"),
    )
    tables.append(df, name, partition_by=["month"])
    assert len(spark.table(name).inputFiles()) <= 10


def test_stored_results_go_below_the_shared_folder(spark):
    df = stored(spark.range(10).withColumn("x", F.lit(None).cast("string")), "ten")
    assert df.count() == 10 and df.schema.fieldNames() == ["id", "x"]
    root = scratch_root(spark)
    assert all(root in f for f in df.inputFiles())
    assert scratch_path(spark, "a") != scratch_path(spark, "a")
    assert spark.conf.get("spark.checkpoint.dir", root) == root and Path(root).is_dir()


def test_scratch_is_released(spark):
    df = stored(spark.range(3), "three")
    folder = Path(df.inputFiles()[0].removeprefix("file://")).parent
    assert folder.is_dir()
    assert release_scratch(spark) >= 1 and not folder.exists()
    assert release_scratch(spark) == 0


def test_filters_reach_the_scan(spark, tmp_path):
    from shopgrain.operators.incremental import incremental

    path = str(tmp_path / "t")
    spark.range(10).select(
        "id", F.timestamp_seconds("id").alias("_ingestion_timestamp"), F.lit(1).alias("unused")
    ).write.parquet(path)
    df = incremental(spark.read.parquet(path), "_ingestion_timestamp", "1970-01-01 00:00:05").select("id")
    text = plan(df)
    assert "GreaterThan(_ingestion_timestamp" in text and "unused" not in text
    assert df.count() == 4


def test_append_adds_new_columns(spark, name):
    tables.append(spark.sql("SELECT 1 AS k"), name)
    assert tables.append(spark.sql("SELECT 2 AS k, 'x' AS extra"), name) == 1
    assert rows(spark.table(name), "k", "extra") == [(1, None), (2, "x")]


def test_conform_names_what_it_does_not_know(spark):
    with pytest.raises(ValueError, match="misspelt"):
        tables.conform(spark.sql("SELECT 1 AS misspelt"), "orders_silver")
    with pytest.raises(ValueError, match="order_id"):
        tables.conform(spark.sql("SELECT 1 AS customer_id"), "orders_silver", fill=[])


def test_a_key_that_moves_to_another_partition_is_one_row(spark, name):
    tables.append(months(spark, [(1, "a", "m1"), (2, "b", "m2")]), name, partition_by=["month"])
    tables.merge_partitions(
        months(spark, [(1, "A", "m3")]), name, ["k"], "month",
        lambda t, s, keys: upsert_all(t, s, keys),
    )
    assert rows(spark.table(name), "k", "v", "month") == [(1, "A", "m3"), (2, "b", "m2")]


def test_two_tables_written_from_two_threads(spark, name):
    from concurrent.futures import ThreadPoolExecutor

    other = f"{name}_other"
    for t in (name, other):
        tables.append(
            months(spark, [(i, "a", f"m{i}") for i in range(4)]), t, partition_by=["month"]
        )

    def merge(n):
        for i in range(3):
            tables.merge_partitions(months(spark, [(0, f"b{i}", "m0")]), name, ["k"], "month", upsert_all)

    def renew(n):
        for _ in range(3):
            tables.refresh(months(spark, [(9, "z", "m9")]), other, partition_by=["month"])

    with ThreadPoolExecutor(2) as pool:
        for job in [pool.submit(merge, 0), pool.submit(renew, 1)]:
            job.result()
    assert [r[0] for r in rows(spark.table(name), "k")] == [0, 1, 2, 3]
    assert rows(spark.table(other), "k") == [(9,)]
    spark.sql(f"DROP TABLE {other}")


def test_a_scd2_write_can_be_repeated_and_numbers_its_rows(spark, name, tmp_path, monkeypatch):
    from shopgrain.plans.cleaned import customers_scd2

    tables.ensure_table(spark, name, "customers_scd2", str(tmp_path / "dim"))
    cols = ("customer_id BIGINT, customer_unique_id STRING, customer_zip_code_prefix INT, "
            "customer_city STRING, customer_state STRING, customer_phone STRING, "
            "customer_email STRING, updated_at INT")

    def load(at, z):
        feed = spark.createDataFrame([(1, "u", z, "c", "s", "p", "e", at)], cols)
        state = customers_scd2(spark.table(name), feed, as_of=f"202{at}-01-01", current_only=True)
        tables.write_scd2(state, name, surrogate="customer_sk")

    load(0, 10)
    whole = tables._overwrite
    monkeypatch.setattr(tables, "_overwrite", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        load(1, 11)
    monkeypatch.setattr(tables, "_overwrite", whole)
    load(1, 11)
    got = rows(spark.table(name), "version", "customer_zip_code_prefix", "is_current", "customer_sk")
    assert [r[:3] for r in got] == [(1, 10, False), (2, 11, True)]
    assert len({r[3] for r in got}) == 2 and None not in {r[3] for r in got}


def test_scratch_of_a_block_is_deleted_alone(spark):
    from shopgrain.session import scratch

    before = stored(spark.range(3), "before")
    with scratch(spark):
        inside = Path(stored(spark.range(3), "inside").inputFiles()[0].removeprefix("file://")).parent
        assert inside.is_dir()
    assert not inside.exists() and before.count() == 3
