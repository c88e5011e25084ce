"""Parquet tables: create, append, refresh, merge. One writer per table at a time.

A refresh or merge that stops half way loses nothing: what it is about to write is whole in the shared
folder before the table is touched, and ``recover``, which every write of the same table starts with,
ends it or drops it.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterable, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from shopgrain.operators.history import assign_surrogate
from shopgrain.operators.incremental import touched_rows
from shopgrain.operators.merge import upsert
from shopgrain.schemas import TABLES, table_schema
from shopgrain.session import scratch_root, stored

Buckets = tuple[int, Sequence[str]]  # number of buckets, columns
FEW = 1000  # partition names that are listed in a filter or dropped by one statement
BUCKET_ROWS = 2_000_000  # of a bucket, which one task reads, groups and joins


def ensure_namespaces(spark: SparkSession, names: Iterable[str], use: str | None = None) -> None:
    for name in names:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{name}`")
    if use:
        spark.sql(f"USE `{use}`")


def ensure_table(
    spark: SparkSession, name: str, contract: str, location: str | None = None, *,
    buckets: Buckets | None = None,
) -> None:
    """Create ``name`` with the columns and partitioning of a contract unless it exists.

    ``buckets`` (number, columns) stores the rows by hash of the columns, sorted by them. Tables with the same
    number by the same key are joined and grouped by it without moving either; every write here keeps
    the layout, merges too. All rows of a key are in one bucket, which one task reads: take it for keys
    of which none holds a large share, and a number for the largest partition.
    """
    columns, partitions = TABLES[contract]
    parts = f" PARTITIONED BY ({', '.join(partitions)})" if partitions else ""
    place = f" LOCATION '{location}'" if location else ""
    by = ", ".join(f"`{c}`" for c in buckets[1]) if buckets else ""
    laid = f" CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets[0]} BUCKETS" if buckets else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{parts}{laid}{place}")


def buckets_for(keys: Sequence[str], *tables: DataFrame, least: int = 8, rows: int = BUCKET_ROWS) -> Buckets:
    """One layout for ``tables`` that are joined by ``keys``: so many buckets, ``least`` or more, that one
    of the longest table holds some ``rows`` rows, whatever its length. Counts the tables."""
    return max(least, *[-(-t.count() // rows) for t in tables]), list(keys)


def existing(spark: SparkSession, name: str) -> DataFrame | None:
    """The table, or None before the first run; any other error is raised."""
    return spark.table(name) if spark.catalog.tableExists(name) else None


def conform(df: DataFrame, contract: str, fill: Sequence[str] | None = None) -> DataFrame:
    """Columns of a contract in its order and types; columns ``df`` lacks are NULL. A column the
    contract does not know is an error, except for the metadata of an ingestion (``_...``), which is
    left out; a lacking one outside ``fill`` is an error where that is given."""
    fields = table_schema(contract).fields
    names = [f.name for f in fields]
    unknown = [c for c in df.columns if c not in names and not c.startswith("_")]
    lacking = [n for n in names if n not in df.columns and fill is not None and n not in fill]
    if unknown or lacking:
        raise ValueError(f"{contract}: unknown columns {unknown}, lacking columns {lacking}")
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in fields
        ]
    )


def append(
    df: DataFrame, name: str, *, partition_by: Sequence[str] = (), buckets: Buckets | None = None
) -> int:
    """Append by column name and return the number of rows written. A new table is created with
    ``partition_by`` and ``buckets`` (see ``ensure_table``); columns the table does not have yet are added to it, NULL in older rows."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(name):
        return _counted(df, lambda d: _writer(d, partition_by, buckets).saveAsTable(name))
    known = set(spark.table(name).columns)
    new = [f for f in df.schema.fields if f.name not in known]
    if new:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({columns})")
    rows = df.select(*spark.table(name).columns)
    parts, laid = _partitions(spark, name), _buckets(spark, name)
    return _counted(rows, lambda d: _sized(d, parts, laid).write.insertInto(name))


def append_evolving(df: DataFrame, path: str, *, partition_by: Sequence[str] = ()) -> None:
    """Append files that may carry new columns; read them back with ``mergeSchema``."""
    writer = df.write.mode("append").format("parquet")
    (writer.partitionBy(*partition_by) if partition_by else writer).save(path)


def read_evolving(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("mergeSchema", "true").parquet(path)


def refresh(
    df: DataFrame, name: str, *, partition_by: Sequence[str] = (), buckets: Buckets | None = None
) -> int:
    """Replace a table's rows, and its columns where they differ; returns the number of rows.

    The new state may be computed from the old one. A table without partitions gets a new folder, and
    its location is then moved there in one step: a reader sees the old or the new state, never less. The
    folder before stays for readers that have listed it, until the next refresh. Of a partitioned or
    bucketed table the new state is stored whole, then written over the old one; a stop in between is ended
    by the next write or ``recover``.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(name):
        return _counted(df, lambda d: _writer(d, partition_by, buckets).saveAsTable(name))
    recover(spark, name)
    table, parts, laid = spark.table(name), _partitions(spark, name), _buckets(spark, name)
    if {(f.name, f.dataType) for f in table.schema} != {(f.name, f.dataType) for f in df.schema}:
        return _counted(
            stored(df, "refresh"),
            lambda d: _writer(d, partition_by, buckets or laid).mode("overwrite").saveAsTable(name),
        )
    new = df.select(*table.columns)
    if not parts and not laid:
        return _swap(new, name)
    new.write.parquet(f"{_intent(spark, name)}/all")
    return recover(spark, name)


def _swap(new: DataFrame, name: str) -> int:
    """Write ``new`` to a folder of its own and point the table there."""
    spark = new.sparkSession
    now = spark.sql(f"DESCRIBE FORMATTED {name}").filter("col_name = 'Location'").first()["data_type"]
    root = now.split("__v", 1)[0]
    folder = f"{root}__v{uuid.uuid4().hex}"
    written = _counted(new, lambda d: d.write.parquet(folder))
    _point(spark, name, folder)
    place = _path(spark, root)
    fs = place.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in fs.listStatus(place.getParent()):
        found = status.getPath().getName()
        if found.startswith(f"{place.getName()}__v") and found not in (folder.rsplit("/", 1)[1], now.rsplit("/", 1)[1]):
            fs.delete(status.getPath(), True)
    return written


def _point(spark: SparkSession, name: str, folder: str) -> None:
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{folder}'")
    spark.catalog.refreshTable(name)


def _path(spark: SparkSession, folder: str):
    return spark._jvm.org.apache.hadoop.fs.Path(folder)


def _intent(spark: SparkSession, name: str) -> str:
    """The folder below the shared one that holds what a write of ``name`` is about to put in place."""
    full = name if "." in name else f"{spark.catalog.currentDatabase()}.{name}"
    return f"{scratch_root(spark)}/intents/{full.replace('`', '')}"


def recover(spark: SparkSession, name: str) -> int:
    """End a refresh or merge that stopped after its new rows were whole, or drop what it left before;
    every step can be repeated. Returns the number of rows written, 0 where there is nothing to do."""
    folder = _intent(spark, name)
    place = _path(spark, folder)
    fs = place.getFileSystem(spark._jsc.hadoopConfiguration())
    written = 0
    whole = lambda part: fs.exists(_path(spark, f"{folder}/{part}/_SUCCESS"))
    if whole("touched") and whole("merged"):
        own = _session(spark, "dynamic")
        merged, touched = (own.read.parquet(f"{folder}/{part}") for part in ("merged", "touched"))
        partition = touched.columns[0]
        merged = merged.select(*own.table(name).columns)
        written = _overwrite(merged, name, [partition], spark)
        _drop_emptied(own, name, partition, touched, merged)
        spark.catalog.refreshTable(name)
    elif whole("all"):
        own = _session(spark, "static")
        new = own.read.parquet(f"{folder}/all").select(*own.table(name).columns)
        written = _overwrite(new, name, _partitions(spark, name), spark)
    fs.delete(place, True)
    return written


def merge_partitions(
    source: DataFrame,
    name: str,
    keys: Sequence[str],
    partition: str,
    merge: Callable[[DataFrame, DataFrame, Sequence[str]], DataFrame] = upsert,
    *,
    fixed: bool = False,
) -> int:
    """Merge ``source`` into a partitioned table, rewriting only the partitions it touches; returns
    the number of rows written.

    Those are the partitions of its rows, and those in which its keys are stored now, which a scan of
    the key columns finds; with ``fixed`` (the key decides the partition) the scan is left out. Up to
    ``FEW`` names become a filter that prunes the scan, more of them a join. The dynamic overwrite
    leaves the other partitions' files alone. ``source`` is stored first, as it is read again.

    The merged rows and the touched partitions are whole in the shared folder before the table changes;
    then the partitions are written, and the emptied ones dropped. A stop before leaves the old state; a
    stop after is ended by the next write or ``recover``, and until then a row that moves may be in both
    its partitions.
    """
    spark = source.sparkSession
    recover(spark, name)
    own = _session(spark, "dynamic")
    source = _reread(stored(source, "merge_source"), own)
    target = own.table(name)
    touched = source.select(partition)
    if not fixed:
        touched = touched.union(touched_rows(target, source, keys).select(partition))
    touched = stored(touched.distinct(), "partitions")
    few = [row[0] for row in touched.limit(FEW + 1).collect()]
    if len(few) <= FEW:
        listed = F.col(partition).isin([n for n in few if n is not None])
        old = target.filter(listed | F.col(partition).isNull() if None in few else listed)
    else:
        old = touched_rows(target, touched, partition)
    merge(old, source, keys).select(*target.columns).write.parquet(f"{_intent(spark, name)}/merged")
    touched.write.parquet(f"{_intent(spark, name)}/touched")  # from here on the merge will be done
    return recover(spark, name)


def _drop_emptied(
    spark: SparkSession, name: str, partition: str, touched: DataFrame, merged: DataFrame
) -> None:
    """Drop touched partitions to which no row belongs any more, after the others are written: a dynamic
    overwrite replaces only partitions it has rows for. A row that moves is thus never in no partition."""
    left = merged.select(F.col(partition).alias("_left")).distinct()
    empty = touched.join(left, F.col(partition).eqNullSafe(F.col("_left")), "left_anti")
    specs: list[str] = []

    def drop() -> None:
        if specs:
            spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {', '.join(specs)}")
            specs.clear()

    for row in empty.toLocalIterator():
        value = "NULL" if row[0] is None else "'" + str(row[0]).replace("'", "\\'") + "'"
        specs.append(f"PARTITION ({partition} = {value})")
        if len(specs) == FEW:
            drop()
    drop()


def write_scd2(
    current: DataFrame,
    name: str,
    *,
    version: Sequence[str] = ("customer_id", "version"),
    surrogate: str | None = None,
) -> int:
    """Store the result of ``scd2_current`` in a table partitioned by ``is_current``: versions
    closed by this batch are appended to the closed ones and the current ones are replaced, so the
    closed history is never rewritten. Returns the number of rows written.

    A run that stopped between the two steps can be repeated: a closed version (``version`` names
    it) that the table has already is not appended again. ``surrogate`` numbers the rows in which
    that column is NULL, from the table's largest number on.
    """
    spark = current.sparkSession
    table = spark.table(name)
    current = stored(current.select(*table.columns), "scd2")
    if surrogate:
        above = table.agg(F.coalesce(F.max(surrogate), F.lit(0))).scalar()
        current = stored(assign_surrogate(current, surrogate, version, above=above), "numbered")
    closed = current.filter(~F.col("is_current")).select(*table.columns)
    had = table.filter(~F.col("is_current")).select(*[F.col(c).alias(f"_had_{c}") for c in version])
    same = F.lit(True)
    for c in version:
        same = same & F.col(c).eqNullSafe(F.col(f"_had_{c}"))
    written = append(stored(closed.join(had, same, "left_anti"), "closed"), name)
    own = _session(spark, "dynamic")
    kept = _reread(current, own).filter("is_current").select(*table.columns)
    return written + _overwrite(kept, name, ["is_current"], spark)


def _session(spark: SparkSession, mode: str) -> SparkSession:
    """A session with its own overwrite mode. An insert into a table takes the mode from its session,
    and another thread's insert would flip the mode of a shared one."""
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if own.conf.isModifiable(key):
            own.conf.set(key, value)
    own.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
    own.catalog.setCurrentDatabase(spark.catalog.currentDatabase())
    return own


def _reread(df: DataFrame, spark: SparkSession) -> DataFrame:
    """A stored result, read in another session."""
    folders = {f.rsplit("/", 1)[0] for f in df.inputFiles()}
    if not folders:
        return spark.createDataFrame([], df.schema)
    return spark.read.schema(df.schema).parquet(*folders)


def _overwrite(df: DataFrame, name: str, partitions: Sequence[str], caller: SparkSession) -> int:
    laid = _buckets(caller, name)
    written = _counted(df, lambda d: _sized(d, partitions, laid).write.insertInto(name, overwrite=True))
    caller.catalog.refreshTable(name)  # it has listed the files before
    return written


def _counted(df: DataFrame, write: Callable[[DataFrame], None]) -> int:
    """Rows that ``write`` writes, counted on the way."""
    seen = Observation()
    write(df.observe(seen, F.count(F.lit(1)).alias("rows")))
    try:
        return seen.get["rows"]
    except Py4JJavaError:
        if df.isEmpty():  # without any row the plan may have lost the counter
            return 0
        raise


def _partitions(spark: SparkSession, name: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(name) if c.isPartition]


def _buckets(spark: SparkSession, name: str) -> Buckets | None:
    """(number, columns) of a bucketed table."""
    wanted = ("Num Buckets", "Bucket Columns")
    found = dict(
        spark.sql(f"DESCRIBE FORMATTED {name}").filter(F.col("col_name").isin(*wanted))
        .select("col_name", "data_type").collect()
    )
    if not found:
        return None
    return int(found["Num Buckets"]), re.findall("`([^`]+)`", found["Bucket Columns"])


def _writer(df: DataFrame, partition_by: Sequence[str], buckets: Buckets | None = None):
    writer = _sized(df, partition_by, buckets).write.format("parquet")
    if buckets:
        writer = writer.bucketBy(buckets[0], *buckets[1]).sortBy(*buckets[1])
    return writer.partitionBy(*partition_by) if partition_by else writer


def _sized(df: DataFrame, partition_by: Sequence[str], buckets: Buckets | None = None) -> DataFrame:
    """Rows of a table partition brought together, so tasks do not each write a small file to
    every partition. Rebalancing splits a large partition over several tasks and files. A bucket is
    written by one task, as its rows' hash is the one that the shuffle goes by: one file in each
    partition, which the reader needs not sort again."""
    if buckets:
        return df.repartition(buckets[0], *buckets[1])
    return df.hint("rebalance", *partition_by) if partition_by else df
