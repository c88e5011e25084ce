"""Incremental file feeds and ingestion metadata."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

CORRUPT = "_corrupt_record"

_FORMAT_OPTIONS = {
    "parquet": {"mergeSchema": "true"},
    "json": {"multiLine": "false"},
    "csv": {"header": "true"},
    "avro": {},
}


def read_file_stream(
    spark: SparkSession,
    path: str,
    fmt: str,
    schema: StructType,
    *,
    max_files: int | None = None,
    glob: str | None = None,
    keep_corrupt: bool | None = None,
    **options: str,
) -> DataFrame:
    """Stream of the files that land below ``path``.

    ``max_files`` bounds a micro-batch; ``keep_corrupt`` (the default for json and csv) keeps lines
    that do not fit the schema in ``_corrupt_record`` for the quarantine. Avro needs the spark-avro
    package on the cluster.
    """
    if keep_corrupt is None:
        keep_corrupt = fmt in ("csv", "json")
    reader = spark.readStream.format(_checked(spark, fmt)).options(
        **{**_FORMAT_OPTIONS[fmt], **options}
    )
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    if keep_corrupt:
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
        schema = StructType([*schema.fields, StructField(CORRUPT, StringType())])  # the caller's stays as it is
    return reader.schema(schema).load(path)


def infer_schema(spark: SparkSession, path: str, fmt: str = "csv") -> StructType:
    """Schema that fits every line already landed; a stream then reads with it, so types do not drift
    between micro-batches. All lines are read: a value outside a sample would become NULL."""
    reader = spark.read.format(_checked(spark, fmt)).options(**_FORMAT_OPTIONS[fmt])
    if fmt == "csv":
        reader = reader.option("inferSchema", "true")
    return reader.load(path).schema


def evolve(schema: StructType, landed: StructType) -> StructType:
    """``schema`` with the new columns of ``landed`` added at the end."""
    known = set(schema.fieldNames())
    return StructType(schema.fields + [f for f in landed.fields if f.name not in known])


def with_ingest_meta(df: DataFrame, *, source_file: bool = False, row_id: bool = False) -> DataFrame:
    """Add ``_ingestion_timestamp`` and, for file sources, ``_source_file`` and ``_batch_id``.

    ``_batch_id`` names a row by its parquet file and its place there, in full, so no two rows share
    one. Unlike a running number it is legal on a stream and the same when a micro-batch is retried.
    """
    added = {"_ingestion_timestamp": F.current_timestamp()}
    if source_file:
        added["_source_file"] = F.col("_metadata.file_path")
    if row_id:
        added["_batch_id"] = F.concat_ws(
            "#", "_metadata.file_path", F.col("_metadata.row_index").cast("string")
        )
    return df.select("*", *[c.alias(n) for n, c in added.items()])


def _checked(spark: SparkSession, fmt: str) -> str:
    if fmt not in _FORMAT_OPTIONS:
        raise ValueError(f"unknown feed format: {fmt}")
    if fmt == "avro":
        try:
            spark.read.format("avro").schema("a INT").load([])
        except AnalysisException as error:
            if "avro" in str(error).lower():
                raise RuntimeError("the avro feed needs the spark-avro package") from error
    return fmt
