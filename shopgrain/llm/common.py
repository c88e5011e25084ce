"""Helpers shared by the operators: stored steps, row keys, the given tables, ASCII rules."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from shopgrain.session import stored

# White space of the word and line rules: space and \t \n \v \f \r, nothing beyond ASCII.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = "[\\x20\\x09-\\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def store(df: DataFrame, name: str) -> DataFrame:
    """``stored``, after which the driver lets go of what the step shuffled.

    Shuffle files live until the driver collects the plan that made them; a chain of steps would
    otherwise keep the files of all its steps on disk at once.
    """
    out = stored(df, name)
    gc.collect()
    df.sparkSession.sparkContext._jvm.System.gc()
    return out


def discard(*tables: DataFrame) -> None:
    """Delete stored steps that nothing will read again."""
    for df in tables:
        spark = df.sparkSession
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def text_of(col: str) -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def row_key(id_col: Column, text: Column) -> list[Column]:
    """Two independent 64-bit hashes of id and text: equal for repeated rows, which get equal
    results anyway, and different for rows that only share an id."""
    return [
        F.xxhash64(id_col, text).alias("k1"),
        F.xxhash64(F.lit(1), text, id_col).alias("k2"),
    ]


def ascii_lower(x: Column) -> Column:
    """A-Z lower-cased, other letters as they are."""
    plain = F.octet_length(x) == F.char_length(x)
    return F.when(plain, F.lower(x)).otherwise(F.translate(x, UPPER, LOWER))


def held(df: DataFrame, *keep: str) -> DataFrame:
    """The same rows behind a one-element ``inline``: array columns are computed once per row and
    not again inside each lambda that a later projection would be merged with. Columns in ``keep``
    go past it, so that a partitioning by them is still known."""
    rest = [c for c in df.columns if c not in keep]
    return df.select(*keep, F.inline(F.array(F.struct(*rest))))


def words_of(text: str | None) -> list[bytes]:
    """UTF-8 words; ``bytes.split`` splits at exactly the six ASCII white-space characters."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def per_batch(
    df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], Iterable[pa.RecordBatch]]],
    schema: str | StructType,
) -> DataFrame:
    """``mapInArrow`` with state that each task makes once, and whose memory it gives back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in batches:
            yield from step(batch)
        del step
        give_back()

    return df.mapInArrow(run, schema)


def give_back() -> None:
    """Return freed memory to the machine: a worker that waits for its next task keeps it else, next
    to its executor."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)

