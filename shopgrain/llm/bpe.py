"""Byte-level BPE: texts to ids with character offsets, and ids back to bytes."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import (
    ArrayType, BinaryType, IntegerType, LongType, StringType, StructField, StructType,
)

from shopgrain.llm.common import per_batch
from shopgrain.llm.tokens import byte_decoder, byte_encoder

FLUSH = 16 << 20  # bytes of ids or text after which a task hands on what it has


def _parts(sizes: Iterable[int]) -> Iterable[tuple[int, int]]:
    """Row ranges of about ``FLUSH`` bytes."""
    first, held, at = 0, 0, 0
    for at, size in enumerate(sizes, 1):
        held += size
        if held >= FLUSH:
            yield first, at
            first, held = at, 0
    if first < at:
        yield first, at


def encode(
    df: DataFrame, ranks: str, pattern: str, text_col: str = "text", offsets: bool = False
) -> DataFrame:
    """``row`` (the input's columns), ``n_tokens``, ``ids`` (little-endian unsigned 32-bit integers)
    and, if asked for, ``spans`` (first character and the one after the last of each id).

    Each match of ``pattern`` is encoded by itself, without special tokens. Null is an empty text,
    which has no ids. Each distinct match is encoded once per task. Repeated rows get equal results;
    an empty table gives no rows.
    """
    src = df.select(F.struct("*").alias("row"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    out = StructType([
        src.schema["row"], StructField("n_tokens", LongType()), StructField("ids", BinaryType()),
    ])
    if offsets:
        out.add("spans", ArrayType(ArrayType(IntegerType())))

    def make():
        encoder = byte_encoder(ranks, pattern)

        def step(batch: pa.RecordBatch) -> Iterable[pa.RecordBatch]:
            texts = batch.column(1)
            sizes = (4 * len(t.as_buffer()) if t.is_valid else 0 for t in texts)
            for a, b in _parts(sizes):
                part = texts.slice(a, b - a).to_pylist()
                ids = [encoder.encode(t) for t in part]
                columns = [
                    batch.column(0).slice(a, b - a),
                    pa.array([len(i) // 4 for i in ids], pa.int64()), pa.array(ids, pa.binary()),
                ]
                if offsets:
                    spans = [[list(s) for s in encoder.offsets(t)] for t in part]
                    columns.append(pa.array(spans, pa.list_(pa.list_(pa.int32()))))
                yield pa.RecordBatch.from_arrays(columns, out.names)

        return step

    return per_batch(src, make, out)


def decode(df: DataFrame, ranks: str, ids_col: str = "ids") -> DataFrame:
    """``row`` (the input's columns) and ``decoded``, the bytes of the ids; null stays null.

    Bytes and not text: ids cut anywhere may begin or end inside a character (``decode_parts`` gives
    text). Unknown ids raise. Repeated rows get equal results; an empty table gives no rows.
    """
    src = df.select(F.struct("*").alias("row"), F.col(ids_col).alias("i"))
    out = StructType([src.schema["row"], StructField("decoded", BinaryType())])

    def make():
        decoder = byte_decoder(ranks)

        def step(batch: pa.RecordBatch) -> Iterable[pa.RecordBatch]:
            coded = batch.column(1)
            sizes = (len(i.as_buffer()) if i.is_valid else 0 for i in coded)
            for a, b in _parts(sizes):
                done = [
                    decoder.decode(np.frombuffer(i.as_buffer(), dtype="<u4").tolist())
                    if i.is_valid else None for i in coded.slice(a, b - a)
                ]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(done, pa.binary())], out.names
                )

        return step

    return per_batch(src, make, out)


def decode_parts(df: DataFrame, ranks: str, parts_col: str = "parts") -> DataFrame:
    """``row`` (the input's columns) and ``texts``, the text of each of ``parts_col``.

    The parts (an array of little-endian unsigned 32-bit ids as bytes) are consecutive pieces of one
    sequence, cut at any id. A character cut in two goes whole to the part with its last byte, so
    the texts joined are the text of the whole sequence. A null array stays null, an empty one has
    no texts, a null part is an empty one; unknown ids raise. An empty table gives no rows.
    """
    src = df.select(F.struct("*").alias("row"), F.col(parts_col).alias("p"))
    out = StructType([src.schema["row"], StructField("texts", ArrayType(StringType()))])

    def make():
        decoder = byte_decoder(ranks)

        def step(batch: pa.RecordBatch) -> Iterable[pa.RecordBatch]:
            coded = batch.column(1)
            sizes = (sum(len(i.as_buffer()) for i in p.values if i.is_valid) if p.is_valid else 0 for p in coded)
            for a, b in _parts(sizes):
                done = [
                    decoder.texts(np.frombuffer(i or b"", dtype="<u4").tolist() for i in p)
                    if p is not None else None for p in coded.slice(a, b - a).to_pylist()
                ]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(done, pa.list_(pa.string()))], out.names
                )

        return step

    return per_batch(src, make, out)
