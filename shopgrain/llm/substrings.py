"""Substring dedup: relative Lempel-Ziv factors over repeated word windows."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from shopgrain.llm.common import discard, per_batch, row_key, store, words_of

WINDOW = 35  # words that must repeat
SEED = 10  # words of a reference block's seed
FACTOR = ["start", "length", "source", "place"]
U = np.uint64


class RangeHash:
    """64-bit hashes of word ranges: differences of prefix sums, scaled back to the range's start."""

    def __init__(self, base: int) -> None:
        self.base, self.inverse = base | 1, pow(base | 1, -1, 1 << 64)
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def sums(self, words: np.ndarray) -> np.ndarray:
        if len(self.up) <= len(words):
            size = 2 * len(words) + 1
            steps = [np.full(size, U(b), dtype=np.uint64) for b in (self.base, self.inverse)]
            for s in steps:
                s[0] = 1
            self.up, self.down = (np.cumprod(s, dtype=np.uint64) for s in steps)
        out = np.zeros(len(words) + 1, dtype=np.uint64)
        np.cumsum(words * self.up[: len(words)], out=out[1:])
        return out

    def of(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((sums[end] - sums[start]) * self.down[start])


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(33))) * U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> U(33))) * U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U(33))


def word_hashes(words: list[bytes]) -> np.ndarray:
    joined = b"".join(map(xxhash.xxh3_64_digest, words))
    return np.frombuffer(joined, dtype=">u8").astype(np.uint64)


class Parser:
    """Cuts a document into reference blocks and hashes them.

    Of the seeds (runs of ``seed`` words) inside a window of ``window`` words, the one of least hash,
    the first of equals, stands for the window. A block is a run of windows that the same place
    stands for. Equal windows have equal seeds at equal offsets, wherever they are.
    """

    def __init__(self, window: int, seed: int) -> None:
        self.window, self.seed = window, seed
        self.first, self.second = RangeHash(0x9E3779B97F4A7C15), RangeHash(0xD1B54A32D192ED03)

    def prepare(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        hashes = word_hashes(words)
        one, two = self.first.sums(hashes), self.second.sums(mix(hashes ^ U(0x5851F42D4C957F2D)))
        at = np.arange(len(words) - self.seed + 1)
        return one, two, self.first.of(one, at, at + self.seed)

    def blocks(self, words: list[bytes]) -> tuple[np.ndarray, ...] | None:
        """start, number of windows, seed hash, block hash of each block."""
        n = len(words) - self.window + 1
        if n < 1:
            return None
        _, two, seeds = self.prepare(words)
        spans = np.lib.stride_tricks.sliding_window_view(seeds, self.window - self.seed + 1)
        anchor = spans.argmin(axis=1) + np.arange(n)
        start = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
        end = np.append(start[1:], n)
        place = ((anchor[start] - start) << 16) + (end - start)
        whole = mix(self.second.of(two, start, end + self.window - 1) ^ place.astype(np.uint64))
        return start, end - start, seeds[anchor[start]], whole

    def windows(self, words: list[bytes], start: np.ndarray, count: np.ndarray) -> tuple:
        """For each block: index of the block, window start, window hash."""
        _, two, _ = self.prepare(words)
        block = np.repeat(np.arange(len(start)), count)
        inside = np.arange(len(block)) - np.repeat(np.cumsum(count) - count, count)
        at = start[block] + inside
        return block, at, self.second.of(two, at, at + self.window)


def _columns(*parts: list[np.ndarray]) -> list[pa.Array]:
    return [pa.array(np.concatenate(p) if p else np.zeros(0, dtype=np.int64)) for p in parts]


def reference_blocks(src: DataFrame, window: int, seed: int) -> DataFrame:
    """(k1, k2, start, n, seed, block): every block of every text of ``src`` (k1, k2, text)."""

    def make():
        parser = Parser(window, seed)

        def step(batch: pa.RecordBatch) -> Iterable[pa.RecordBatch]:
            out: list[list[np.ndarray]] = [[] for _ in range(6)]
            k1, k2 = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            for i, text in enumerate(batch.column(2)):
                found = parser.blocks(words_of(text.as_py()))
                if found is None:
                    continue
                start, n, seeds, whole = found
                row = (
                    np.full(len(start), k1[i]), np.full(len(start), k2[i]), start.astype(np.int32),
                    n.astype(np.int32), seeds.view(np.int64), whole.view(np.int64),
                )
                for column, values in zip(out, row):
                    column.append(values)
            if out[0]:
                yield pa.RecordBatch.from_arrays(
                    _columns(*out), ["k1", "k2", "start", "n", "seed", "block"]
                )

        return step

    return per_batch(src, make, "k1 long, k2 long, start int, n int, seed long, block long")


def _edge_windows(src: DataFrame, chosen: DataFrame, window: int, seed: int) -> DataFrame:
    """(k1, k2, start, at, seed, copies, whash): each window of the chosen blocks."""
    listed = chosen.groupBy("k1", "k2").agg(
        F.collect_list(F.struct("start", "n", "seed", "copies")).alias("blocks")
    )

    def make():
        parser = Parser(window, seed)

        def step(batch: pa.RecordBatch) -> Iterable[pa.RecordBatch]:
            for i in range(batch.num_rows):
                blocks = batch.column(3)[i].values
                start, n, seeds, copies = (
                    blocks.field(j).to_numpy(zero_copy_only=False) for j in range(4)
                )
                words = words_of(batch.column(2)[i].as_py())
                block, at, hashes = parser.windows(words, start.astype(np.int64), n)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(at), batch.column(0)[i].as_py())),
                        pa.array(np.full(len(at), batch.column(1)[i].as_py())),
                        pa.array(start[block]), pa.array((at - start[block]).astype(np.int32)),
                        pa.array(seeds[block]), pa.array(copies[block]),
                        pa.array(hashes.view(np.int64)),
                    ],
                    ["k1", "k2", "start", "at", "seed", "copies", "whash"],
                )

        return step

    return per_batch(
        src.join(listed, ["k1", "k2"]).select("k1", "k2", "text", "blocks"), make,
        "k1 long, k2 long, start int, at int, seed long, copies long, whash long",
    )


def repeated_windows(src: DataFrame, window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """(k1, k2, spans): for each text with repeated windows, runs (start, windows, source, place) of
    their starts; the windows stand also at ``place`` of the text whose ``k1`` is ``source``.

    1. Index: every block of every document, by its seed's hash. Seeds that occur once drop out.
    2. Whole blocks that occur more than once are factors: all their windows are repeated. The index
       names the first and the last place of each; the source is the first, for the first itself the
       last. Places are in one order throughout, so blocks in a row tend to have sources in a row.
    3. Factor boundaries: where a seed occurs in different blocks, one occurrence of each lists its
       windows, and windows of equal hash are counted, a block with its number of copies.
    Rows grow with the blocks and boundaries, not with pairs of copies; counts are partial before
    their shuffles, and joins read written tables, so a seed or passage of a third of all documents
    is split. Equality is by two 64-bit hashes throughout.
    """
    blocks = store(reference_blocks(src, window, seed), "blocks")
    again = store(blocks.groupBy("seed").count().where("count > 1").select("seed"), "seeds")
    found = store(blocks.join(again, "seed", "left_semi"), "candidates")
    discard(blocks, again)
    order = _order("start")
    kinds = store(
        found.groupBy("seed", "block").agg(
            F.count("*").alias("copies"), F.max("n").alias("n"), F.min_by("k2", order).alias("k2"),
            *_ends(order),
        ).withColumns({"k1": F.col("first_text"), "start": _start("first_place")}),
        "kinds",
    )
    mixed = store(
        kinds.groupBy("seed").count().where("count > 1").select("seed"), "mixed-seeds"
    )
    edges = store(kinds.join(mixed, "seed", "left_semi"), "edge-blocks")
    listed = store(_edge_windows(src, edges, window, seed), "edge-windows")
    twice = store(
        listed.groupBy("seed", "whash")
        .agg(F.sum("copies").alias("total"), *_ends(_order(F.col("start") + F.col("at"))))
        .where("total > 1").drop("total"),
        "repeated-windows",
    )
    whole = store(
        kinds.where("copies > 1").select("seed", "block", *ENDS), "factors"
    )
    runs = found.join(whole, ["seed", "block"])
    single = (
        listed.where("copies = 1").join(twice, ["seed", "whash"])
        .withColumns({"start": F.col("start") + F.col("at"), "n": F.lit(1)})
    )
    run = ["k1", "k2", "start", "n", *_source()]
    spans = store(
        runs.select(*run).union(single.select(*run)).groupBy("k1", "k2")
        .agg(F.collect_set(F.struct("start", "n", "source", "place")).alias("spans")),
        "spans",
    )
    discard(found, kinds, mixed, edges, listed, twice, whole)
    return spans


ENDS = ["first_text", "first_place", "last_text", "last_place"]


def _order(start: str | Column) -> Column:
    """One number for a place: the text's hash above, the start in the low 31 bits."""
    return F.col("k1").bitwiseAND(~0x7FFFFFFF).bitwiseOR(
        (F.col(start) if isinstance(start, str) else start).cast("long")
    )


def _start(place: str) -> Column:
    return F.col(place).bitwiseAND(0x7FFFFFFF).cast("int")


def _ends(order: Column) -> list[Column]:
    """The first and the last place by ``order``, as numbers only, so that they are hash-aggregated."""
    return [
        F.min_by("k1", order).alias("first_text"), F.min(order).alias("first_place"),
        F.max_by("k1", order).alias("last_text"), F.max(order).alias("last_place"),
    ]


def _source() -> list[Column]:
    own = (F.col("k1") == F.col("first_text")) & (F.col("start") == _start("first_place"))
    return [
        F.when(own, F.col("last_text")).otherwise(F.col("first_text")).alias("source"),
        F.when(own, _start("last_place")).otherwise(_start("first_place")).alias("place"),
    ]


def parse_factors(
    start: np.ndarray, n: np.ndarray, source: np.ndarray, place: np.ndarray, window: int
) -> list[dict]:
    """Factors from left to right: each is prolonged over the runs that follow it without a gap as long
    as its source goes on at the same distance. ``length`` words from ``start`` on equal those of the
    text ``source`` from ``place`` on. Neighbours share up to ``window - 1`` words at their boundary:
    the windows across it are repeated too, or the next factor would not begin there."""
    order = np.argsort(start, kind="stable")
    start, n, source, place = (x[order].astype(np.int64) for x in (start, n, source, place))
    goes_on = (
        (start[1:] == start[:-1] + n[:-1]) & (source[1:] == source[:-1])
        & (place[1:] - start[1:] == place[:-1] - start[:-1])
    )
    first = np.flatnonzero(np.concatenate([[True], ~goes_on]))
    last = np.append(first[1:], len(start)) - 1
    length = start[last] + n[last] + window - 1 - start[first]
    return [
        {"start": a, "length": m, "source": s, "place": p}
        for a, m, s, p in zip(*(x.tolist() for x in (start[first], length, source[first], place[first])))
    ]


def merge_spans(start: np.ndarray, n: np.ndarray, window: int) -> list[tuple[int, int]]:
    """Word ranges covered by the windows; ranges that touch or overlap become one factor."""
    order = np.argsort(start, kind="stable")
    start, end = start[order].astype(np.int64), (start + n + window - 1)[order].astype(np.int64)
    reach = np.maximum.accumulate(end)
    first = np.flatnonzero(np.concatenate([[True], start[1:] > reach[:-1]]))
    last = np.append(first[1:], len(start)) - 1
    return list(zip(start[first].tolist(), reach[last].tolist()))


def drop_repeated_passages(
    df: DataFrame, text_col: str = "text", id_col: str = "doc_id", window: int = WINDOW,
    seed: int = SEED, tidy: bool = True,
) -> DataFrame:
    """``row`` (the input's columns), ``key``, ``kept``, ``n_words``, ``n_removed``, ``factors``.

    Each word goes that is covered by a window of ``window`` words whose sequence also starts
    anywhere else, in the same text too; windows are judged on the input. ``factors`` lists
    the copied word ranges (start, length, source, place): the same words stand at ``place`` of the row
    whose ``key`` is ``source``. Every removed word is in one. A row that occurs only as repeats of
    itself is its own source. ``kept`` has the remaining words joined by one space; with ``tidy=False``
    a text that loses nothing stays as it is. Null and short texts lose nothing (null: no words).
    Repeated rows are copies of each other like any others. An empty table gives no rows.
    """
    if not 0 < seed <= window < 1 << 15:
        raise ValueError("0 < seed <= window < 32768")
    keys = row_key(F.col(id_col), F.col(text_col))
    src = df.select(*keys, F.col(text_col).cast("string").alias("text"))
    spans = repeated_windows(src, window, seed)

    def make():
        def step(batch: pa.RecordBatch) -> Iterable[pa.RecordBatch]:
            kept, total, gone, factors = [], [], [], []
            for text, runs in zip(batch.column(2), batch.column(3)):
                text = text.as_py()
                words, cut, found = words_of(text), [], []
                if runs.is_valid:
                    columns = [runs.values.field(j).to_numpy(zero_copy_only=False) for j in range(4)]
                    cut = merge_spans(*columns[:2], window)
                    found = parse_factors(*columns, window)
                total.append(len(words))
                gone.append(sum(b - a for a, b in cut))
                factors.append(found)
                if not cut and not tidy:
                    kept.append(text)
                    continue
                for a, b in reversed(cut):
                    del words[a:b]
                kept.append(b" ".join(words).decode("utf-8", "surrogatepass"))
            kind = pa.list_(pa.struct([(name, pa.int64()) for name in FACTOR]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), pa.array(kept, pa.string()), pa.array(total, pa.int64()),
                    pa.array(gone, pa.int64()), pa.array(factors, kind),
                ],
                ["row", "key", "kept", "n_words", "n_removed", "factors"],
            )

        return step

    rows = df.select(F.struct("*").alias("row"), *keys, F.col(text_col).cast("string").alias("t"))
    joined = rows.join(spans, ["k1", "k2"], "left").select("row", F.col("k1").alias("key"), "t", "spans")
    factor = StructType([StructField(name, LongType()) for name in FACTOR])
    out = StructType([
        joined.schema["row"], joined.schema["key"], StructField("kept", StringType()), StructField("n_words", LongType()),
        StructField("n_removed", LongType()), StructField("factors", ArrayType(factor)),
    ])
    return per_batch(joined, make, out)
