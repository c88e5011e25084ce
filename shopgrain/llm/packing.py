"""Best-fit packing: length patterns by non-negative least squares, residuals by decreasing fit."""

from __future__ import annotations

import zlib
from collections.abc import Iterable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from shopgrain.llm.common import discard, per_batch, store
from shopgrain.llm.tokens import REMEMBERED, word_encoder

PARTNERS = 8  # second lengths tried with each first one, and third ones with each pair
STEPS = 200  # of the least-squares fit
SENT = 4 << 20  # bytes of ids after which a task sends what it has


def token_pieces(
    df: DataFrame, vocabulary: str, length: int = 4096, end_id: int = 1,
    id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True, remembered: int = REMEMBERED,
) -> DataFrame:
    """(id, piece, start, length, ids_crc32, ids): the texts' ids, an end id after each, in pieces of
    at most ``length``. Null texts are empty: one piece of the end id. Without ``with_ids`` the ids stay
    in the task; ``remembered`` bounds what a task remembers (see ``WordEncoder``)."""
    names = ["id", "piece", "start", "length", "ids_crc32", "ids"]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]

    def make():
        encode = word_encoder(vocabulary, remembered)
        end = end_id.to_bytes(4, "little")

        def sent(rows: list[tuple]) -> pa.RecordBatch:
            columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
            return pa.RecordBatch.from_arrays(columns, names[: len(columns)])

        def step(batch: pa.RecordBatch) -> Iterable[pa.RecordBatch]:
            rows: list[tuple] = []
            size = 0
            texts = (text.as_py() for text in batch.column(1))
            for key, ids in zip(batch.column(0).to_pylist(), encode(texts)):
                ids += end
                for piece, at in enumerate(range(0, len(ids), 4 * length)):
                    part = ids[at : at + 4 * length]
                    row = (key, piece, at // 4, len(part) // 4, zlib.crc32(part))
                    rows.append((*row, part) if with_ids else row)
                size += len(ids)
                if with_ids and size >= SENT:
                    yield sent(rows)
                    rows, size = [], 0
            if rows:
                yield sent(rows)

        return step

    src = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("t"))
    schema = "id long, piece int, start long, length long, ids_crc32 long"
    return per_batch(src, make, f"{schema}, ids binary" if with_ids else schema)


def enumerate_patterns(counts: np.ndarray, limit: int, partners: int = PARTNERS) -> np.ndarray:
    """Patterns of two to four present lengths that add up to ``limit`` exactly; zero pads a row.

    For each first length the most frequent and evenly spread partners are tried, and each rest is
    completed by a present length. Their number is bounded by ``limit`` and ``partners`` alone.
    """
    present = np.flatnonzero(counts[: limit])
    found: set[tuple[int, ...]] = set()
    if not len(present):
        return np.zeros((0, 4), dtype=np.int64)
    has = counts > 0

    def some(most: int) -> np.ndarray:
        fit = present[: np.searchsorted(present, most, "right")]
        if len(fit) <= partners:
            return fit
        spread = fit[np.linspace(0, len(fit) - 1, partners // 2).astype(int)]
        common = fit[np.argpartition(counts[fit], -partners // 2)[-(partners // 2):]]
        return np.union1d(spread, common)

    for a in present.tolist():
        if has[limit - a]:
            found.add(tuple(sorted((0, 0, a, limit - a))))
        for b in some(limit - a - 1).tolist():
            rest = limit - a - b
            if has[rest]:
                found.add(tuple(sorted((0, a, b, rest))))
            for c in some(rest - 1).tolist()[:: max(1, partners // 4)] if rest > 1 else ():
                if has[rest - c]:
                    found.add(tuple(sorted((a, b, c, rest - c))))
    return np.array(sorted(found), dtype=np.int64).reshape(-1, 4)


def fit_repeats(patterns: np.ndarray, counts: np.ndarray, steps: int = STEPS) -> np.ndarray:
    """Non-negative least squares: repeats x of the patterns so that they use ``counts`` documents of
    each length. Accelerated projected gradient; the columns have at most four entries."""
    used = (patterns > 0).astype(float)
    target = counts.astype(float)

    def uses(x: np.ndarray) -> np.ndarray:
        total = np.zeros(len(counts))
        for j in range(patterns.shape[1]):
            total += np.bincount(patterns[:, j], x * used[:, j], minlength=len(counts))
        return total

    def back(r: np.ndarray) -> np.ndarray:
        return (r[patterns] * used).sum(axis=1)

    probe = np.ones(len(patterns))
    for _ in range(20):  # the largest curvature, by power iteration
        probe = back(uses(probe))
        top = np.linalg.norm(probe)
        probe /= top
    rate, x, ahead, t = 1 / (1.02 * top), np.zeros(len(patterns)), np.zeros(len(patterns)), 1.0
    for _ in range(steps):
        new = np.maximum(0, ahead - rate * back(uses(ahead) - target))
        t_new = (1 + (1 + 4 * t * t) ** 0.5) / 2
        ahead, x, t = new + (t - 1) / t_new * (new - x), new, t_new
    return x


def plan(counts: np.ndarray, limit: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """(repeats, [(length, times), ...]) sequences that use up ``counts`` (documents by length).

    Rounded repeats of the fitted patterns, no more than the counts allow, then the residue by
    decreasing lengths: the fullest sequence that can be built greedily from the longest length on is
    repeated while its documents last. Steps are bounded by the number of lengths, not of documents.
    """
    left = counts.astype(np.int64).copy()
    out: list[tuple[int, list[tuple[int, int]]]] = []
    if left[limit]:
        out.append((int(left[limit]), [(limit, 1)]))
        left[limit] = 0
    patterns = enumerate_patterns(left, limit)
    if len(patterns):
        x = fit_repeats(patterns, left)
        for i in np.argsort(-x, kind="stable"):
            want = int(np.rint(x[i]))
            if want < 1:
                break
            parts = [(int(v), int(n)) for v, n in zip(*np.unique(patterns[i], return_counts=True)) if v]
            times = min([want] + [int(left[v]) // n for v, n in parts])
            if times > 0:
                out.append((times, parts[::-1]))
                for v, n in parts:
                    left[v] -= times * n
    while left.any():
        present = np.flatnonzero(left)
        room, parts = limit, []
        while room > 0:
            at = int(np.searchsorted(present, room, "right")) - 1
            if at < 0:
                break
            v = int(present[at])
            n = min(int(left[v]), room // v)
            parts.append((v, n))
            room -= n * v
            present = present[:at]
        times = min(int(left[v]) // n for v, n in parts)
        out.append((times, parts))
        for v, n in parts:
            left[v] -= times * n
    return out


def slots(planned: list[tuple[int, list[tuple[int, int]]]], limit: int) -> dict[str, np.ndarray]:
    """The plan by length: documents of a length, in any fixed order, from rank ``first`` on go to
    sequence ``sequence + r // times`` at ``offset + r % times * length``, r counted from ``first``."""
    rows, sequence = [], 0
    used = np.zeros(limit + 1, dtype=np.int64)
    for repeats, parts in planned:
        offset = 0
        for v, n in parts:
            rows.append((v, used[v], sequence, n, offset))
            used[v] += repeats * n
            offset += v * n
        sequence += repeats
    table = np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)
    return dict(zip(("length", "first", "sequence", "times", "offset"), table.T.copy()))


def pack(pieces: DataFrame, limit: int = 4096) -> DataFrame:
    """``pieces`` (stored; with id, piece and length columns) with ``sequence_id`` and ``offset``.

    Lengths are 1 to ``limit``. Only the histogram, at most ``limit`` rows, reaches the driver, and
    the plan made from it is bounded by ``limit`` too. Pieces are numbered within their length over
    chunks (a hash of id and piece), so a length that a third of all pieces have is numbered by many
    tasks. Repeated rows are pieces of their own. An empty table gives no rows.
    """
    spark = pieces.sparkSession
    chunks = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    counts = np.zeros(limit + 1, dtype=np.int64)
    for r in pieces.groupBy("length").count().collect():
        counts[r["length"]] = r["count"]
    made = slots(plan(counts, limit), limit)
    chunked = pieces.withColumn(
        "chunk", F.pmod(F.xxhash64("id", "piece"), F.lit(chunks)).cast("int")
    )
    sizes = chunked.groupBy("length", "chunk").count()
    before = Window.partitionBy("length").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    bases = store(
        sizes.select(
            "length", "chunk", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base")
        ),
        "chunk-bases",
    )
    within = Window.partitionBy("length", "chunk").orderBy("id", "piece", "ids_crc32")
    ranked = chunked.join(bases, ["length", "chunk"]).withColumn(
        "rank", F.row_number().over(within) - 1 + F.col("base")
    )
    order = made["length"] * (1 << 44) + made["first"] if len(made.get("length", ())) else None

    @F.pandas_udf("sequence_id long, offset long")
    def placed(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        at = np.searchsorted(order, length.to_numpy() * (1 << 44) + rank.to_numpy(), "right") - 1
        r = rank.to_numpy() - made["first"][at]
        return pd.DataFrame({
            "sequence_id": made["sequence"][at] + r // made["times"][at],
            "offset": made["offset"][at] + r % made["times"][at] * length.to_numpy(),
        })

    return ranked.withColumn("place", placed("length", "rank")).select(
        *pieces.columns, "place.sequence_id", "place.offset"
    )


def pack_documents(
    df: DataFrame, vocabulary: str, limit: int = 4096, with_ids: bool = True,
    remembered: int = REMEMBERED, **columns: str,
) -> DataFrame:
    """Token pieces of ``df`` packed into sequences of at most ``limit`` tokens."""
    pieces = token_pieces(
        df, vocabulary, limit, with_ids=with_ids, remembered=remembered, **columns
    )
    return pack(store(pieces, "pieces"), limit)
