"""SimHash near duplicates: fingerprints, pigeonring-filtered links, components."""

from __future__ import annotations

from collections.abc import Iterable
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from shopgrain.llm.common import discard, per_batch, row_key, store, text_of, words_of
from shopgrain.llm.components import components

BITS = 64
MAX_BITS = 2  # links join fingerprints that differ in at most this many bits
SEGMENTS = 8  # of 8 bits each, in a ring
WIDTH = BITS // SEGMENTS
BUDGET = [MAX_BITS * n // SEGMENTS for n in range(SEGMENTS + 1)]  # for a chain of n segments
EXACT = max(n for n, most in enumerate(BUDGET) if most == 0)  # leading segments that must be equal
FULL_BUCKET = 64  # a fuller bucket is linked through shared one-bit neighbours


def _signs(hashes: np.ndarray) -> int:
    """Per bit, whether over half of the hashes set it; as a signed 64-bit integer."""
    count = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 14):
        part = hashes[at : at + (1 << 14)].reshape(-1, 1)
        bits = np.unpackbits(part.view(np.uint8), axis=1, bitorder="little")
        count += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(count * 2 > len(hashes), bitorder="little").view(np.int64)[0])


def shingle_fingerprint(text: str | None, size: int, seed: int) -> int:
    """The fingerprint over all ``size``-word shingles, repeats included."""
    words = words_of(text)
    words = [w.lower() for w in words]  # bytes: A-Z only
    if not words:
        return 0
    runs = [words[i:] for i in range(size)] if len(words) >= size else [[b" ".join(words)]]
    shingles = map(b" ".join, zip(*runs)) if len(runs) > 1 else runs[0]
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(seed)), dtype=np.uint64)
    return _signs(hashes)


def fingerprints(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3, seed: int = 42
) -> DataFrame:
    """(id, k1, k2, print): per row its ``row_key`` and the whole text's fingerprint over ``size``-word
    shingles. A text without words has fingerprint zero."""

    def make():
        def step(batch: pa.RecordBatch) -> Iterable[pa.RecordBatch]:
            prints = [shingle_fingerprint(t.as_py(), size, seed) for t in batch.column(3)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(prints, pa.int64())], ["id", "k1", "k2", "print"]
            )

        return step

    src = df.select(
        F.col(id_col).cast("long").alias("id"), *row_key(F.col(id_col), text_of(text_col)),
        F.col(text_col).cast("string").alias("t"),
    )
    return per_batch(src, make, "id long, k1 long, k2 long, print long")


def _rotated(col: str, segment: int) -> Column:
    """The fingerprint with ``segment`` first."""
    by = segment * WIDTH
    if not by:
        return F.col(col)
    return F.shiftleft(col, by).bitwiseOR(F.shiftrightunsigned(col, BITS - by))


def links(prints: DataFrame) -> DataFrame:
    """Links (a, b) among the distinct fingerprints ``prints`` (print): pairs within ``MAX_BITS``.

    Pigeonring: cut the fingerprint into a ring of segments. If two differ in t bits, some start has
    every chain of n following segments differ in at most t*n/SEGMENTS. The chains with budget zero
    are an equality join key; the longer chains prune its pairs before all bits are compared.

    A bucket of more than ``FULL_BUCKET`` fingerprints lists no pairs. Two fingerprints within two
    bits share a neighbour within one bit, and inside a bucket it differs outside the key only: each
    member names these neighbours, and members that name the same one (at most ``BITS`` of them) are
    linked if they are within the limit, which they are. Rows grow linearly; no link is lost.
    """
    starts = F.array(*[
        F.struct(F.lit(i).alias("start"), _rotated("print", i).alias("turned"))
        for i in range(SEGMENTS)
    ])
    rest = BITS - EXACT * WIDTH
    members = (
        prints.select(F.col("print").alias("node"), F.explode(starts).alias("at"))
        .select(
            "node", F.col("at.turned").alias("turned"),
            F.shiftleft(F.col("at.start").cast("long"), EXACT * WIDTH)
            .bitwiseOR(F.shiftrightunsigned("at.turned", rest)).alias("key"),
        )
    )
    counted = members.groupBy("key").count().where("count > 1")
    counted = store(counted, "buckets")
    some = counted.where(F.col("count") <= FULL_BUCKET).select("key")
    full = counted.where(F.col("count") > FULL_BUCKET).select("key")
    paired = store(members.join(some, "key", "left_semi"), "paired")
    x, y = paired.alias("x"), paired.alias("y")
    differ = F.col("x.turned").bitwiseXOR(F.col("y.turned"))
    within = (F.col("x.key") == F.col("y.key")) & (F.col("x.node") < F.col("y.node"))
    for n in range(EXACT + 1, SEGMENTS + 1):
        chain = F.shiftrightunsigned(differ, BITS - n * WIDTH) if n < SEGMENTS else differ
        within = within & (F.bit_count(chain) <= BUDGET[n])
    pairs = x.join(y, within).select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))
    flips = F.array(F.lit(0).cast("long"), *[F.lit(1 << i).cast("long") for i in range(rest)])
    shared = (
        members.join(full, "key", "left_semi")
        .select("key", "node", F.col("turned"), F.explode(flips).alias("flip"))
        .groupBy("key", F.col("turned").bitwiseXOR(F.col("flip")).alias("near"))
        .agg(F.min("node").alias("a"), F.collect_set("node").alias("nodes"))
        .where(F.size("nodes") > 1)
        .select("a", F.explode("nodes").alias("b")).where("a <> b")
    )
    found = store(pairs.union(shared).distinct(), "near")
    discard(counted, paired)
    return found


def near_duplicates(prints: DataFrame) -> DataFrame:
    """``fingerprints`` with ``component``, the least id reachable over links, and ``group``, the least
    fingerprint (signed) of the component: components that share a least id differ in it.

    Rows with the same fingerprint are one class, named by it, before anything is compared. Null ids
    take part; a component of null ids only has a null component. A repeated id is no error: each row
    has its text's component. An empty table gives no rows.
    """
    prints = store(prints, "prints")
    classes = store(prints.groupBy("print").agg(F.min("id").alias("least")), "classes")
    roots = components(links(classes.select("print")))
    named = store(
        classes.join(roots.withColumnRenamed("node", "print"), "print", "left").select(
            "print", "least", F.coalesce("root", "print").alias("group")
        ),
        "groups",
    )
    least = store(named.groupBy("group").agg(F.min("least").alias("component")), "components")
    found = store(named.join(least, "group").select("print", "component", "group"), "named")
    discard(classes, named, least)
    return prints.join(found, "print").select(*prints.columns, "component", "group")


def keep_one(df: DataFrame, size: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that stay when one row of each group of ``near_duplicates`` does: the one of the
    least id (null ids come last), then of the least row key. Repeated rows are one group; so are
    texts without words."""
    grouped = near_duplicates(fingerprints(df, id_col, text_col, size))
    first = F.min(F.struct(F.col("id").isNull().alias("last"), "id", "k1", "k2")).alias("first")
    stay = store(grouped.groupBy("group").agg(first).select("first.k1", "first.k2"), "survivors")
    rows = df.select(F.struct("*").alias("row"), *row_key(F.col(id_col), text_of(text_col)))
    return rows.join(stay, ["k1", "k2"]).dropDuplicates(["k1", "k2"]).select("row.*")
