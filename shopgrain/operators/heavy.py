"""Keys that hold a large share of a table's rows.

Where no key is heavy, rows that are dealt out by it once (``repartition(key)``) are reduced, joined and ordered
by it in place. A heavy key would leave one task with its rows, so its rows take steps that split it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

HEAVY = 1000  # a key with more than one in so many rows is heavy; so there are fewer heavy keys than that
TRACKED = 10_000  # keys that the sketch follows: it misses none that has more than some 2 in so many rows


def heavy_keys(df: DataFrame, key: str) -> list[int]:
    """Hashes of the heavy values of ``key``, NULL too. A sketch of frequent items over all rows: it reads that
    one column, and no heavy key is missed. Runs a job."""
    seen = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.call_function("approx_top_k", F.xxhash64(key), F.lit(HEAVY), F.lit(TRACKED)).alias("top"),
    ).first()
    return sorted(k["item"] for k in seen["top"] if k["count"] * HEAVY > seen["n"])


def is_heavy(key: str, heavy: Sequence[int]) -> Column:
    return F.xxhash64(key).isin(*heavy)


def apart(
    df: DataFrame,
    key: str,
    heavy: Sequence[int],
    light: Callable[[DataFrame], DataFrame],
    split: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """``light`` of the rows without a heavy key, and ``split`` of the others where there are any."""
    if not heavy:
        return light(df)
    return light(df.filter(~is_heavy(key, heavy))).unionByName(split(df.filter(is_heavy(key, heavy))))
