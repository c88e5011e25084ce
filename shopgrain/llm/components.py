"""Connected components of a table of links, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shopgrain.llm.common import discard, store


def _stars(edges: DataFrame, name: str, keep_hub: bool) -> DataFrame:
    """Hang the ``b`` of each ``a`` on the least vertex next to ``a``; edges as (larger, smaller)."""
    least = store(edges.groupBy("a").agg(F.min("b").alias("low")), name)
    joined = edges.join(least, "a")
    if keep_hub:  # small star: b are all below a; a itself moves to the least too
        moved = joined.where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        moved = moved.union(least.select("a", F.col("low").alias("b")))
    else:  # large star: only neighbours above a move
        low = F.least("a", "low")
        moved = joined.where((F.col("b") > F.col("a")) & (F.col("b") != low)).select(
            F.col("b").alias("a"), low.alias("b")
        )
    out = store(moved.distinct(), name)
    discard(least)
    return out


def _mark(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))"), F.sum(F.col("a") % 1_000_003)).first()
    )


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every vertex that has a link and is not its component's least vertex.

    ``edges`` has two long columns ``a``, ``b``; repeats, loops and null ends are ignored. Each round
    moves every vertex to the least vertex next to it, twice; the number of rounds grows with the
    logarithm of the longest path. A round is two partial minima and two joins whose sides are read
    from written tables, so a vertex with many links is split. Only two counters reach the driver.
    """
    links = edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    links = store(links.distinct(), "links")
    seen = _mark(links)
    while seen[0]:
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _stars(both, "large-star", keep_hub=False)
        small = _stars(large, "small-star", keep_hub=True)
        discard(links, large)
        links, before, seen = small, seen, _mark(small)
        if seen == before:
            break
    return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
