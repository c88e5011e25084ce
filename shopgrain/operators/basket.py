"""Co-occurrence counts without pairing up the members of a huge basket."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from shopgrain.session import stored

BIG_BASKET = 500  # up to here a basket's pairs are cheap to list
TASK_PAIRS = 1 << 20  # listed by a task, which may hold them all to count them


def co_occurrence(
    members: DataFrame, basket: str, item: str, *, min_count: int, big_basket: int = BIG_BASKET
) -> DataFrame:
    """(item_a, item_b, co_occurrence_count) of the item pairs that share >= ``min_count`` baskets.

    ``members`` holds distinct (basket, item) rows and is read several times: give it a stored table,
    best without the items that are in fewer than ``min_count`` baskets.

    Order all baskets by size. Each item sits out of at most its ``min_count - 1`` largest baskets
    (those above ``big_basket``) while pairs are listed. Two items that share ``min_count`` baskets
    still meet: in the smallest basket they share, neither can be sitting out, as it would then sit
    out of every larger shared basket too. Pairs that met get the baskets sat out of added back by
    key lookups, so the counts are exact; a pair that never met is below the threshold.

    The baskets are dealt to so many tasks that each lists some ``TASK_PAIRS`` pairs: their number follows
    the pairs and not the bytes of the members, from which a task's pairs cannot be told.
    """
    m = members.select(F.col(basket).alias("_b"), F.col(item).alias("_i"))
    sizes = m.groupBy("_b").agg(F.count(F.lit(1)).alias("_size"))
    parts, largest = _parts(sizes)
    if min_count < 2 or largest <= big_basket:
        return _meetings(m.repartition(parts, "_b")).filter(F.col("co_occurrence_count") >= min_count)
    big = stored(sizes.filter(F.col("_size") > big_basket), "big_baskets")

    big_members = stored(m.join(big, "_b"), "big_basket_items")
    largest_first = Window.partitionBy("_i").orderBy(F.col("_size").desc(), "_b")
    # The rank filter is applied in the map tasks too, so a popular item ships few rows.
    sat_out = stored(
        big_members.withColumn("_rank", F.row_number().over(largest_first))
        .filter(F.col("_rank") <= min_count - 1)
        .select("_b", "_i"),
        "sat_out",
    )
    listed = m.join(sat_out, ["_b", "_i"], "left_anti")
    parts, _ = _parts(listed.groupBy("_b").agg(F.count(F.lit(1)).alias("_size")))
    met = stored(_meetings(listed.repartition(parts, "_b")), "pairs_met")
    added = (
        _sat_out_by(met, sat_out, "item_a", "item_b")
        .unionByName(_sat_out_by(met, sat_out, "item_b", "item_a"))
        .join(big_members.select("_b", F.col("_i").alias("_other")), ["_b", "_other"], "left_semi")
        .select("item_a", "item_b", "_b")
        .distinct()
        .groupBy("item_a", "item_b")
        .agg(F.count(F.lit(1)).alias("_added"))
    )
    count = F.col("co_occurrence_count") + F.coalesce(F.col("_added"), F.lit(0))
    return (
        met.join(added, ["item_a", "item_b"], "left")
        .select("item_a", "item_b", count.alias("co_occurrence_count"))
        .filter(F.col("co_occurrence_count") >= min_count)
    )


def _parts(sizes: DataFrame) -> tuple[int, int]:
    """Number of parts of which each lists some ``TASK_PAIRS`` pairs, and the size of the largest basket.
    A basket is in one part, so pairs beyond ``TASK_PAIRS`` of its own ask for no more parts."""
    size = F.col("_size").cast("double")
    pairs = F.sum(F.least(size * (size - 1) / 2, F.lit(float(TASK_PAIRS))))
    found = sizes.agg(pairs.alias("pairs"), F.max("_size").alias("largest")).first()
    least = sizes.sparkSession.sparkContext.defaultParallelism
    return max(least, int((found["pairs"] or 0) // TASK_PAIRS) + 1), found["largest"] or 0


def _meetings(m: DataFrame) -> DataFrame:
    """Item pairs (a < b) with the number of baskets both are listed in."""
    return (
        m.select("_b", F.col("_i").alias("item_a"))
        .join(m.select("_b", F.col("_i").alias("item_b")), "_b")
        .filter(F.col("item_a") < F.col("item_b"))
        .groupBy("item_a", "item_b")
        .agg(F.count(F.lit(1)).alias("co_occurrence_count"))
    )


def _sat_out_by(met: DataFrame, sat_out: DataFrame, one: str, other: str) -> DataFrame:
    """Each pair with the baskets ``one`` sat out of: fewer than ``min_count`` rows per pair."""
    return met.join(sat_out.withColumnRenamed("_i", one), one).select(
        "item_a", "item_b", "_b", F.col(other).alias("_other")
    )
