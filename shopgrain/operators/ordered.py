"""Row numbers, ranks, running sums and neighbours that stay distributed whatever a group's size.

A plain window sends a whole group to one task. Here all rows are dealt out by ranges of (group, order
key), so a task holds a share of the rows and not a group; the window runs per (range, group), and a
group that goes on in a later range adds what its earlier ranges hold. At each border between two
ranges at most one group goes on, so that correction is a table of at most two rows per range. No
size is tested: a group of two rows and one of all rows take the same path.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from shopgrain.functions.numeric import exact_sum, money
from shopgrain.session import stored


def ordered(
    df: DataFrame,
    group: str | None,
    order: Sequence[tuple[str, str]],
    *,
    row_number: str | None = None,
    rank: str | None = None,
    running: Mapping[str, str] | None = None,
    totals: Mapping[str, str] | None = None,
    lag: Mapping[str, str] | None = None,
    lead: Mapping[str, str] | None = None,
    ranges: int | None = None,
    ties: Sequence[str] | None = None,
    whole: bool = False,
) -> DataFrame:
    """Add ordered columns per ``group`` (the whole table when None).

    ``order`` lists (column, "asc" | "desc"), NULLs first for asc and last for desc; ``running``
    and ``totals`` map an output name to the money column summed, ``lag`` and ``lead`` to the column
    whose value in the row before or after is given. Rows that tie in ``order`` come in the order of a
    hash of the row (of its columns ``ties``), so ties are split over ranges too; ``rank`` counts them as equal.

    The number of ranges is Spark's number of shuffle partitions, which adaptive execution fits to the
    size of the data, or ``ranges``. The rows are stored once in ranges and shuffled once more by
    (range, group). Runs jobs. An empty table gives no rows.

    ``whole``: no group is heavy (``heavy_keys``), so a task orders whole groups. Nothing is stored and no job
    runs; rows that are dealt out by the group (``repartition``) stay where they are, others are shuffled once.
    """
    running, totals, lag, lead = (dict(m or {}) for m in (running, totals, lag, lead))
    cols = df.columns
    # All of these follow from the row, so they are computed where they are needed and not shuffled and
    # stored beside it.
    g, keys, tie = F.lit(0) if group is None else F.col(group), _order_keys(order), F.xxhash64(*(ties or cols))
    if whole:
        within = Window.partitionBy(g)
        ranked, in_order = (within.orderBy(*by) for by in (keys.values(), (*keys.values(), tie)))
        return _whole(df, within, ranked, in_order, row_number, rank, running, totals, lag, lead)
    place = [c.asc_nulls_first() for c in (g, *keys.values(), tie)]
    dealt = df.repartitionByRange(*([ranges] if ranges else []), *(place if group else place[1:]))
    pieces = stored(dealt.withColumn("_p", F.spark_partition_id()), "ranges")
    key = F.struct(*[c.alias(n) for n, c in keys.items()])
    row_key = F.struct(*[c.alias(n) for n, c in keys.items()], tie.alias("_tie"))

    offsets = _offsets(pieces, g, key, row_key, running, totals, rank, lag, lead)
    within = Window.partitionBy("_p", *([g] if group else []))
    in_order = within.orderBy(*place[1:])
    so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    added: dict[str, Column] = {"_n": F.row_number().over(in_order)}
    if rank:
        added["_rank"] = F.rank().over(within.orderBy(*place[1:-1]))
    for name, value in running.items():
        added[name] = exact_sum(value, so_far)
    for name, value in totals.items():
        added[name] = exact_sum(value, within)
    for name, value in lag.items():
        added[f"_lag_{name}"] = F.lag(value).over(in_order)
    for name, value in lead.items():
        added[f"_lead_{name}"] = F.lead(value).over(in_order)
    if lead:
        added["_size"] = F.count(F.lit(1)).over(within)
    local = pieces.withColumns(added)

    joined = local.join(
        offsets, (F.col("_p") == F.col("_op")) & g.eqNullSafe(F.col("_og")), "left"
    )
    ahead = F.coalesce(F.col("_n0"), F.lit(0))
    final = {c: F.col(c) for c in cols}
    if row_number:
        final[row_number] = F.col("_n") + ahead
    if rank:
        goes_on = F.col("_ties").isNotNull() & (key == F.col("_w_first"))
        final[rank] = F.when(goes_on, ahead - F.col("_ties") + 1).otherwise(F.col("_rank") + ahead)
    for name in running:
        own, prior = F.col(name), F.col(f"_o_{name}")
        final[name] = money(
            F.when(own.isNull(), prior).otherwise(own + F.coalesce(prior, F.lit(0)))
        )
    for name in totals:
        final[name] = money(
            F.when(F.col("_op").isNull(), F.col(name)).otherwise(F.col(f"_o_{name}"))
        )
    for name in lag:
        final[name] = F.when(F.col("_n") == 1, F.col(f"_w_before.{name}")).otherwise(F.col(f"_lag_{name}"))
    for name in lead:
        final[name] = F.when(F.col("_n") == F.col("_size"), F.col(f"_w_after.{name}")).otherwise(
            F.col(f"_lead_{name}")
        )
    return joined.select(*[c.alias(n) for n, c in final.items()])


def _whole(
    df: DataFrame,
    within: WindowSpec,
    ranked: WindowSpec,
    in_order: WindowSpec,
    row_number: str | None,
    rank: str | None,
    running: Mapping[str, str],
    totals: Mapping[str, str],
    lag: Mapping[str, str],
    lead: Mapping[str, str],
) -> DataFrame:
    so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    added: dict[str, Column] = {}
    if row_number:
        added[row_number] = F.row_number().over(in_order)
    if rank:
        added[rank] = F.rank().over(ranked)
    added |= {name: money(exact_sum(value, so_far)) for name, value in running.items()}
    added |= {name: money(exact_sum(value, within)) for name, value in totals.items()}
    added |= {name: F.lag(value).over(in_order) for name, value in lag.items()}
    added |= {name: F.lead(value).over(in_order) for name, value in lead.items()}
    return df.select(*df.columns, *[c.alias(n) for n, c in added.items()])


def _order_keys(order: Sequence[tuple[str, str]]) -> dict[str, Column]:
    """Ascending sort keys; a descending number becomes (is NULL, negated)."""
    keys: dict[str, Column] = {}
    for i, (name, way) in enumerate(order):
        if way == "desc":
            keys[f"_k{i}_null"] = F.col(name).isNull()
            keys[f"_k{i}"] = -F.col(name)
        else:
            keys[f"_k{i}"] = F.col(name)
    return keys


def _offsets(
    pieces: DataFrame,
    g: Column,
    key: Column,
    row_key: Column,
    running: Mapping[str, str],
    totals: Mapping[str, str],
    rank: str | None,
    lag: Mapping[str, str],
    lead: Mapping[str, str],
) -> DataFrame:
    """What the earlier ranges of a group hold, a row for each further range it goes on in (and for
    each of its ranges where a total or a following row is asked for): a prefix scan over ranges.

    Only groups at the end of a range can go on, so only their rows are added up. The scan of one
    group has at most one row per range.
    """
    ends = pieces.groupBy("_p").agg(
        F.min(F.struct(g.alias("_g"))).alias("low"), F.max(F.struct(g.alias("_g"))).alias("high")
    )
    seen = ends.select("_p", F.explode(F.array_distinct(F.array("low", "high"))).alias("e"))
    across = stored(
        seen.groupBy(F.col("e._g").alias("_xg")).agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("_xg"),
        "across",
    )
    parts = pieces.join(across, g.eqNullSafe(F.col("_xg")), "left_semi")
    sums = {**running, **totals}
    last = [F.max_by(F.struct(*[F.col(v).alias(n) for n, v in lag.items()]), row_key).alias("_last_row")]
    first = [F.min_by(F.struct(*[F.col(v).alias(n) for n, v in lead.items()]), row_key).alias("_first_row")]
    held = stored(
        parts.groupBy(F.col("_p").alias("_op"), g.alias("_og")).agg(
            F.count(F.lit(1)).alias("_n"),
            F.min(key).alias("_w_first"),
            *[exact_sum(v).alias(f"_s_{n}") for n, v in sums.items()],
            *(last if lag else []),
            *(first if lead else []),
        ),
        "held",
    )
    whole = Window.partitionBy("_og")
    in_order = whole.orderBy("_op")
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    offsets = held.select(
        "_op",
        "_og",
        "_w_first",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n0"),
        *[F.sum(f"_s_{n}").over(before).alias(f"_o_{n}") for n in running],
        *[F.sum(f"_s_{n}").over(whole).alias(f"_o_{n}") for n in totals],
        *([F.lag("_last_row").over(in_order).alias("_w_before")] if lag else []),
        *([F.lead("_first_row").over(in_order).alias("_w_after")] if lead else []),
    )
    if rank:
        # Rows of earlier ranges that tie with a range's first row.
        firsts = held.select("_og", "_w_first").distinct()
        tied = (
            parts.withColumn("_key", key)
            .join(firsts, g.eqNullSafe(F.col("_og")) & F.col("_key").eqNullSafe(F.col("_w_first")))
            .groupBy(F.col("_og").alias("_tg"), F.col("_w_first").alias("_tf"), F.col("_p").alias("_tp"))
            .agg(F.count(F.lit(1)).alias("_t"))
        )
        offsets = offsets.join(
            tied,
            F.col("_og").eqNullSafe(F.col("_tg"))
            & F.col("_w_first").eqNullSafe(F.col("_tf"))
            & (F.col("_tp") < F.col("_op")),
            "left",
        ).groupBy(*offsets.columns).agg(F.coalesce(F.sum("_t"), F.lit(0)).alias("_ties"))
    return stored(offsets, "offsets")
