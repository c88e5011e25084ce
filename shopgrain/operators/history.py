"""Latest row per key and type-2 history, also from versions that come late or several at once."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

from shopgrain.functions import row_hash, run_time
from shopgrain.operators.ordered import ordered
from shopgrain.session import stored


def latest_per_key(df: DataFrame, key: str | Sequence[str], newest: str) -> DataFrame:
    """The row with the greatest ``newest`` per key; equal times are decided by a row hash.

    The ``<= 1`` filter lets Spark keep one row per key in each map task before the shuffle, so a
    key that holds most of the rows sends a handful of them.
    """
    keys = [key] if isinstance(key, str) else list(key)
    order = Window.partitionBy(*keys).orderBy(
        F.col(newest).desc_nulls_last(), F.xxhash64(*df.columns).desc()
    )
    return df.withColumn("_row", F.row_number().over(order)).filter("_row <= 1").drop("_row")


def scd2_apply(
    dim: DataFrame,
    updates: DataFrame,
    key: str,
    tracked: Sequence[str],
    as_of: datetime | date | str | None = None,
) -> DataFrame:
    """New state of a type-2 dimension after one batch of ``updates`` (one row per key).

    A new key starts version 1; a changed key closes its current version and opens the next; an
    unchanged key and all closed versions stay as they are.
    """
    return dim.filter(~F.col("is_current")).unionByName(
        scd2_current(dim, updates, key, tracked, as_of)
    )


def scd2_current(
    dim: DataFrame,
    updates: DataFrame,
    key: str,
    tracked: Sequence[str],
    as_of: datetime | date | str | None = None,
) -> DataFrame:
    """The part of the new state that comes from the current versions: those kept, those closed by
    this batch, and the new ones. Versions closed earlier are neither read nor returned."""
    now = run_time(as_of)
    carried = [c for c in updates.columns if c in dim.columns and c != key]
    incoming = updates.select(
        F.col(key).alias("_u_key"),
        row_hash(tracked).alias("_u_hash"),
        *[F.col(c).alias(f"_u_{c}") for c in carried],
    )
    both = dim.filter("is_current").join(incoming, F.col(key) == F.col("_u_key"), "full_outer")
    known = F.col(key).isNotNull()
    changed = F.col("_u_key").isNotNull() & (
        ~known | (F.coalesce(F.col("_hash_key"), F.lit("")) != F.col("_u_hash"))
    )
    closing = known & changed
    kept = {
        "effective_end_date": F.when(closing, now).otherwise(F.col("effective_end_date")),
        "is_current": ~closing,
    }
    opened = {
        key: F.col("_u_key"),
        "effective_start_date": now,
        "effective_end_date": F.lit(None),
        "is_current": F.lit(True),
        "version": F.coalesce(F.col("version"), F.lit(0)) + 1,
        "_processed_timestamp": now,
        "_hash_key": F.col("_u_hash"),
        **{c: F.col(f"_u_{c}") for c in carried},
    }

    def row(values: dict) -> Column:
        return F.struct(
            *[
                values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
                for f in dim.schema.fields
            ]
        )

    old_row = F.when(known, row({**{c: F.col(c) for c in dim.columns}, **kept}))
    new_row = F.when(changed, row(opened))
    return both.select(F.inline(F.filter(F.array(old_row, new_row), lambda r: r.isNotNull())))


def assign_surrogate(
    dim: DataFrame,
    sk: str,
    order: Sequence[str],
    above: Column | None = None,
    **splitting: int | None,
) -> DataFrame:
    """Number the rows whose surrogate key is NULL from the largest key on, in ``order``; ``above``
    is the largest one where ``dim`` is a part of the dimension.

    Reads ``dim`` several times: give it a stored or checkpointed table.
    """
    top = dim.agg(F.coalesce(F.max(sk), F.lit(0)).cast("bigint")).scalar() if above is None else above
    numbered = ordered(
        dim.filter(F.col(sk).isNull()),
        None,
        [(c, "asc") for c in order],
        row_number="_n",
        **splitting,
    )
    return dim.filter(F.col(sk).isNotNull()).unionByName(
        numbered.withColumn(sk, (F.col("_n") + top).cast(dim.schema[sk].dataType)).drop("_n")
    )


def version_history(
    versions: DataFrame, key: str, tracked: Sequence[str], time: str, *, ranges: int | None = None
) -> DataFrame:
    """Type-2 history from all known versions of each key, in any order and with repeats.

    A version that differs in a ``tracked`` column from the one before it in ``time`` opens an interval
    (``effective_start_date``, ``effective_end_date``, ``version`` from 1, ``is_current``, ``_hash_key``); one
    that does not is left out. Of several versions of a key at one time that with the greatest hash
    counts. Neighbours are compared over ranges of (key, time), so a key that most versions belong to is
    split over tasks. A NULL key is a key like others; a NULL time comes first. Runs jobs.
    """
    hashed = versions.withColumn("_hash_key", row_hash(tracked))
    single = latest_per_key(hashed, [key, time], "_hash_key")
    seen = ordered(single, key, [(time, "asc")], lag={"_before": "_hash_key"}, ranges=ranges)
    opened = seen.filter(~F.col("_hash_key").eqNullSafe(F.col("_before"))).drop("_before")
    whole = ordered(
        opened, key, [(time, "asc")], row_number="version", lead={"effective_end_date": time, "_after": "_hash_key"},
        ranges=ranges,
    )
    return whole.withColumns(
        {
            "effective_start_date": F.col(time),
            "is_current": F.col("_after").isNull(),
            "version": F.col("version").cast("int"),
        }
    ).drop("_after")


def scd2_splice(
    dim: DataFrame,
    batch: DataFrame,
    log: DataFrame,
    key: str,
    tracked: Sequence[str],
    time: str,
    as_of: datetime | date | str | None = None,
    *,
    ranges: int | None = None,
) -> DataFrame:
    """New state of a type-2 dimension after a ``batch`` that may hold several versions of a key, and
    versions older than those known.

    ``log`` holds all versions so far, the batch's too (the raw customer table). For each key of the
    batch the intervals from the last one that starts before its earliest new version are computed
    again from the log; earlier ones and other keys stay. So a late version closes the interval that
    it falls into and opens its own, a version at a known time is taken once, and a batch may be given
    again. The result is that of ``version_history`` over the whole log, whatever came in which batch.

    Rows whose start and hash stay keep their surrogate key and, unless their end or number moves,
    their processing time. Columns of ``dim`` that neither the log nor the history has are NULL in new rows.
    """
    earliest = stored(
        batch.groupBy(F.col(key).alias("_b_key")).agg(F.min(F.struct(F.col(time).alias("t"))).alias("_b")), "earliest"
    )
    same_key = F.col(key).eqNullSafe(F.col("_b_key"))
    start = F.col("effective_start_date")
    before = F.col("_b.t").isNotNull() & (start.isNull() | (start < F.col("_b.t")))
    seeds = stored(
        dim.select(key, "effective_start_date", "version")
        .join(earliest, same_key, "right")
        .groupBy("_b_key")
        .agg(
            F.max(F.when(before & F.col("version").isNotNull(), F.struct(start.alias("start"), "version"))).alias("_seed")
        ),
        "seeds",
    )
    known = F.col("_seed").isNotNull()
    again = ~known | F.col("_seed.start").isNull() | (start >= F.col("_seed.start"))
    joined = dim.join(seeds.withColumn("_joined", F.lit(True)), same_key, "left")
    replaced = F.coalesce(F.col("_joined") & F.coalesce(again, F.lit(True)), F.lit(False))
    kept = joined.filter(~replaced).select(*dim.columns)
    old = joined.filter(replaced).select(*[F.col(c).alias(f"_old_{c}") for c in dim.columns])

    points = log.join(seeds, same_key).filter(
        ~known | F.col("_seed.start").isNull() | (F.col(time) >= F.col("_seed.start"))
    )
    columns = [c for c in log.columns if c != "version"]
    first = F.coalesce(F.col("_seed.version"), F.lit(1)).alias("_from_version")
    spliced = version_history(points.select(*columns, first), key, tracked, time, ranges=ranges)
    stays = (
        F.col(key).eqNullSafe(F.col(f"_old_{key}"))
        & start.eqNullSafe(F.col("_old_effective_start_date"))
        & F.col("_hash_key").eqNullSafe(F.col("_old__hash_key"))
    )
    now = run_time(as_of)
    number = F.col("version") + F.col("_from_version") - 1
    untouched = (F.col("_old_version") == number) & F.col("effective_end_date").eqNullSafe(
        F.col("_old_effective_end_date")
    )
    fields = {f.name: f.dataType for f in dim.schema.fields}
    values = {
        "version": number,
        "_processed_timestamp": F.when(untouched, F.col("_old__processed_timestamp")).otherwise(now),
    }
    present = set(spliced.columns)
    new = spliced.join(old, stays, "left").select(
        *[
            values.get(c, F.col(c) if c in present else F.col(f"_old_{c}")).cast(kind).alias(c)
            for c, kind in fields.items()
        ]
    )
    return kept.unionByName(new)
