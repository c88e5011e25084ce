"""High-water marks and recomputation of the keys a batch touches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from shopgrain.session import stored

EPOCH = "1970-01-01"
FEW = 1_000_000  # touched keys that are looked up before rows move


def high_water_mark(target: DataFrame | None, col: str, kind: str = "timestamp") -> Column:
    """Largest stored value as a scalar subquery; the epoch for a missing or empty target."""
    start = F.lit(EPOCH).cast(kind)
    if target is None:
        return start
    return target.agg(F.coalesce(F.max(F.col(col).cast(kind)), start)).scalar()


def incremental(
    df: DataFrame, col: str, mark: Column | str | None, *, lookback_days: int | None = None
) -> DataFrame:
    """Rows after the mark. With ``lookback_days`` the mark's own day and that many days before it
    come again, so late rows are recomputed instead of lost. The bare column is compared, so the
    filter reaches the scan."""
    if mark is None:
        return df
    bound = F.lit(mark).cast("timestamp") if isinstance(mark, str) else mark
    if lookback_days is None:
        return df.filter(F.col(col) > bound)
    return df.filter(
        F.col(col) >= F.date_sub(F.to_date(bound), lookback_days).cast("timestamp")
    )


def touched_rows(history: DataFrame, batch: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Full history of every key that occurs in ``batch``, NULL keys too. The distinct keys are stored
    first: few are broadcast by their real size, many are joined so that a hot key can be split."""
    return rows_of(history, touched_keys(batch, key), key)


def touched_keys(batch: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """The distinct keys of ``batch``, stored; ``rows_of`` takes them for one history or several."""
    keys = [key] if isinstance(key, str) else list(key)
    named = [F.col(k).alias(f"_touched_{i}") for i, k in enumerate(keys)]
    return stored(batch.select(*named).distinct(), "touched")


def rows_of(history: DataFrame, touched: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Rows of ``history`` whose key is among ``touched_keys``."""
    on = F.lit(True)
    for i, k in enumerate([key] if isinstance(key, str) else key):
        on = on & F.col(k).eqNullSafe(F.col(f"_touched_{i}"))
    return history.join(touched, on, "left_semi")


def are_few(touched: DataFrame) -> bool:
    """Whether rows should be picked by these ``touched_keys`` before anything else is done with them (Spark
    broadcasts so many or moves few), or after they have moved by the key in any case. Runs a job."""
    return touched.limit(FEW + 1).count() <= FEW


def dealt_rows_of(history: DataFrame, touched: DataFrame, key: str) -> DataFrame:
    """``rows_of``, dealt out by ``key`` (``repartition``): a row moves once for this and for what follows by the
    key. Touched keys are distinct, so the join lets no row come twice; a semi-join would be done before the
    dealing, and move the rows for itself."""
    rows = history.repartition(key).join(touched, F.col(key) == F.col("_touched_0")).drop("_touched_0")
    if touched.filter(F.col("_touched_0").isNull()).isEmpty():
        return rows
    return rows.unionByName(history.filter(F.col(key).isNull()).repartition(key))
