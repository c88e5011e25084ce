"""Several distinct counts per group in one narrow shuffle, and sketches of them that can be added up."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F


def distinct_counts(df: DataFrame, by: str | Sequence[str], counts: Mapping[str, str]) -> DataFrame:
    """Distinct non-NULL values per group; ``counts`` maps an output name to a column.

    Each row becomes one (group, which count, value) row per count and duplicates are dropped, first
    in the map tasks and then over all values at once, so a hot group spreads over its values. Next
    to ``count_distinct`` in a wide aggregate, the rows copied hold one value instead of every
    aggregate's buffer. Compute the sums of the group apart and join them at group grain.
    """
    by = [by] if isinstance(by, str) else list(by)
    types = {df.schema[c].dataType for c in counts.values()}
    as_type = "string" if len(types) > 1 else None
    values = [F.col(c).cast(as_type) if as_type else F.col(c) for c in counts.values()]
    rows = df.select(
        *by,
        F.explode(
            F.array(*[F.struct(F.lit(i).alias("_n"), v.alias("_v")) for i, v in enumerate(values)])
        ).alias("_e"),
    )
    return (
        rows.select(*by, "_e._n", "_e._v")
        .distinct()
        .groupBy(*by)
        .agg(
            *[
                F.count_if((F.col("_n") == i) & F.col("_v").isNotNull()).alias(name)
                for i, name in enumerate(counts)
            ]
        )
    )


PRECISION = 14  # a sketch has 2**14 registers, some 8 KB at most
RELATIVE_ERROR = 1.04 / 2 ** (PRECISION / 2)  # standard error of an estimate


def sketches(df: DataFrame, by: str | Sequence[str], counts: Mapping[str, str]) -> DataFrame:
    """A HyperLogLog sketch of the distinct non-NULL values per group for each of ``counts`` (output name
    to column), to be stored. Counts of days do not add up to a month's; their sketches do, so a longer
    period is read from them without the facts. A sketch has a bounded size whatever its group's."""
    by = [by] if isinstance(by, str) else list(by)
    return df.groupBy(*by).agg(
        *[F.hll_sketch_agg(c, F.lit(PRECISION)).alias(name) for name, c in counts.items()]
    )


def union_sketches(stored: DataFrame, by: str | Sequence[str], names: Sequence[str]) -> DataFrame:
    """The sketches of coarser groups from those of finer ones, from several runs or overlapping ones."""
    by = [by] if isinstance(by, str) else list(by)
    return stored.groupBy(*by).agg(*[F.hll_union_agg(n).alias(n) for n in names])


def sketch_counts(stored: DataFrame, names: Sequence[str]) -> DataFrame:
    """Estimates in the place of sketches; two thirds are off by at most ``RELATIVE_ERROR``."""
    return stored.withColumns({n: F.hll_sketch_estimate(n) for n in names})


def beside(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Columns of two aggregates over the same groups; a NULL group matches itself."""
    same = F.lit(True)
    for k in keys:
        same = same & left[k].eqNullSafe(right[k])
    return left.join(right, same).drop(*[right[k] for k in keys])
