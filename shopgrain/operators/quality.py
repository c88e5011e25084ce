"""Row rules: tag, keep the good rows, quarantine the bad ones."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def tag_rows(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Add ``_validation_status`` and the names of the broken rules. A rule that is NULL fails."""
    broken = F.array_compact(
        F.array(
            *[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items()]
        )
    )
    return df.withColumn("_broken_rules", broken).withColumn(
        "_validation_status", F.when(F.size("_broken_rules") == 0, "PASSED").otherwise("FAILED")
    )


def split_valid(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(rows that pass every rule, quarantined rows with the rules they break)."""
    tagged = tag_rows(df, rules)
    passed = tagged.filter(F.col("_validation_status") == "PASSED").drop("_broken_rules")
    return passed, tagged.filter(F.col("_validation_status") == "FAILED")


def required(cols: Sequence[str]) -> dict[str, Column]:
    return {f"{c} is missing": F.col(c).isNotNull() for c in cols}


def frequency(df: DataFrame, col: str) -> DataFrame:
    """Rows per value."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("count"))
