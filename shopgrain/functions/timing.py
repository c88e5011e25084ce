"""Run time as an argument, so a rerun gives the same rows."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, functions as F


def run_time(as_of: datetime | date | str | None) -> Column:
    """Timestamp of the run: the given moment, or now."""
    return F.current_timestamp() if as_of is None else F.lit(str(as_of)).cast("timestamp")


def run_date(as_of: datetime | date | str | None) -> Column:
    return F.current_date() if as_of is None else F.to_date(run_time(as_of))
