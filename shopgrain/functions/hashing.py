"""Change-detection hash."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

NULL_MARK = "-1:"  # in the place of a length; no text has it


def row_hash(cols: Sequence[str | Column]) -> Column:
    """SHA-256 over the columns, each with its length before it, so that no two rows make the same
    text; NULL counts as a value, so moving one NULL changes the hash."""
    texts = [(F.col(c) if isinstance(c, str) else c).cast("string") for c in cols]
    parts = [
        F.coalesce(F.concat(F.char_length(t).cast("string"), F.lit(":"), t), F.lit(NULL_MARK))
        for t in texts
    ]
    return F.sha2(F.concat(*parts), 256)
