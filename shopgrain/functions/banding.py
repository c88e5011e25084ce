"""Threshold tiers as one WHEN chain."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from operator import ge, gt, le, lt
from typing import Any

from pyspark.sql import Column, functions as F

_TESTS: dict[str, Callable] = {">=": ge, ">": gt, "<=": le, "<": lt}


def band(value: Column | str, test: str, cuts: Sequence[tuple[Any, Any]], default: Any) -> Column:
    """Label of the first cut whose ``value <test> cut`` holds; ``default`` otherwise or on NULL."""
    col = F.col(value) if isinstance(value, str) else value
    compare = _TESTS[test]
    chain = None
    for cut, label in cuts:
        step = F.when if chain is None else chain.when
        chain = step(compare(col, F.lit(cut)), F.lit(label))
    return chain.otherwise(F.lit(default))
