"""Money sums that do not depend on row order, and divisions that give NULL on zero."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, WindowSpec, functions as F

_MICRO = 1_000_000
_LOW_BITS = 20


def exact_sum(value: Column | str, over: WindowSpec | None = None) -> Column:
    """Sum of a DOUBLE amount in millionths, as DECIMAL (an aggregate, or a window with ``over``).

    The same whatever order partial sums merge in, and exact for amounts of up to six decimals. A
    row is a whole number of millionths, added up as two longs (high and low bits), which costs
    about what a double sum costs and a fifth of a sum of decimals. Neither half can overflow
    before 10^18 units or 10^12 rows, so one key may hold any share of the rows.
    """
    high, low = _halves(value)
    if over is not None:
        high, low = high.over(over), low.over(over)
    return _whole(high, low)


def _halves(value: Column | str) -> tuple[Column, Column]:
    amount = F.rint(_col(value) * float(_MICRO)).cast("bigint")
    high = F.sum(F.shiftright(amount, _LOW_BITS))
    return high, F.sum(amount.bitwiseAND(F.lit((1 << _LOW_BITS) - 1).cast("bigint")))


def _whole(high: Column, low: Column) -> Column:
    return high.cast("decimal(20,0)") * (1 << _LOW_BITS) + low


def exact_halves(value: Column | str, name: str) -> list[Column]:
    """``exact_sum`` of a first of several steps, as the two longs: less than half of a decimal's bytes
    where every row of a table passes a shuffle so. ``sum_halves`` and ``join_halves`` go on from it."""
    high, low = _halves(value)
    return [high.alias(f"{name}_high"), low.alias(f"{name}_low")]


def sum_halves(name: str, *, when: Column | None = None, to: str | None = None) -> list[Column]:
    """The halves of a group's rows (those for which ``when`` holds) added up, under the name ``to``."""
    halves = [f"{name}_high", f"{name}_low"]
    return [
        F.sum(F.col(h) if when is None else F.when(when, F.col(h))).alias((to or name) + h[len(name):])
        for h in halves
    ]


def join_halves(name: str) -> Column:
    """The DECIMAL of an aggregate's halves: what ``exact_sum`` of all their rows gives."""
    high, low = (F.sum(f"{name}_{half}") for half in ("high", "low"))
    return _whole(high, low).cast("decimal(38,0)")


def money(total: Column | str) -> Column:
    """A total in millionths as DOUBLE."""
    return (_col(total) * F.lit(Decimal(1) / _MICRO)).cast("double")


def money_mean(total: Column | str, n: Column | str) -> Column:
    """Average amount from a total in millionths and a count."""
    return ratio(money(total), n)


def ratio(part: Column | str, whole: Column | str) -> Column:
    """``part / whole`` as DOUBLE, NULL where ``whole`` is zero or NULL."""
    return F.try_divide(_col(part).cast("double"), _col(whole).cast("double"))


def rounded_ratio(part: Column | str, whole: Column | str, digits: int) -> Column:
    return F.round(ratio(part, whole), digits)


def percent(part: Column | str, whole: Column | str, digits: int = 2) -> Column:
    """``100 * part / whole`` rounded half up."""
    return F.round(
        F.try_divide(_col(part).cast("double") * F.lit(100.0), _col(whole).cast("double")), digits
    )


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value
