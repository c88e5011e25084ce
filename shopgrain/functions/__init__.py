from shopgrain.functions.banding import band
from shopgrain.functions.hashing import row_hash
from shopgrain.functions.numeric import (
    exact_halves, exact_sum, join_halves, money, money_mean, percent, ratio, rounded_ratio, sum_halves,
)
from shopgrain.functions.timing import run_date, run_time

__all__ = [
    "band", "exact_halves", "exact_sum", "join_halves", "money", "money_mean", "percent", "ratio",
    "rounded_ratio", "row_hash", "run_date", "run_time", "sum_halves",
]
