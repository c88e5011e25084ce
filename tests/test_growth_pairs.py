"""Pairs that a task lists as the baskets grow."""

import pytest

from shopgrain.operators import basket


@pytest.mark.parametrize("big_basket", [500, 3])
def test_a_task_lists_some_pairs_whatever_the_bytes(spark, monkeypatch, big_basket):
    data = [(b, (b + i) % 30) for b in range(100) for i in range(5)]
    parts, original = [], basket._meetings

    def spy(m):
        parts.append(m.rdd.getNumPartitions())
        return original(m)

    monkeypatch.setattr(basket, "_meetings", spy)
    monkeypatch.setattr(basket, "TASK_PAIRS", 20)
    df = spark.createDataFrame(data, "o BIGINT, p BIGINT")
    basket.co_occurrence(df, "o", "p", min_count=2, big_basket=big_basket).collect()
    assert min(parts) >= 30  # of 100 baskets of ten pairs, less what items sit out of
