"""Buckets of stored tables as the tables grow."""

from shopgrain.sources import tables


def test_buckets_follow_the_longest_table(spark):
    few, many = spark.range(5), spark.range(100)
    assert tables.buckets_for(["id"], few, many, least=2, rows=9) == (12, ["id"])
    assert tables.buckets_for(["id"], few, least=8) == (8, ["id"])
