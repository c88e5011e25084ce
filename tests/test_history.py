import random

from helpers import plan, rows
from pyspark.sql import functions as F

from shopgrain.functions import row_hash
from shopgrain.operators.history import latest_per_key
from shopgrain.plans.cleaned import customers_scd2
from shopgrain.schemas import table_schema

COLS = (
    "customer_id BIGINT, customer_unique_id STRING, customer_zip_code_prefix INT, "
    "customer_city STRING, customer_state STRING, customer_phone STRING, customer_email STRING, "
    "updated_at INT"
)


def batch(spark, people):
    return spark.createDataFrame(
        [(k, f"u{k}", z, "c", "s", phone, "e", at) for k, z, phone, at in people], COLS
    )


def test_new_changed_and_unchanged(spark):
    empty = spark.createDataFrame([], table_schema("customers_scd2"))
    one = customers_scd2(
        empty, batch(spark, [(1, 10, "p", 1), (2, 20, None, 1), (3, 30, "p", 1)]), as_of="2020-01-01"
    )
    # 1 moves twice in one feed, 2 gains a phone, 3 is sent again, 4 is new.
    feed = batch(spark, [(1, 11, "p", 2), (1, 12, "p", 3), (2, 20, "q", 2), (3, 30, "p", 2),
                         (4, 40, "p", 2)])
    two = customers_scd2(one, feed, as_of="2021-01-01")
    got = rows(
        two.select("customer_id", "version", "customer_zip_code_prefix", "is_current",
                   F.to_date("effective_end_date").cast("string"))
    )
    assert got == [
        (1, 1, 10, False, "2021-01-01"), (1, 2, 12, True, None),
        (2, 1, 20, False, "2021-01-01"), (2, 2, 20, True, None),
        (3, 1, 30, True, None), (4, 1, 40, True, None),
    ]
    again = customers_scd2(two, feed, as_of="2022-01-01")
    assert rows(again) == rows(two)


def test_history_is_consistent_over_random_batches(spark):
    rnd = random.Random(11)
    dim = spark.createDataFrame([], table_schema("customers_scd2"))
    for step in range(4):
        people = [(k, rnd.randrange(3), rnd.choice([None, "p"]), step)
                  for k in rnd.sample(range(12), 7)]
        dim = customers_scd2(dim, batch(spark, people), as_of=f"202{step}-01-01")
    per_key = {}
    for r in dim.collect():
        per_key.setdefault(r.customer_id, []).append(r)
    for versions in per_key.values():
        versions.sort(key=lambda r: r.version)
        assert [r.version for r in versions] == list(range(1, len(versions) + 1))
        assert [r.is_current for r in versions] == [False] * (len(versions) - 1) + [True]
        for a, b in zip(versions, versions[1:]):
            assert a.effective_end_date == b.effective_start_date
            assert a._hash_key != b._hash_key


def test_hash_tells_nulls_apart(spark):
    df = spark.createDataFrame([("a", None), (None, "a"), ("a", ""), ("a", None)], "x STRING, y STRING")
    hashes = [r[0] for r in df.select(row_hash(["x", "y"])).collect()]
    assert len(set(hashes)) == 3 and hashes[0] == hashes[3]


def test_latest_per_key(spark):
    df = spark.createDataFrame([(1, 5, "old"), (1, 9, "new"), (2, None, "only")], "k INT, t INT, v STRING")
    assert rows(latest_per_key(df, "k", "t"), "k", "v") == [(1, "new"), (2, "only")]


def test_latest_per_key_is_reduced_before_the_shuffle(spark):
    df = spark.range(2000).select((F.col("id") % 3).alias("k"), F.col("id").alias("t"))
    text = plan(latest_per_key(df, "k", "t"))
    assert text.count("WindowGroupLimit") == 2 and "Partial" in text


def test_ties_are_decided_the_same_way_every_time(spark):
    data = [(1, 5, c) for c in "abcdefgh"]
    seen = {
        latest_per_key(spark.createDataFrame(data, "k INT, t INT, v STRING").repartition(n), "k", "t")
        .collect()[0].v
        for n in (1, 2, 5, 8)
    }
    assert len(seen) == 1


def test_hash_tells_separators_and_null_marks_from_text(spark):
    df = spark.sql("""SELECT * FROM VALUES ('a||b', 'c'), ('a', 'b||c'), (NULL, 'x'), ('<null>', 'x'),
                      ('-1:', 'x'), ('', '1:x'), ('1', ':x') AS t(x, y)""")
    assert df.select(row_hash(["x", "y"])).distinct().count() == 7
