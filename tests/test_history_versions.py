"""Several versions of a key in one batch, late ones and repeats, against a plain replay."""

import random

import pytest
from helpers import rows
from pyspark.sql import functions as F

from shopgrain.operators.history import version_history
from shopgrain.plans.cleaned import TRACKED, customers_history
from shopgrain.schemas import table_schema

COLS = (
    "customer_id BIGINT, customer_unique_id STRING, customer_zip_code_prefix INT, "
    "customer_city STRING, customer_state STRING, customer_phone STRING, customer_email STRING, "
    "updated_at TIMESTAMP"
)
OUT = ("customer_id", "version", "customer_zip_code_prefix", "is_current")


def versions(spark, seen):
    df = spark.createDataFrame(
        [(k, "u", z, "c", "s", None, "e", None if t is None else f"2020-01-{t:02d}") for k, z, t in seen],
        COLS.replace("updated_at TIMESTAMP", "updated_at STRING"),
    )
    return df.withColumn("updated_at", F.col("updated_at").cast("timestamp"))


def replay(seen):
    """(key, version, zip, current, start, end) of versions (key, zip, time) with one zip for each time."""
    out, by_key = [], {}
    for k, z, t in set(seen):
        by_key.setdefault(k, {})[t] = z
    for k, points in by_key.items():
        opened = []
        for t in sorted(points):
            if not opened or opened[-1][1] != points[t]:
                opened.append((t, points[t]))
        for n, (t, z) in enumerate(opened):
            end = opened[n + 1][0] if n + 1 < len(opened) else None
            out.append((k, n + 1, z, end is None, f"2020-01-{t:02d}", end and f"2020-01-{end:02d}"))
    return sorted(out, key=repr)


def plain(dim):
    day = lambda c: F.date_format(c, "yyyy-MM-dd")
    return rows(dim.select(*OUT, day("effective_start_date"), day("effective_end_date")))


@pytest.mark.parametrize("ranges", [None, 7])
def test_any_order_of_batches_gives_the_replayed_history(spark, ranges):
    rnd = random.Random(4)
    zip_of = {}
    seen = [(rnd.choice([None, 1, 2, 3, 3, 3, 3]), rnd.randrange(1, 28)) for _ in range(90)]
    seen = [(k, zip_of.setdefault((k, t), rnd.randrange(3)), t) for k, t in seen]
    rnd.shuffle(seen)
    dim = spark.createDataFrame([], table_schema("customers_scd2"))
    for n, size in ((1, 10), (2, 40), (3, 90)):
        batch, log = versions(spark, seen[(0, 10, 40)[n - 1] : size]), versions(spark, seen[:size])
        dim = customers_history(dim, batch, log, as_of=f"2021-01-0{n}", ranges=ranges)
        assert plain(dim) == replay(seen[:size])
    assert plain(version_history(versions(spark, seen), "customer_id", TRACKED, "updated_at")) == replay(seen)
    again = customers_history(dim, versions(spark, seen[5:20]), versions(spark, seen), as_of="2022-01-01")
    assert rows(again) == rows(dim)  # a repeated batch changes nothing, no processing time either


def test_a_late_version_keeps_what_it_does_not_touch(spark):
    dim = spark.createDataFrame([], table_schema("customers_scd2"))
    first = [(1, 10, 1), (1, 11, 10), (1, 12, 20), (2, 5, 3)]
    dim = customers_history(dim, versions(spark, first), versions(spark, first), as_of="2021-01-01")
    dim = dim.withColumn("customer_sk", F.xxhash64("customer_id", "version") % 1000)
    keys = {(r.customer_id, r.effective_start_date): r.customer_sk for r in dim.collect()}
    late = [(1, 99, 15)]
    out = customers_history(dim, versions(spark, late), versions(spark, first + late), as_of="2021-02-01")
    assert plain(out) == replay(first + late)
    got = {(r.customer_id, r.effective_start_date): r for r in out.collect()}
    fresh = [r for k, r in got.items() if k not in keys]
    assert [r.customer_zip_code_prefix for r in fresh] == [99] and fresh[0].customer_sk is None
    assert all(got[k].customer_sk == sk for k, sk in keys.items())
    moved = {r.version: str(r._processed_timestamp)[:10] for r in got.values() if r.customer_id == 1}
    assert moved == {1: "2021-01-01", 2: "2021-02-01", 3: "2021-02-01", 4: "2021-02-01"}
