import random
from collections import defaultdict

import pytest
from helpers import plan, rows
from pyspark.sql import functions as F

from shopgrain.operators.history import assign_surrogate
from shopgrain.operators.ordered import ordered

SPLIT = dict(ranges=8)


def table(seed, n=400, ties=False):
    """A third of the rows in group 0; some NULL groups and NULL prices."""
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        group = 0 if rnd.random() < 0.34 else rnd.choice([None, 1, 2, 3, 4, 5, 6, 7])
        price = None if rnd.random() < 0.05 else float(rnd.randrange(5 if ties else 10_000)) / 4
        out.append((group, i, price))
    return out


def groups(data):
    out = defaultdict(list)
    for g, i, p in data:
        out[g].append((i, p))
    return out


def prefix(data):
    want = []
    for g, members in groups(data).items():
        members.sort(key=lambda m: (m[1] is not None, m[1] or 0, m[0]))
        total = sum(p for _, p in members if p is not None)
        running, seen = 0.0, False
        for n, (i, p) in enumerate(members, 1):
            running, seen = running + (p or 0), seen or p is not None
            want.append((g, i, n, running if seen else None, total))
    return sorted(want, key=repr)


@pytest.mark.parametrize("splitting", [{}, SPLIT, dict(ranges=3)])
@pytest.mark.parametrize("ties", [False, True])
def test_running_sums_and_row_numbers(spark, splitting, ties):
    data = table(3, ties=ties)
    df = spark.createDataFrame(data, "g INT, i INT, p DOUBLE").repartition(5)
    got = ordered(
        df, "g", [("p", "asc"), ("i", "asc")],
        row_number="n", running={"run": "p"}, totals={"total": "p"}, **splitting,
    )
    assert rows(got, "g", "i", "n", "run", "total") == prefix(data)


@pytest.mark.parametrize("splitting", [{}, SPLIT, dict(ranges=64)])
def test_rank_with_ties(spark, splitting):
    data = table(5, ties=True)
    want = []
    for g, members in groups(data).items():
        for i, p in members:
            ahead = sum(1 for _, q in members if q is not None and (p is None or q > p))
            want.append((g, i, ahead + 1))
    df = spark.createDataFrame(data, "g INT, i INT, p DOUBLE")
    got = ordered(df, "g", [("p", "desc")], rank="r", **splitting)
    assert rows(got, "g", "i", "r") == sorted(want, key=repr)


def test_one_value_everywhere(spark):
    """All order keys equal: nothing to split by, still right."""
    df = spark.range(300).select(F.lit(1).alias("g"), F.lit(2.5).alias("p"), "id")
    got = ordered(df, "g", [("p", "desc")], rank="r", totals={"t": "p"}, **SPLIT)
    assert got.select("r", "t").distinct().collect() == [(1, 750.0)]


def test_whole_table_is_split_over_tasks(spark):
    df = spark.range(5000).withColumn("v", (F.col("id") * 7919 % 5003).cast("double"))
    got = ordered(df, None, [("v", "desc"), ("id", "asc")], row_number="n", **SPLIT)
    by_rank = [r.v for r in got.orderBy("n").collect()]
    assert by_rank == sorted(by_rank, reverse=True)
    assert [r.n for r in got.select("n").orderBy("n").collect()] == list(range(1, 5001))
    # The windows over the rows run per (range, group); none gathers the rows in one partition.
    assert "Window [row_number() windowspecdefinition(_p" in plan(got)


def test_pieces_are_bounded_whatever_the_groups(spark):
    """A group of half of the rows, one of a hundredth and one of 1/3000 are cut by the same ranges, no
    piece is large, and the corrections are at most two rows per range."""
    sizes = {0: 6000, 1: 120, 2: 4}
    df = spark.range(12_000).selectExpr(
        "CASE WHEN id < 6000 THEN 0L WHEN id < 6120 THEN 1L WHEN id < 6124 THEN 2L ELSE id END AS g",
        "cast(id * 7919 % 12007 AS double) AS v", "id",
    )
    got = ordered(df, "g", [("v", "asc")], row_number="n", totals={"t": "v"}, ranges=100)
    folder = [f for f in got.inputFiles() if "/ranges-" in f][0].rsplit("/", 1)[0]
    pieces = spark.read.parquet(folder).groupBy("_p", "g").count().collect()
    assert max(r["count"] for r in pieces) <= 400
    cut = {g: sum(r["g"] == g for r in pieces) for g in sizes}
    assert cut[0] > 30 and cut[1] >= 1
    offsets = [f for f in got.inputFiles() if "/offsets-" in f][0].rsplit("/", 1)[0]
    assert spark.read.parquet(offsets).count() <= 200
    last = got.groupBy("g").agg(F.max("n").alias("n"), F.count("*").alias("c"), F.max("t").alias("t"), F.sum("v").alias("s"))
    assert last.where("n <> c OR t <> s").count() == 0
    assert "BroadcastHint" not in got._jdf.queryExecution().analyzed().toString()


def test_a_small_group_is_cut_with_its_ties(spark):
    df = spark.range(600).selectExpr("CASE WHEN id < 6 THEN -1L ELSE id END AS g", "id AS v")
    got = ordered(df.union(df), "g", [("v", "asc")], row_number="n", rank="r", ranges=300)
    small = sorted(map(tuple, got.where("g = -1").select("n", "v", "r").collect()))
    assert small == [(i + 1, i // 2, i // 2 * 2 + 1) for i in range(12)]
    folder = [f for f in got.inputFiles() if "/ranges-" in f][0].rsplit("/", 1)[0]
    assert spark.read.parquet(folder).where("g = -1").select("_p").distinct().count() > 1


@pytest.mark.parametrize("splitting", [{}, SPLIT, dict(ranges=64)])
def test_neighbours_across_ranges(spark, splitting):
    data = table(8)
    want = []
    for g, members in groups(data).items():
        members.sort(key=lambda m: (m[1] is not None, m[1] or 0, m[0]))
        for n, (i, _) in enumerate(members):
            before = members[n - 1][0] if n else None
            after = members[n + 1][0] if n + 1 < len(members) else None
            want.append((g, i, before, after))
    df = spark.createDataFrame(data, "g INT, i INT, p DOUBLE")
    got = ordered(df, "g", [("p", "asc"), ("i", "asc")], lag={"b": "i"}, lead={"a": "i"}, **splitting)
    assert rows(got, "g", "i", "b", "a") == sorted(want, key=repr)


def test_empty(spark):
    df = spark.createDataFrame([], "g INT, i INT, p DOUBLE")
    assert ordered(df, "g", [("p", "asc")], row_number="n", running={"r": "p"}).count() == 0


def test_surrogates_continue_after_the_largest(spark):
    df = spark.createDataFrame(
        [(7, "a", 1), (3, "b", 1), (None, "c", 1), (None, "b", 2), (None, "a", 2)],
        "sk BIGINT, k STRING, v INT",
    )
    assert rows(assign_surrogate(df, "sk", ["k", "v"])) == [
        (10, "c", 1), (3, "b", 1), (7, "a", 1), (8, "a", 2), (9, "b", 2),
    ]
