import random
from collections import Counter
from itertools import combinations

import pytest
from helpers import rows
from pyspark.sql import functions as F

from shopgrain.operators import basket as basket_module
from shopgrain.operators.basket import co_occurrence
from shopgrain.plans.catalogue import cross_selling


def brute(data, min_count):
    baskets = {}
    for b, i in data:
        baskets.setdefault(b, set()).add(i)
    pairs = Counter(p for items in baskets.values() for p in combinations(sorted(items), 2))
    return sorted(((a, b, n) for (a, b), n in pairs.items() if n >= min_count), key=repr)


def members(seed):
    """Small baskets, some large, and one that holds a third of all rows."""
    rnd = random.Random(seed)
    data = {(b, rnd.randrange(40)) for b in range(120) for _ in range(rnd.choice([1, 2, 3, 4]))}
    data |= {(1000 + b, i) for b in range(6) for i in rnd.sample(range(60), 15)}
    data |= {(2000, i) for i in range(150)}
    return sorted(data)


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("min_count", [1, 2, 4])
@pytest.mark.parametrize("big_basket", [0, 3, 10, 10_000])
def test_counts_are_exact(spark, seed, min_count, big_basket):
    data = members(seed)
    df = spark.createDataFrame(data, "o BIGINT, p BIGINT")
    got = co_occurrence(df, "o", "p", min_count=min_count, big_basket=big_basket)
    assert rows(got) == brute(data, min_count)


def test_a_huge_basket_lists_no_pairs(spark, monkeypatch):
    """200 items meet in one huge basket; only pairs from ordinary baskets are ever listed."""
    data = [(0, i) for i in range(200)] + [(1, 1), (1, 2), (2, 1), (2, 2)]
    listed = []
    original = basket_module._meetings

    def spy(m):
        out = original(m)
        listed.append(out.count())
        return out

    monkeypatch.setattr(basket_module, "_meetings", spy)
    df = spark.createDataFrame(data, "o BIGINT, p BIGINT")
    assert rows(co_occurrence(df, "o", "p", min_count=2, big_basket=50)) == [(1, 2, 3)]
    assert listed == [1]


def test_lift_and_labels(spark):
    items = spark.createDataFrame(
        [(1, 10), (1, 10), (1, 20), (2, 10), (2, 20), (3, 10), (4, 30), (4, 99)],
        "order_id BIGINT, product_id BIGINT",
    )
    products = spark.createDataFrame(
        [(10, "x"), (20, "y"), (30, None)], "product_id BIGINT, product_category_name STRING"
    )
    got = cross_selling(items, products, min_co=2, scale=1, as_of="2020-01-01").collect()
    assert len(got) == 1
    r = got[0]
    assert (r.product_id_a, r.product_id_b, r.co_occurrence_count) == (10, 20, 2)
    # Four orders hold a known product: lift = 2 / (3 * 2 / 4).
    assert r.lift_score == 1.33 and r.probability_a_to_b == 66.67 and r.probability_b_to_a == 100.0
    assert r.recommendation_strength == "NEGLIGIBLE" and r.cross_category_flag is True


def test_top_is_cut_with_a_tie_break(spark):
    items = spark.createDataFrame(
        [(o, i) for o in range(3) for i in range(6)], "order_id BIGINT, product_id BIGINT"
    )
    products = spark.range(6).select(
        F.col("id").alias("product_id"), F.lit("c").alias("product_category_name")
    )
    got = cross_selling(items, products, min_co=3, top=4)
    assert rows(got, "product_id_a", "product_id_b") == [(0, 1), (0, 2), (0, 3), (0, 4)]
