"""What sums of orders and products shuffle and store."""

from helpers import rows

from shopgrain.functions import exact_halves, exact_sum, join_halves, sum_halves
from shopgrain.operators import incremental
from shopgrain.plans import catalogue, partners


def test_halves_add_up_to_the_exact_sum(spark):
    df = spark.createDataFrame(
        [(1, 1, 0.1), (1, 2, -7e11), (1, 2, 123456.78), (2, 1, None), (3, 3, 9.99)], "k INT, o INT, v DOUBLE"
    )
    want = df.groupBy("k").agg(exact_sum("v").cast("decimal(38,0)").alias("v"))
    some = df.groupBy("k", "o").agg(*exact_halves("v", "a")).groupBy("k", "o").agg(*sum_halves("a", to="b"))
    assert rows(some.groupBy("k").agg(join_halves("b").alias("v"))) == rows(want)


def test_reduced_items_pass_the_order_join_without_decimals(spark):
    items = spark.createDataFrame([(1, 2, 3.5, 0.5)], "order_id INT, product_id INT, price DOUBLE, freight_value DOUBLE")
    bought = catalogue._bought(items, items.select("order_id"))
    assert not [f.name for f in bought.schema if f.dataType.typeName() == "decimal"]


def test_touched_orders_of_places_are_listed_once(spark, monkeypatch):
    listed, original = [], incremental.stored

    def spy(df, name):
        listed.append(name)
        return original(df, name)

    monkeypatch.setattr(incremental, "stored", spy)
    place = "'s' customer_state, 'c' customer_city, 1 customer_zip_code_prefix"
    customers = spark.sql(f"SELECT id customer_id, true is_current, {place} FROM range(3)")
    orders = spark.sql("SELECT id order_id, id % 3 customer_id, true is_delayed, 2 delivery_delay_days FROM range(9)")
    items = spark.sql("SELECT id % 9 order_id, id % 2 seller_id, 1.5D price FROM range(20)")
    before = (customers, orders, items.filter("order_id < 5"))
    changes = partners.place_changes(before, (customers, orders, items), items.select("order_id"))
    state = partners.add_places(partners.place_state(*before), changes)
    cols = sorted(state.columns)
    assert listed == ["touched"]
    assert rows(state, *cols) == rows(partners.place_state(customers, orders, items), *cols)
