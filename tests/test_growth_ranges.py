"""What ordered columns shuffle and store."""

from helpers import rows

from shopgrain.operators import ordered as ordered_module


def test_ranges_hold_the_rows_and_nothing_that_follows_from_them(spark, monkeypatch):
    held, original = [], ordered_module.stored

    def spy(df, name):
        held.extend(df.columns if name == "ranges" else [])
        return original(df, name)

    monkeypatch.setattr(ordered_module, "stored", spy)
    df = spark.createDataFrame([(1, 2, 0.5), (1, 1, 0.5), (None, 3, 1.5)], "g INT, n INT, v DOUBLE")
    got = ordered_module.ordered(df, "g", [("v", "desc"), ("n", "asc")], row_number="r", ranges=3)
    assert rows(got, "n", "r") == [(1, 1), (2, 2), (3, 1)]
    assert held == ["g", "n", "v", "_p"]
