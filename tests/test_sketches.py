from helpers import rows
from pyspark.sql import functions as F

from shopgrain.operators.distinct import RELATIVE_ERROR, sketch_counts, sketches, union_sketches


def test_sketches_add_up_and_stay_close(spark):
    """A hot day, values on several days, NULLs, and a batch that is added later and partly again."""
    df = spark.range(60_000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 1 ELSE id % 30 END AS day", "nullif(id % 20000, 0) AS who", "'x' AS one"
    )
    counts = {"people": "who", "same": "one"}
    first, again = sketches(df.filter("day < 20"), "day", counts), sketches(df.filter("day > 10"), "day", counts)
    days = union_sketches(first.unionByName(again), "day", list(counts))
    whole = sketch_counts(union_sketches(days.withColumn("all", F.lit(1)), "all", list(counts)), list(counts)).first()
    assert abs(whole.people - 19_999) <= 5 * RELATIVE_ERROR * 19_999 and whole.same == 1
    got = {d: n for d, n in rows(sketch_counts(days, list(counts)), "day", "people")}
    for d, n in rows(df.groupBy("day").agg(F.count_distinct("who"))):
        assert abs(got[d] - n) <= 5 * RELATIVE_ERROR * n + 1
    assert sketches(df.limit(0), "day", counts).count() == 0


def test_stored_sketches_are_read_back(spark, tmp_path):
    sketches(spark.range(100).selectExpr("id % 4 AS g", "id AS v"), "g", {"n": "v"}).write.parquet(str(tmp_path / "s"))
    back = spark.read.parquet(str(tmp_path / "s"))
    assert rows(sketch_counts(back, ["n"])) == [(g, 25) for g in range(4)]
