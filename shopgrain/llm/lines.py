"""Line dedup: lines that many documents share go, in every document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shopgrain.llm.common import SPACES, ascii_lower, row_key, store, text_of


def line_key(line: Column) -> Column:
    """A line without outer white space, A-Z lower-cased."""
    return ascii_lower(F.btrim(line, F.lit(SPACES)))


def drop_common_lines(
    df: DataFrame, text_col: str = "text", id_col: str = "doc_id",
    min_documents: int = 10, min_chars: int = 1,
) -> DataFrame:
    """``row`` (the input's columns), ``kept`` (text without common lines), ``n_lines``, ``n_dropped``.

    A line goes if its key has at least ``min_chars`` code points and occurs in at least
    ``min_documents`` rows. Null and empty texts are one empty line. Each row is a document of its
    own, so repeated rows count again and all get the same result. An empty table gives no rows.

    Each row lists its distinct keys once, so a document counts once per key; the count is partial
    before its shuffle. Keys are compared by two 64-bit hashes. Only positions and hashes are joined
    with the common keys, straight from a scan, so a line of a third of all documents is split; the
    text moves once, to meet the positions its row loses.
    """
    text = text_of(text_col)
    base = df.select(
        F.struct("*").alias("row"), *row_key(F.col(id_col), text),
        F.split(text, "\n", -1).alias("lines"),
    )
    keys = F.transform("lines", line_key).alias("keys")
    hashes = [F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), F.col("key")).alias("h2")]
    common = store(
        base.select(F.explode(F.array_distinct(keys)).alias("key"))
        .where(F.char_length("key") >= min_chars)
        .select(*hashes).groupBy("h1", "h2").count()
        .where(F.col("count") >= min_documents).select("h1", "h2"),
        "common-lines",
    )
    dropped = (
        base.select("k1", "k2", F.posexplode(keys).alias("pos", "key"))
        .where(F.char_length("key") >= min_chars)
        .select("k1", "k2", "pos", *hashes)
        .join(common, ["h1", "h2"], "left_semi")
        .groupBy("k1", "k2").agg(F.collect_set("pos").alias("drop"))
    )
    every = F.sequence(F.lit(0), F.size("lines") - 1)
    left = F.array_except(every, F.coalesce("drop", F.array().cast("array<int>")))
    kept = F.array_join(F.transform(left, lambda i: F.get("lines", i)), "\n")
    return (
        base.join(dropped, ["k1", "k2"], "left")
        .select(
            "row",
            F.when(F.col("drop").isNull(), F.array_join("lines", "\n")).otherwise(kept).alias("kept"),
            F.size("lines").cast("long").alias("n_lines"),
            F.coalesce(F.size("drop"), F.lit(0)).cast("long").alias("n_dropped"),
        )
    )
