"""Document fingerprints: I-Match over randomised subsets of a lexicon."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from shopgrain.llm.common import SPACE_RUN, ascii_lower, held, row_key, store, text_of

# Shares of the documents between which a term's document frequency must lie: inverse document
# frequencies from about 3 to 7.6. The lower one bounds the lexicon: document frequencies add up to
# the documents' distinct terms, so at most (mean distinct terms) / LEAST terms reach it.
LEAST, MOST = 0.0005, 0.05
MARKS = ".,;:!?|\"'()[]#*$%&<>-_"  # stripped at a term's ends
SUBSETS = 32  # of the lexicon, at each level; those of level L hold one term in 2**L
SHARED = 16  # subsets that one hash of a term decides on
DIGITS = 4  # hex digits of a subset's hash
BUCKETS = 16  # id ranges for each shuffle partition
SMALLEST = -(1 << 63)


def terms_of(text: Column) -> Column:
    """Distinct words, A-Z lower-cased, without outer marks."""
    words = F.split(ascii_lower(text), SPACE_RUN, -1)
    stripped = F.transform(F.array_distinct(words), lambda w: F.btrim(w, F.lit(MARKS)))
    return F.array_distinct(F.filter(stripped, lambda w: w != ""))


def lexicon(
    df: DataFrame, text_col: str = "text", least: float = LEAST, most: float = MOST
) -> DataFrame:
    """(term): hashes of the terms whose document frequency lies within the band, over all rows.

    Counts are partial before their shuffle. Limits under two documents count as two, so that small
    tables have a lexicon too.
    """
    total = df.count()
    low, high = max(2, math.ceil(least * total)), max(2, math.floor(most * total))
    counted = (
        df.select(F.explode(terms_of(text_of(text_col))).alias("term"))
        .groupBy("term").count().where(F.col("count").between(low, high))
    )
    return store(counted.select(F.xxhash64("term").alias("term")).distinct(), "lexicon")


def _power(level: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), level)


def _in_subset(h: Column, level: Column, subset: Column) -> Column:
    """Whether a term is in the subset by its hash: independent bits where the hash has enough for
    all that it decides on, else its residue. The first subset of level 0 is the whole lexicon, the
    others are halves."""
    mask = F.greatest(_power(level) - 1, F.lit(1).cast("long"))
    own = F.call_function("shiftright", h, subset * F.greatest(level, F.lit(1))).bitwiseAND(mask) == 0
    whole = (level == 0) & (subset == 0)
    return F.when(level * SHARED <= 64, whole | own).otherwise(h.bitwiseAND(mask) == subset)


def _subset_hashes(terms: Column, level: Column, of: int) -> Column:
    """Hashes of the ``SHARED`` subsets that the terms' hash number ``of`` decides on, each of its
    terms in their order, or dashes if it has none."""
    pairs = F.transform(terms, lambda t: F.struct(
        t.alias("t"), (F.xxhash64(t, F.lit(of)) if of else t).alias("h")
    ))
    some = F.filter(pairs, lambda p: (level * SHARED <= 64) | (
        p["h"].bitwiseAND(_power(level) - 1) < SHARED
    ))
    # the short list stands in a one-element array, so that it is made once and not per subset
    return F.flatten(F.transform(F.array(some), lambda near: F.transform(
        F.sequence(F.lit(0), F.lit(SHARED - 1)), lambda s: _hash_of(
            F.transform(F.filter(near, lambda p: _in_subset(p["h"], level, s)), lambda p: p["t"])
        ),
    )))


def _hash_of(terms: Column) -> Column:
    digits = F.lower(F.right(F.lpad(F.hex(F.xxhash64(terms)), 16, "0"), F.lit(DIGITS)))
    return F.when(F.size(terms) == 0, "-" * DIGITS).otherwise(digits)


def level_of(terms: Column) -> Column:
    """The level whose subsets hold one or two of the terms; -1 without terms."""
    n = F.size(terms)
    level = F.floor(F.log2(F.greatest(n, F.lit(1)).cast("double"))).cast("int")
    return F.when(n == 0, -1).otherwise(F.least(level, F.lit(30)))


def hashes(terms: Column, level: Column) -> Column:
    """Hashes of the subsets of a level and the next; empty without terms."""
    both = F.concat(*[
        _subset_hashes(terms, level + up, of) for up in (0, 1) for of in range(SUBSETS // SHARED)
    ])
    return F.when(level < 0, F.array().cast("array<string>")).otherwise(both)


def likeness(level_a: Column, a: Column, level_b: Column, b: Column) -> Column:
    """Share of equal hashes among the subsets of shared levels that have terms in either text; 1 if
    neither text has terms and both hold the same, 0 if they share no level."""
    pairs = (
        F.when(level_a == level_b, F.arrays_zip(a.alias("a"), b.alias("b")))
        .when(level_a == level_b + 1, F.arrays_zip(
            F.slice(a, 1, SUBSETS).alias("a"), F.slice(b, SUBSETS + 1, SUBSETS).alias("b")))
        .when(level_b == level_a + 1, F.arrays_zip(
            F.slice(a, SUBSETS + 1, SUBSETS).alias("a"), F.slice(b, 1, SUBSETS).alias("b")))
    )
    empty = "-" * DIGITS
    used = F.filter(pairs, lambda p: (p["a"] != empty) | (p["b"] != empty))
    same = F.size(F.filter(used, lambda p: p["a"] == p["b"]))
    return F.when(F.size(used) > 0, same / F.size(used)).otherwise(F.lit(0.0))


def with_next(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(bucket, place, real, id, text, next_text) in ascending order of (id, row key), null ids first;
    the last row's next is the first one.

    Rows are ordered within ranges of ids, many for each partition; the ranges come from a quantile
    sketch. Each range ends with a copy (``real`` false) of the first row of the next non-empty one,
    so that no range looks into another. The driver holds one row for each range.
    """
    spark = df.sparkSession
    base = df.select(
        F.col(id_col).cast("long").alias("id"),
        *row_key(F.col(id_col), text_of(text_col)), text_of(text_col).alias("text"),
    )
    depth = math.ceil(math.log2(BUCKETS * int(spark.conf.get("spark.sql.shuffle.partitions"))))
    ranges = 1 << depth
    at = [i / ranges for i in range(1, ranges)]
    bounds = base.select(
        F.percentile_approx("id", F.split(F.lit(",".join(map(str, at))), ",").cast("array<double>"), 10 * ranges)
    ).first()[0] or [0] * (ranges - 1)
    limits = F.split(F.lit(",".join(map(str, bounds))), ",").cast("array<bigint>")
    key = F.coalesce("id", F.lit(SMALLEST))
    reached = F.aggregate(  # binary search: how many bounds the id reaches
        F.array(*[F.lit(1 << i) for i in reversed(range(depth))]), F.lit(0),
        lambda low, step: low + F.when(key >= F.get(limits, low + step - 1), step).otherwise(0),
    )
    placed = base.withColumn("bucket", reached)
    firsts = (
        placed.groupBy("bucket")
        .agg(F.min(F.struct("id", "k1", "k2")).alias("f")).select("bucket", "f.k1", "f.k2")
        .orderBy("bucket").collect()
    )
    ends = [
        (f["k1"], f["k2"], firsts[i - 1]["bucket"]) for i, f in enumerate(firsts)
    ]  # the very first row ends the last range
    marks = spark.createDataFrame(ends, "k1 long, k2 long, bucket int")
    copies = (
        base.join(F.broadcast(marks), ["k1", "k2"]).withColumn("real", F.lit(False))
        .select("bucket", "real", "id", "k1", "k2", "text")
    )
    rows = placed.withColumn("real", F.lit(True)).select(*copies.columns).unionByName(copies)
    order = Window.partitionBy("bucket").orderBy(F.col("real").desc(), "id", "k1", "k2")
    return rows.select(
        "bucket", F.row_number().over(order).alias("place"), "real", "id", "text",
        F.lead("text").over(order).alias("next_text"),
    )


def compare_edited(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", terms: DataFrame | None = None
) -> DataFrame:
    """Per row: id, n_chars, edited (SHA-256), fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text is the text with its last half of code points replaced by as many of the next
    row's first ones. A fingerprint is ``level:hashes``; a text without lexicon terms has ``x:`` and
    the hash of its words, and is like equal fingerprints only. Null texts are empty. Repeated rows
    are neighbours like any others. An empty table gives no rows.

    The text moves once, into its range of ids; terms are looked up in the broadcast lexicon, whose
    size is bounded, and gathered again within the same partition.
    """
    terms = lexicon(df, text_col) if terms is None else terms
    looked_up = F.broadcast(terms.union(df.sparkSession.range(1).select(F.lit(0).cast("long"))))
    half = F.floor(F.char_length("text") / 2).cast("int")
    kept = F.substr("text", F.lit(1), F.char_length("text") - half)
    edited = F.concat(kept, F.substr(F.coalesce("next_text", F.lit("")), F.lit(1), half))
    both = held(with_next(df, id_col, text_col).select(
        "bucket", "place", "real", "id", "text", edited.alias("edited")
    ), "bucket")
    hashed = held(both.select(
        "bucket", "place", "real", "id", F.char_length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("sha"), F.xxhash64("text").alias("all0"),
        F.xxhash64("edited").alias("all1"),
        *[
            F.transform(terms_of(F.col(c)), lambda t: F.xxhash64(t)).alias(f"t{i}")
            for i, c in enumerate(("text", "edited"))
        ],
    ), "bucket")
    each = hashed.select(
        "bucket", "place", "real", "id", "n_chars", "sha", "all0", "all1",
        F.explode(F.concat(
            F.array(F.struct(F.lit(-1).alias("of"), F.lit(0).cast("long").alias("term"))),
            F.transform("t0", lambda h: F.struct(F.lit(0).alias("of"), h.alias("term"))),
            F.transform("t1", lambda h: F.struct(F.lit(1).alias("of"), h.alias("term"))),
        )).alias("x"),
    ).select("*", "x.of", "x.term").drop("x")
    first = [
        F.max(F.when(F.col("of") == -1, F.col(c))).alias(c)
        for c in ("real", "id", "n_chars", "sha", "all0", "all1")
    ]
    gathered = held(
        each.join(looked_up, "term").groupBy("bucket", "place").agg(
            *first, *[
                F.array_sort(F.collect_list(F.when(F.col("of") == i, F.col("term")))).alias(f"t{i}")
                for i in (0, 1)
            ],
        ),
        "bucket",
    )
    levels = held(
        gathered.select("*", *[level_of(F.col(f"t{i}")).alias(f"l{i}") for i in (0, 1)]), "bucket"
    )
    marked = held(levels.select(
        "bucket", "place", "real", "id", "n_chars", "sha", "l0", "l1", "all0", "all1",
        *[hashes(F.col(f"t{i}"), F.col(f"l{i}")).alias(f"h{i}") for i in (0, 1)],
    ), "bucket")
    order = Window.partitionBy("bucket").orderBy("place")
    beside = marked.select(
        "*", *[F.lead(c).over(order).alias(f"next_{c}") for c in ("l0", "h0", "all0")]
    ).where("real")

    def shown(i: int) -> Column:
        other = F.concat(F.lit("x:"), F.lower(F.hex(f"all{i}")))
        return F.when(F.col(f"l{i}") < 0, other).otherwise(
            F.concat(F.col(f"l{i}").cast("string"), F.lit(":"), F.array_join(f"h{i}", ""))
        )

    def near(level: str, found: str, whole: str) -> Column:
        bare = (F.col("l0") < 0) & (F.col(level) < 0)
        return F.when(bare, (F.col("all0") == F.col(whole)).cast("double")).otherwise(
            likeness(F.col("l0"), F.col("h0"), F.col(level), F.col(found))
        )

    return beside.select(
        "id", "n_chars", F.col("sha").alias("edited_sha256"), shown(0).alias("fingerprint"),
        shown(1).alias("edited_fingerprint"), near("l1", "h1", "all1").alias("near_edited"),
        near("next_l0", "next_h0", "next_all0").alias("near_next"),
    )
