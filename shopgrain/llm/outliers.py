"""Quality rules: robust multivariate outliers by minimum covariance determinant estimates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from shopgrain.llm.common import SPACE_RUN, SPACES, discard, held, store

SYMBOLS = "#*$%&|<>"
GRAM = 5  # words of a window
STATS = ("s0", "s1", "s2", "s3")
SUPPORT = 0.75  # share of a group's rows that its estimate rests on
TOLERANCE = 1e-3  # least fall of a log-determinant for which another step is taken
CUTOFF = 18.467  # 0.999 quantile of chi-squared with four degrees of freedom
MIDDLE = 3.357  # its median
# Least variances of the transformed statistics, for groups in which most rows are alike: a tenth in
# word length, 2.6 symbols or repeated lines and 7.6 repeated words in a hundred reach the cutoff.
LEAST = (0.01, 0.09, 0.09, 0.25)
PRIOR_ROWS = 20  # rows that the estimate over all rows counts for in a group's estimate
GRID = 4096  # cells of a quantile's grid for each factor of e
PARTS = 64  # parts in which a group's sums are added up first
FEW_GROUPS = 50_000  # estimates that are broadcast: some 15 MB; more of them are joined by parts


def with_base(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``row`` (the input's columns), ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``,
    ``n_repeat_words``. A null text has no words.

    Repeated windows: each window of five words gets a 64-bit hash, combined from those of its
    words; where a hash occurs twice, sorted hashes with their places name the repeated windows, and
    the words they cover are counted from the gaps between sorted places.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    words = F.filter(F.split(text, SPACE_RUN, -1), lambda w: w != "")
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    symbols = F.regexp_replace(text, f"[^{SYMBOLS}]+", "")
    first = held(df.select(
        F.struct("*").alias("row"), words.alias("words"), lines.alias("lines"),
        F.char_length(symbols).cast("long").alias("n_symbols"),
    ))
    counted = held(first.select(
        "row", F.size("words").alias("n"),
        F.char_length(F.array_join("words", "")).cast("long").alias("word_chars"), "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("h"),
    ))
    pairs = held(counted.select("*", _joined("h", "h", 1).alias("h2")))
    fours = held(pairs.select("*", _joined("h2", "h2", 2).alias("h4")))
    grams = held(fours.select(
        "row", "n", "word_chars", "n_symbols", "n_dup_lines",
        F.when(F.col("n") >= GRAM, F.slice(_joined("h4", "h", GRAM - 1), F.lit(1), F.col("n") - (GRAM - 1)))
        .otherwise(F.array().cast("array<bigint>")).alias("g"),
    ))
    repeated = F.size(F.array_distinct("g")) < F.size("g")
    placed = F.array_sort(F.transform("g", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    ordered = held(grams.select(
        "row", "n", "word_chars", "n_symbols", "n_dup_lines",
        F.when(repeated, placed).alias("p"),
    ))
    beside = F.arrays_zip(
        F.col("p").alias("this"), F.slice("p", 2, F.greatest(F.size("p"), F.lit(1))).alias("next"),
        F.concat(F.slice("p", 1, 1), F.slice("p", 1, F.greatest(F.size("p") - 1, F.lit(0)))).alias("prior"),
    )
    same = F.filter(beside, lambda z: (
        (z["this"]["h"] == z["next"]["h"])
        | ((z["this"]["h"] == z["prior"]["h"]) & (z["this"]["i"] != z["prior"]["i"]))
    ))
    starts = held(ordered.select(
        "row", "n", "word_chars", "n_symbols", "n_dup_lines",
        F.when(F.col("p").isNotNull(), F.array_sort(F.transform(same, lambda z: z["this"]["i"])))
        .alias("at"),
    ))
    gaps = F.zip_with(
        F.col("at"), F.slice("at", 2, F.greatest(F.size("at"), F.lit(1))),
        lambda a, b: F.least(F.coalesce(b - a, F.lit(GRAM)), F.lit(GRAM)),
    )
    covered = F.aggregate(gaps, F.lit(0), lambda total, gap: total + gap)
    return starts.select(
        "row", F.col("n").cast("long").alias("n_words"), "word_chars", "n_symbols", "n_dup_lines",
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
    )


def _joined(left: str, right: str, by: int) -> Column:
    """Element i of ``left`` hashed with element i + ``by`` of ``right``; nulls past the end."""
    return F.zip_with(
        F.col(left), F.slice(right, by + 1, F.greatest(F.size(right), F.lit(1))),
        lambda a, b: F.xxhash64(a, b),
    )


def base_failed() -> Column:
    few, much = F.col("n_words") < 10, 100 * F.col("n_repeat_words") > 20 * F.col("n_words")
    return few | much


def transformed() -> list[Column]:
    """Mean word length, and per-word rates of symbols, repeated lines and repeated words, on
    logarithmic scales on which one unit is about a factor of e above a hundredth."""
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    rate = lambda c: F.log1p(100 * F.col(c) / n)
    return [
        F.log1p(F.col("word_chars") / n).alias("s0"), rate("n_symbols").alias("s1"),
        rate("n_dup_lines").alias("s2"), rate("n_repeat_words").alias("s3"),
    ]


def _lower() -> list[tuple[int, int]]:
    return [(i, j) for i in range(len(STATS)) for j in range(i + 1)]


def _least(i: int, j: int, value: Column) -> Column:
    return F.greatest(value, F.lit(LEAST[i])) if i == j else value


def _in_parts(rows: DataFrame) -> DataFrame:
    return rows.withColumn("part", F.spark_partition_id() % PARTS)


def _beside(rows: DataFrame, est: DataFrame, groups: int, how: str = "inner") -> DataFrame:
    """``rows`` (g, part and more) with their group's row of ``est``.

    A counted number of groups is broadcast up to ``FEW_GROUPS``. Beyond it a copy of each group's
    row goes to every part, so that a group of any share of the rows is met in ``PARTS`` places.
    """
    if groups <= FEW_GROUPS:
        return rows.join(F.broadcast(est), "g", how)
    copies = est.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))
    return rows.join(copies, ["g", "part"], how)


def _moments(rows: DataFrame) -> DataFrame:
    """Mean and covariance per group, with the least variances on the diagonal.

    Sums meet by (group, part) first: no task adds up a row from every map task of a large group.
    """
    names = {f"m{i}": F.col(c) for i, c in enumerate(STATS)}
    names |= {f"x{i}{j}": F.col(STATS[i]) * F.col(STATS[j]) for i, j in _lower()}
    parts = rows.groupBy("g", "part").agg(
        F.count("*").alias("n"), *[F.sum(v).alias(k) for k, v in names.items()]
    )
    sums = parts.groupBy("g").agg(F.sum("n").alias("n"), *[F.sum(k).alias(k) for k in names])
    means = sums.select("g", *[(F.col(k) / F.col("n")).alias(k) for k in names])
    cov = [
        _least(i, j, F.col(f"x{i}{j}") - F.col(f"m{i}") * F.col(f"m{j}")).alias(f"c{i}{j}")
        for i, j in _lower()
    ]
    return means.select("g", *[f"m{i}" for i in range(len(STATS))], *cov)


def _cell(value: Column) -> Column:
    return F.round(F.signum(value) * F.log1p(F.abs(value)) * GRID).cast("long")


def _uncell(cell: Column) -> Column:
    return F.signum(cell) * F.expm1(F.abs(cell) / GRID)


def _quantile(cells: DataFrame, keys: list[str], share: float) -> DataFrame:
    """The ``cell`` at which ``share`` of the rows of each of ``keys`` is reached.

    Rows are counted per cell of a logarithmic grid, which any number of tasks can do for one group;
    what is added up in order is the counts of a group's cells, whose number the grid bounds.
    """
    counts = cells.groupBy(*keys, "cell").count()
    group = Window.partitionBy(*keys)
    upto = F.sum("count").over(group.orderBy("cell").rowsBetween(Window.unboundedPreceding, 0))
    found = counts.withColumn("upto", upto).withColumn("total", F.sum("count").over(group))
    return found.where(F.col("upto") >= share * F.col("total")).groupBy(*keys).agg(F.min("cell").alias("cell"))


def _medians(rows: DataFrame, name: str, values: list[Column]) -> DataFrame:
    """Per group, the medians of ``values`` as ``name``0, ``name``1 and so on."""
    each = F.array(*[F.struct(F.lit(i).alias("i"), _cell(v).alias("cell")) for i, v in enumerate(values)])
    found = _quantile(rows.select("g", F.inline(each)), ["g", "i"], 0.5)
    return found.groupBy("g").agg(*[
        F.max(F.when(F.col("i") == i, _uncell(F.col("cell")))).alias(f"{name}{i}") for i in range(len(values))
    ])


def _cholesky(est: DataFrame) -> DataFrame:
    """Lower triangular factor of the covariance, column by column, and the log-determinant."""
    d = len(STATS)
    for j in range(d):
        inner = sum((F.col(f"l{j}{k}") ** 2 for k in range(j)), F.lit(0.0))
        est = est.withColumn(f"l{j}{j}", F.sqrt(F.greatest(F.col(f"c{j}{j}") - inner, F.lit(1e-9))))
        for i in range(j + 1, d):
            cross = sum((F.col(f"l{i}{k}") * F.col(f"l{j}{k}") for k in range(j)), F.lit(0.0))
            est = est.withColumn(f"l{i}{j}", (F.col(f"c{i}{j}") - cross) / F.col(f"l{j}{j}"))
    return est.withColumn("logdet", sum(F.log(f"l{j}{j}") for j in range(d)) * 2)


def _distance() -> Column:
    """Squared Mahalanobis distance by forward substitution."""
    z: list[Column] = []
    for i in range(len(STATS)):
        rest = F.col(STATS[i]) - F.col(f"m{i}")
        for k in range(i):
            rest = rest - F.col(f"l{i}{k}") * z[k]
        z.append(rest / F.col(f"l{i}{i}"))
    return sum((x * x for x in z), F.lit(0.0))


def _names() -> list[str]:
    lower = _lower()
    return [*[f"m{i}" for i in range(len(STATS))], *[f"{x}{i}{j}" for x in "cl" for i, j in lower]]


def estimates(rows: DataFrame, support: float = SUPPORT, tolerance: float = TOLERANCE) -> DataFrame:
    """Per group ``g`` of ``rows`` (g, s0..s3): rows ``n``, location, covariance, Cholesky factor.

    Minimum covariance determinant by concentration steps from a deterministic start, the medians
    with the squared scaled median deviations: the share ``support`` of a group with the smallest
    distances gives the next estimate. Steps go on for a group as long as its log-determinant falls
    by more than ``tolerance``; the last that fell counts, and the least variances bound the fall.
    Quantiles are counts on a grid and moments partial sums, so a group of any size is spread over
    all tasks and runs over the same rows agree; the estimates are one row per group.
    """
    d = range(len(STATS))
    rows = _in_parts(rows)
    sizes = rows.groupBy("g", "part").count()
    mid = _medians(rows, "m", [F.col(c) for c in STATS])
    mid = store(mid.join(sizes.groupBy("g").agg(F.sum("count").alias("n")), "g"), "medians")
    groups = mid.count()
    away = _medians(_beside(rows, mid, groups), "a", [F.abs(F.col(STATS[i]) - F.col(f"m{i}")) for i in d])
    start = mid.join(away, "g").select(
        "g", "n", *[f"m{i}" for i in d],
        *[
            (_least(i, j, (1.4826 * F.col(f"a{i}")) ** 2) if i == j else F.lit(0.0)).alias(f"c{i}{j}")
            for i, j in _lower()
        ],
    )
    # the start is no subset's estimate: whatever the first step finds replaces it
    first = _cholesky(start).withColumn("logdet", F.lit(float("inf"))).withColumn("falls", F.lit(True))
    est = store(first.select("g", "n", *_names(), "logdet", "falls"), "estimate")
    discard(mid)
    fell = F.coalesce(F.col("logdet") < F.col("before") - tolerance, F.lit(False))
    while not est.where("falls").isEmpty():
        far = _beside(rows, est.where("falls"), groups).select(
            "g", "part", *STATS, _cell(_distance()).alias("cell")
        )
        cut = store(_quantile(far, ["g"], support).withColumnRenamed("cell", "cut"), "cut")
        inner = _beside(far, cut, groups).where("cell <= cut")
        next_one = _cholesky(_moments(inner.select("g", "part", *STATS)))
        held_one = est.select(
            "g", "n", *[F.col(c).alias(f"{c}_") for c in _names()], F.col("logdet").alias("before")
        )
        after = held_one.join(next_one, "g", "left").select(
            "g", "n", *[F.when(fell, F.col(c)).otherwise(F.col(f"{c}_")).alias(c) for c in _names()],
            F.when(fell, F.col("logdet")).otherwise(F.col("before")).alias("logdet"), fell.alias("falls"),
        )
        after = store(after, "estimate")
        discard(est, cut)
        est = after
    return est.drop("falls", "logdet")


def shrunk(est: DataFrame, rows: DataFrame, prior_rows: float = PRIOR_ROWS) -> DataFrame:
    """``estimates`` drawn towards those of group 0 (all rows), with the ``scale`` of each.

    A group of n rows keeps n / (n + ``prior_rows``) of its own location, covariance and scale, so
    that a verdict does not jump with a group's size. The scale makes the median squared distance
    that of chi-squared, but never raises a distance: where most rows are alike the least variances
    are the measure. The overall estimate is one row, which the driver hands on.
    """
    whole = est.where("g = 0").first()
    if whole is None:  # no rows; a table of its own, as the caller discards est
        return store(est.select("g", *_names(), F.lit(1.0).alias("scale")), "estimates")
    own = F.when(F.col("g") == 0, 1.0).otherwise(F.col("n") / (F.col("n") + prior_rows))
    kept = [c for c in _names() if c[0] != "l"]
    drawn = est.select(
        "g", own.alias("own"), *[(own * F.col(c) + (1 - own) * F.lit(whole[c])).alias(c) for c in kept]
    )
    drawn = store(_cholesky(drawn).select("g", "own", *_names()), "drawn")
    far = _beside(_in_parts(rows), drawn, drawn.count()).select("g", _cell(_distance()).alias("cell"))
    half = _quantile(far, ["g"], 0.5).select("g", (_uncell(F.col("cell")) / MIDDLE).alias("middle"))
    half = store(half, "middle")
    over_all = half.where("g = 0").first()["middle"]
    scale = F.greatest(F.col("own") * F.col("middle") + (1 - F.col("own")) * over_all, F.lit(1.0))
    out = store(drawn.join(half, "g").select("g", *_names(), scale.alias("scale")), "estimates")
    discard(drawn, half)
    return out


def judge(
    df: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
    cutoff: float = CUTOFF, prior_rows: float = PRIOR_ROWS,
) -> DataFrame:
    """``row`` (the input's columns), the base statistics, ``base_failed``, ``distance``, ``kept``.

    Rows that fail the base rules take no part in the estimates and are not kept. The others are
    kept unless their scaled distance from their language's and source's estimate, drawn towards the
    one over all rows as if that were ``prior_rows`` more rows, is above ``cutoff``. Null languages
    and sources are groups like others; texts without words fail the base rules; repeated rows count
    each and get equal verdicts. ``distance`` is null where no row of a group passes the base rules.
    An empty table gives no rows.
    """
    base = store(with_base(df, text_col).withColumn("base_failed", base_failed()), "base")
    group = F.xxhash64(F.lit(1), F.col(f"row.{lang_col}"), F.col(f"row.{source_col}"))
    # null and empty names must differ
    group = F.xxhash64(group, F.col(f"row.{lang_col}").isNull(), F.col(f"row.{source_col}").isNull())
    stats = base.where("NOT base_failed").select(group.alias("own"), *transformed())
    rows = store(
        stats.select(F.explode(F.array("own", F.lit(0).cast("long"))).alias("g"), *STATS), "statistics"
    )
    est = estimates(rows)
    drawn = shrunk(est, rows, prior_rows)
    discard(est, rows)
    placed = _in_parts(base.select("*", group.alias("g"), *transformed()))
    judged = _beside(placed, drawn, drawn.count(), "left")
    distance = _distance() / F.col("scale")
    return judged.select(
        "row", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        distance.alias("distance"),
        F.when(F.col("base_failed"), False).otherwise(F.coalesce(distance <= cutoff, F.lit(True)))
        .alias("kept"),
    )
