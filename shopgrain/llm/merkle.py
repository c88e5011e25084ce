"""Merkle manifest of a table: nested-interval labels, level-bucketed joins, proofs of every row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from shopgrain.llm.common import discard, store

BUCKET = 4  # levels of a bucket: a unit's interval has at most 16 units of the bucket below in it
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(x: Column) -> Column:
    """Lowercase hex sha256 of the UTF-8 bytes."""
    return F.sha2(x.cast("binary"), 256)


def leaf(**columns: Column) -> Column:
    """The digest of some values in order: ``-`` for null, else byte count, colon, value."""
    parts = []
    for value in columns.values():
        text = value.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return digest(F.concat(*parts))


def ranked(leaves: DataFrame, *order: str) -> DataFrame:
    """``leaves`` with ``rank`` (from 0) within its ``tree``, by ``order``. Runs jobs.

    Rows are dealt out by ranges of (tree, order), so a tree that holds most rows is numbered by many
    tasks; only a row count for each partition meets in one task. A null tree is the first one.
    """
    keys = [F.col(c).asc_nulls_first() for c in ("tree", *order)]
    dealt = leaves.repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = store(dealt.withColumn("at", F.monotonically_increasing_id()), "placed")
    part = F.shiftright("at", 33)
    counts = placed.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = store(
        counts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")), "bases"
    )
    place = F.col("base") + F.col("at") - F.shiftleft(F.col("part"), 33)
    whole = placed.withColumn("part", part).join(bases, "part").withColumn("place", place)
    first = store(whole.groupBy("tree").agg(F.min("place").alias("first"), F.count("*").alias("leaves")), "trees")
    return whole.join(
        first.withColumnRenamed("tree", "of"), F.col("tree").eqNullSafe(F.col("of"))
    ).select(*leaves.columns, (F.col("place") - F.col("first")).alias("rank"), "leaves")


def _height(leaves: Column) -> Column:
    """Levels above the leaves: the least h with 2**h >= leaves."""
    return F.length(F.bin(leaves - 1)) * (leaves > 1).cast("int")


def _folded(digests: Column) -> Column:
    """One level up: every two neighbours' digest, a last single one's own."""
    return F.transform(
        F.sequence(F.lit(0), (F.size(digests) - 1).bitwiseAND(-2), F.lit(2)),
        lambda i: F.sha2(F.concat(F.get(digests, i), F.coalesce(F.get(digests, i + 1), F.lit(""))).cast("binary"), 256),
    )


def _bucket(units: DataFrame, base: int) -> DataFrame:
    """Nodes (tree, level, lo, hi, digest, leaves) of the ``BUCKET`` levels above the units of level ``base``.

    Units of one interval of the next bucket, 16 at most, meet in one group and are folded there.
    """
    top = base + BUCKET
    groups = units.groupBy("tree", "leaves", F.shiftright("lo", top).alias("block")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("lo", "digest"))), lambda u: u["digest"]).alias("d0")
    )
    for n in range(1, BUCKET + 1):
        # Held in a column: a lambda would compute the level below again for each of its uses.
        groups = groups.withColumn(f"d{n}", _folded(F.col(f"d{n - 1}")))

    def numbered(n: int) -> Column:
        level = F.lit(base + n).alias("level")
        return F.transform(f"d{n}", lambda d, i: F.struct(level, i.alias("i"), d.alias("digest")))

    levels = [numbered(n) for n in range(1, BUCKET + 1)]
    nodes = groups.select("tree", "leaves", "block", F.inline(F.concat(*levels)))
    lo = F.shiftleft(F.col("block"), top) + F.expr("shiftleft(cast(i as bigint), level)")
    return nodes.select(
        "tree", "level", lo.alias("lo"),
        F.least(lo + F.expr("shiftleft(1L, level)"), F.col("leaves")).alias("hi"), "digest", "leaves",
    ).where(F.col("level") <= _height(F.col("leaves")))


def build(leaves: DataFrame) -> list[DataFrame]:
    """Nodes (tree, level, lo, hi, digest, leaves) over ``leaves`` (tree, rank, leaf, leaves), a stored
    table for each bucket of levels; the first also has the leaves themselves as level 0.

    A node carries the interval [lo, hi) of the leaf ranks that it covers. Runs a job for every
    ``BUCKET`` levels, each over a sixteenth of the rows of the one before.
    """
    units = leaves.select(
        "tree", F.lit(0).alias("level"), F.col("rank").alias("lo"), (F.col("rank") + 1).alias("hi"),
        F.col("leaf").alias("digest"), "leaves",
    )
    most = leaves.agg(F.max("leaves")).first()[0] or 0
    tables, base = [store(units, "nodes")], 0
    while 1 << base < most:
        below = tables[-1].where(F.col("level") == base)
        tables.append(store(_bucket(below, base), "nodes"))
        base += BUCKET
    return tables


def steps(nodes: DataFrame) -> DataFrame:
    """For each node with a parent in ``nodes``: (tree, level, lo, hi, left, right), the digests of its
    siblings, empty where there is none.

    The parent is the node a level above whose interval contains the node's; intervals of a level are
    dealt to buckets that no parent's interval crosses, so containment is looked for within a bucket.
    What the parent's interval has besides the node's is the sibling's.
    """
    own = nodes.withColumn("bucket", F.expr("shiftright(lo, level + 1)"))
    above = nodes.where("level > 0").select(
        F.col("tree").alias("p_tree"), (F.col("level") - 1).alias("p_level"), F.col("lo").alias("p_lo"),
        F.col("hi").alias("p_hi"), F.expr("shiftright(lo, level)").alias("bucket"),
    )
    inside = own.join(
        above,
        own["tree"].eqNullSafe(F.col("p_tree")) & (F.col("level") == F.col("p_level"))
        & (own["bucket"] == above["bucket"]) & (F.col("p_lo") <= F.col("lo")) & (F.col("hi") <= F.col("p_hi")),
    )
    family = inside.groupBy("p_tree", "level", "p_lo", "p_hi").agg(
        F.collect_list(F.struct("lo", "hi", "digest")).alias("children")
    )
    rest = lambda u, test: F.coalesce(
        F.get(F.filter("children", test), F.lit(0))["digest"], F.lit("")
    )
    return family.select("p_tree", "level", "p_lo", "p_hi", "children", F.explode("children").alias("u")).select(
        F.col("p_tree").alias("tree"), "level", "u.lo", "u.hi",
        F.when(F.col("u.lo") > F.col("p_lo"), rest(F.col("u"), lambda c: c["hi"] <= F.col("u.lo"))).otherwise("").alias("left"),
        F.when(F.col("u.hi") < F.col("p_hi"), rest(F.col("u"), lambda c: c["lo"] >= F.col("u.hi"))).otherwise("").alias("right"),
    )


def paths(tables: list[DataFrame]) -> tuple[DataFrame, DataFrame | None] | None:
    """(tree, unit, path): for every leaf rank the steps (left, right) up to level ``BUCKET``, and for every
    ``unit`` of that level those from there to the root; None if there are no such levels.

    Goes down from the root: units of a bucket's lowest level meet the ancestors whose intervals
    contain theirs, within the levels of the bucket, and take over the path above it.
    """
    above = None
    for k in range(len(tables) - 1, 1, -1):
        above = _attached(tables, k, above)
    return (_attached(tables, 1, None), above) if len(tables) > 1 else None


def _attached(tables: list[DataFrame], k: int, above: DataFrame | None) -> DataFrame:
    """``paths`` of the units at the lowest level of bucket ``k`` (level ``BUCKET * (k - 1)``)."""
    base = BUCKET * (k - 1)
    units = tables[k - 1].where(F.col("level") == base)
    nodes = units.union(tables[k])
    found = store(steps(nodes), "steps")
    members = units.select(
        "tree", F.col("lo").alias("unit"), F.explode(F.sequence(F.lit(base), F.lit(base + BUCKET - 1))).alias("level")
    ).withColumn("bucket", F.expr("shiftright(unit, level)"))
    ancestors = found.select(
        F.col("tree").alias("n_tree"), F.col("level").alias("n_level"), "lo", "hi", "left", "right",
        F.expr("shiftright(lo, level)").alias("n_bucket"),
    )
    chain = members.join(
        ancestors,
        members["tree"].eqNullSafe(F.col("n_tree")) & (F.col("level") == F.col("n_level"))
        & (F.col("bucket") == F.col("n_bucket")) & (F.col("lo") <= F.col("unit")) & (F.col("unit") < F.col("hi")),
    ).groupBy("tree", "unit").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("level", "left", "right"))),
            lambda s: F.struct(s["left"].alias("left"), s["right"].alias("right")),
        ).alias("path")
    ).withColumn("block", F.shiftright("unit", base + BUCKET))
    if above is not None:
        upper = above.select(F.col("tree").alias("u_tree"), F.col("unit").alias("u_unit"), F.col("path").alias("upper"))
        chain = chain.join(
            upper,
            chain["tree"].eqNullSafe(F.col("u_tree")) & (F.shiftleft("block", base + BUCKET) == F.col("u_unit")),
            "left",
        ).withColumn("path", F.concat("path", _or_none("upper")))
    out = store(chain.select("tree", "unit", "path"), "paths")
    discard(found, *([above] if above is not None else []))
    return out


def _or_none(path: str) -> Column:
    return F.coalesce(path, F.array().cast("array<struct<left:string,right:string>>"))


def proved(leaves: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``leaves`` (stored; tree, rank, leaf, leaves, ...) with ``path``, the steps from the leaf to its
    tree's root, none for a lone leaf; and (tree, subroot) for each tree. Runs jobs."""
    tables = build(leaves)
    roots = None
    for t in tables:
        top = t.where((F.col("lo") == 0) & (F.col("level") == _height(F.col("leaves")))).select(
            "tree", F.col("digest").alias("subroot")
        )
        roots = top if roots is None else roots.union(top)
    roots = store(roots, "roots")
    found = paths(tables)
    discard(*tables)
    whole = leaves
    for place, path, unit in (
        ("low", found and found[0], F.col("rank")),
        ("high", found and found[1], F.expr(f"shiftleft(shiftright(rank, {BUCKET}), {BUCKET})")),
    ):
        if path is None:
            whole = whole.withColumn(place, _or_none(F.lit(None)))
            continue
        path = path.select(F.col("tree").alias("t"), F.col("unit").alias("u"), F.col("path").alias(place))
        whole = whole.join(path, F.col("tree").eqNullSafe(F.col("t")) & (unit == F.col("u")), "left").drop("t", "u")
    return whole.withColumn("path", F.concat(_or_none("low"), _or_none("high"))).drop("low", "high"), roots


def fold(start: Column, path: Column) -> Column:
    """The root that a leaf and the steps above it give."""
    return F.aggregate(path, start, lambda d, s: digest(F.concat(s["left"], d, s["right"])))


def manifest(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) for every row of ``docs``.

    A row's leaf is the digest of ``FIELDS``. In each language the leaves ascend by id (null first,
    equal ids by leaf) and are folded by twos; the languages' roots, null first and then by the bytes
    of their names, are folded likewise. The proof is the digest of all siblings up to the root.
    Rows for which ``tampered`` holds are checked with n_chars + 1 in their leaf: ``folded_root`` is what
    the leaf and the siblings give, ``verified`` whether it is the root.

    Nulls are values of their own. Repeated rows have leaves of their own. A table of one row has its
    leaf as root and the digest of nothing as proof. An empty table gives no rows. Texts are read
    once and do not move; other columns do not matter.
    """
    n = F.col("n_chars").cast("long")
    changed = F.coalesce(tampered, F.lit(False)) if tampered is not None else F.lit(False)
    given = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("tree"),
        leaf(**{c: F.col(c) for c in FIELDS}).alias("leaf"),
        F.when(changed, leaf(**{c: F.col(c) if c != "n_chars" else n + 1 for c in FIELDS})).alias("other"),
    )
    given = store(given, "leaves")
    rows, subroots = proved(store(ranked(given, "doc_id", "leaf"), "ranked"))
    # The languages' roots are the leaves of one more tree.
    tops = subroots.select(F.lit("").alias("tree"), F.col("tree").alias("lang"), F.col("subroot").alias("leaf"))
    tops, root = proved(store(ranked(tops, "lang"), "tops"))
    upper = store(
        tops.join(root, "tree").select(
            "lang", F.col("leaf").alias("subroot"), F.col("subroot").alias("root"), F.col("path").alias("upper")
        ),
        "upper",
    )
    whole = (
        rows.join(upper, F.col("tree").eqNullSafe(F.col("lang")))
        .withColumn("steps", F.concat("path", "upper"))
        .select(
            "doc_id", "leaf", "subroot", "root",
            digest(F.concat_ws("", F.transform("steps", lambda s: F.concat(s["left"], s["right"])))).alias("proof_sha256"),
            fold(F.coalesce("other", "leaf"), F.col("steps")).alias("folded_root"),
        )
    )
    return whole.withColumn("verified", F.col("folded_root") == F.col("root"))
