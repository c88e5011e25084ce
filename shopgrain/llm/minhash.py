"""b-bit MinHash near duplicates: bands, packed signatures, links confirmed on whole sets, components."""

from __future__ import annotations

from collections.abc import Iterable
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from shopgrain.llm.common import discard, per_batch, row_key, store, text_of, words_of
from shopgrain.llm.components import components

BANDS, ROWS = 32, 6  # least hashes of a set: bands of so many; a candidate pair shares a band
HASHES = BANDS * ROWS
BITS = 4  # kept of each least hash in the signature
WORDS = HASHES // 64  # longs of a signature's bit plane
SLACK = 0.16  # more than five standard deviations of the estimate at a similarity of 0.8
FULL_BUCKET = 16  # a fuller bucket is compared in blocks, without listing its pairs
BLOCK = 1 << 18  # shingles of a block's side, about
COLUMNS = 4096  # distinct shingles that a block multiplies at once
MIX = 0x9E3779B97F4A7C15


def _mixed(x: np.ndarray) -> np.ndarray:
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(33))


def shingle_set(text: str | None, size: int, seed: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the ``size``-word shingles, A-Z lower-cased; a shorter text is one
    shingle, a text without words has none."""
    words = [w.lower() for w in words_of(text)]
    base = np.fromiter(map(xxhash.xxh64_intdigest, words, repeat(seed)), dtype=np.uint64, count=len(words))
    size = min(size, len(base))
    if not size:
        return base
    places = np.arange(1, size + 1, dtype=np.uint64) * np.uint64(MIX) + np.uint64(size)
    runs = np.zeros(len(base) - size + 1, dtype=np.uint64)
    for i in range(size):
        runs += _mixed(base[i : i + len(runs)] ^ places[i])
    return np.unique(_mixed(runs))


def _factors(seed: int) -> np.ndarray:
    """Odd factors of the hash functions."""
    return np.random.default_rng(seed).integers(0, 1 << 31, HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def least_hashes(shingles: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """The least value of each hash function over a set that is not empty."""
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(len(factors), (1 << 32) - 1, dtype=np.uint32)
    for at in range(0, len(short), 1024):
        np.minimum(least, (factors[:, None] * short[None, at : at + 1024]).min(axis=1), out=least)
    return least


def band_keys(least: np.ndarray) -> np.ndarray:
    """One key for each band; sets of Jaccard similarity j share a band with probability
    1 - (1 - j**ROWS)**BANDS: all but 6 in 100,000 at 0.8."""
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for column in least.reshape(BANDS, ROWS).T:
        key = _mixed(key * np.uint64(MIX) ^ column.astype(np.uint64))
    return key.view(np.int64)


def signature(least: np.ndarray) -> np.ndarray:
    """``BITS`` low bits of each mixed least hash, packed as bit planes of ``WORDS`` longs each."""
    low = (_mixed(least.astype(np.uint64)) & np.uint64((1 << BITS) - 1)).astype(np.uint8)
    planes = [np.packbits(low >> b & 1, bitorder="little").view(np.int64) for b in range(BITS)]
    return np.concatenate(planes)


def estimate(x: str, y: str) -> Column:
    """Similarity by two signature columns: the share of equal b-bit values, less those equal by chance."""
    differ = None
    for w in range(WORDS):
        planes = [F.get(x, F.lit(b * WORDS + w)).bitwiseXOR(F.get(y, F.lit(b * WORDS + w))) for b in range(BITS)]
        some = planes[0]
        for p in planes[1:]:
            some = some.bitwiseOR(p)
        count = F.bit_count(some)
        differ = count if differ is None else differ + count
    by_chance = 2.0**-BITS
    return ((HASHES - differ) / F.lit(float(HASHES)) - by_chance) / (1 - by_chance)


def sketches(df: DataFrame, size: int, id_col: str, text_col: str, seed: int) -> DataFrame:
    """(id, k1, k2, n, h1, h2, bands, sig): per row its key and its set's size, two independent hashes that
    name the set, band keys and signature; the last four null for an empty set."""

    def make():
        factors = _factors(seed)

        def step(batch: pa.RecordBatch) -> Iterable[pa.RecordBatch]:
            n, h1, h2, bands, sigs = [], [], [], [], []
            for text in batch.column(3):
                found = shingle_set(text.as_py(), size, seed)
                n.append(len(found))
                if not len(found):
                    for out in (h1, h2, bands, sigs):
                        out.append(None)
                    continue
                data = found.tobytes()
                h1.append(np.uint64(xxhash.xxh64_intdigest(data, seed)).astype(np.int64))
                h2.append(np.uint64(xxhash.xxh64_intdigest(data, seed + 1)).astype(np.int64))
                least = least_hashes(found, factors)
                bands.append(band_keys(least))
                sigs.append(signature(least))
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:3], pa.array(n, pa.int64()), pa.array(h1, pa.int64()),
                    pa.array(h2, pa.int64()), pa.array(bands, longs), pa.array(sigs, longs),
                ],
                ["id", "k1", "k2", "n", "h1", "h2", "bands", "sig"],
            )

        return step

    src = df.select(
        F.col(id_col).cast("long").alias("id"), *row_key(F.col(id_col), text_of(text_col)),
        F.col(text_col).cast("string").alias("t"),
    )
    return per_batch(
        src, make, "id long, k1 long, k2 long, n long, h1 long, h2 long, bands array<long>, sig array<long>"
    )


def _sets(df: DataFrame, rows: DataFrame, size: int, id_col: str, text_col: str, seed: int) -> DataFrame:
    """(node, shingles) of ``rows`` (k1, k2, node), from one row's text for each node."""

    def make():
        def step(batch: pa.RecordBatch) -> Iterable[pa.RecordBatch]:
            for node, text in zip(batch.column(0), batch.column(1)):
                found = shingle_set(text.as_py(), size, seed).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([node.as_py()], pa.int64()), pa.array([found], pa.list_(pa.int64()))],
                    ["node", "shingles"],
                )

        return step

    texts = df.select(*row_key(F.col(id_col), text_of(text_col)), F.col(text_col).cast("string").alias("t"))
    texts = texts.join(rows, ["k1", "k2"]).select("node", "t").dropDuplicates(["node"])
    return per_batch(texts, make, "node long, shingles array<long>")


def candidates(members: DataFrame) -> DataFrame:
    """Pairs (p, q) of ``members`` (key, node, n, sig, copies, size) to confirm: all pairs of buckets up to
    ``FULL_BUCKET``, and of a fuller bucket each member with the one of which there are most copies.
    A pair's sizes allow a similarity of 0.8 and its estimate does not speak against it."""
    first = F.max(F.struct("copies", -F.col("node"), "node", "n", "sig")).alias("hub")
    full = members.where(F.col("size") > FULL_BUCKET)
    hubs = full.groupBy("key").agg(first).select("key", "hub.node", "hub.n", "hub.sig")
    few = members.where(F.col("size") <= FULL_BUCKET).select("key", "node", "n", "sig")
    found = None
    for left, right, once in (
        (few, few, F.col("x.node") < F.col("y.node")),
        (full.select("key", "node", "n", "sig"), hubs, F.col("x.node") != F.col("y.node")),
    ):
        on = (F.col("x.key") == F.col("y.key")) & once
        on = on & (5 * F.least("x.n", "y.n") >= 4 * F.greatest("x.n", "y.n"))
        on = on & (estimate("x.sig", "y.sig") >= 0.8 - SLACK)
        pairs = left.alias("x").join(right.alias("y"), on).select(F.col("x.node").alias("p"), F.col("y.node").alias("q"))
        found = pairs if found is None else found.union(pairs)
    return found.distinct()


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The ``pairs`` (p, q) whose whole sets have a similarity of 0.8 or more, as links (a, b)."""
    p = sets.select(F.col("node").alias("p"), F.col("shingles").alias("s"))
    q = sets.select(F.col("node").alias("q"), F.col("shingles").alias("t"))
    common = F.size(F.array_intersect("s", "t"))
    alike = pairs.join(p, "p").join(q, "q").where(9 * common >= 4 * (F.size("s") + F.size("t")))
    return alike.select(F.col("p").alias("a"), F.col("q").alias("b"))


def _block_links(table: pa.Table) -> pa.Table:
    """Links between components, from a block's rows (side 0, 1, or 2 for both; comp, shingles)."""
    side = table.column("side").to_numpy()
    comp = table.column("comp").to_numpy()
    lists = table.column("shingles").combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    ends = lists.offsets.to_numpy()
    flat = lists.values.to_numpy()[ends[0] : ends[-1]]
    n = np.diff(ends)
    row = np.repeat(np.arange(len(n)), n)
    _, word, times = np.unique(flat, return_inverse=True, return_counts=True)
    again = times > 1  # others are in no intersection
    number = np.cumsum(again) - 1
    keep = again[word]
    row, word = row[keep], number[word[keep]]
    order = np.argsort(word, kind="stable")
    row, word = row[order], word[order]
    left, right = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
    common = np.zeros((len(left), len(right)), dtype=np.float32)
    for at in range(0, int(again.sum()), COLUMNS):
        lo, hi = np.searchsorted(word, (at, at + COLUMNS))
        part = np.zeros((len(n), COLUMNS), dtype=np.float32)
        part[row[lo:hi], word[lo:hi] - at] = 1
        common += part[left] @ part[right].T
    linked = 9 * common >= 4 * (n[left][:, None] + n[right][None, :])
    top = np.iinfo(np.int64).max
    a, b = comp[left].copy(), comp[right].copy()
    while linked.size:
        new_a = np.minimum(a, np.where(linked, b[None, :], top).min(axis=1))
        new_b = np.minimum(b, np.where(linked, new_a[:, None], top).min(axis=0))
        if (new_a == a).all() and (new_b == b).all():
            break
        a, b = new_a, new_b
    pairs = np.unique(np.column_stack([np.r_[comp[left], comp[right]], np.r_[a, b]]), axis=0)
    pairs = pairs[pairs[:, 0] != pairs[:, 1]]
    return pa.table({"a": pa.array(pairs[:, 0], pa.int64()), "b": pa.array(pairs[:, 1], pa.int64())})


def block_links(members: DataFrame, roots: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) between the components ``roots`` (node, root) of ``members`` (key, node, n, size), the
    buckets fuller than ``FULL_BUCKET``, where a pair of two components is alike.

    A bucket's largest component is dealt into blocks of about ``BLOCK`` shingles and so are the others'
    members, the rest; the rest's blocks are compared with each other and with those of the
    component. So a bucket is split over tasks of bounded size, a crowd that hangs together costs
    a pass for each block of those that do not, and no pairs are listed.
    """
    full = members.where(F.col("size") > FULL_BUCKET).select("key", "node", "n")
    named = store(
        full.join(roots, "node", "left").select("key", "node", "n", F.coalesce("root", "node").alias("comp")), "named"
    )
    weights = named.groupBy("key", "comp").agg(F.sum("n").alias("w"))
    buckets = store(
        weights.groupBy("key").agg(
            F.count("*").alias("comps"), F.sum("w").alias("all"), F.max(F.struct("w", "comp")).alias("main")
        ).where("comps > 1").select(
            "key", F.col("main.comp").alias("main"),
            F.ceil((F.col("all") - F.col("main.w")) / BLOCK).cast("int").alias("rest_blocks"),
            F.ceil(F.col("main.w") / BLOCK).cast("int").alias("main_blocks"),
        ),
        "buckets",
    )
    live = named.join(buckets, "key").withColumn("is_main", F.col("comp") == F.col("main"))
    own = F.pmod(F.xxhash64("node"), F.when(F.col("is_main"), F.col("main_blocks")).otherwise(F.col("rest_blocks"))).cast("int")
    live = live.withColumn("own", own)
    upto = lambda c: F.sequence(F.lit(0), F.col(c) - 1)
    place = lambda with_main, i, j, side: F.struct(
        F.lit(with_main).alias("with_main"), i.alias("i"), j.alias("j"), side.alias("side")
    )
    among_rest = F.transform(
        upto("rest_blocks"),
        lambda k: place(
            False, F.least("own", k), F.greatest("own", k),
            F.when(F.col("own") == k, 2).when(F.col("own") < k, 0).otherwise(1),
        ),
    )
    to_main = F.transform(upto("main_blocks"), lambda k: place(True, F.col("own"), k, F.lit(0)))
    of_main = F.transform(upto("rest_blocks"), lambda k: place(True, k, F.col("own"), F.lit(1)))
    blocks = live.select(
        "key", "node", "comp", F.inline(F.when(F.col("is_main"), of_main).otherwise(F.concat(among_rest, to_main)))
    )
    rows = blocks.join(sets, "node").select("key", "with_main", "i", "j", "side", "comp", "shingles")
    found = rows.groupBy("key", "with_main", "i", "j").applyInArrow(_block_links, "a long, b long")
    out = store(found.distinct(), "block-links")
    discard(named, buckets)
    return out


def near_duplicates(
    df: DataFrame, size: int = 4, id_col: str = "doc_id", text_col: str = "text", seed: int = 42
) -> DataFrame:
    """(id, n_shingles, component_id, kept) for each row of ``df``: the size of its set of ``size``-word
    shingles, the least id reachable over links, and whether that is its own.

    Texts are linked if the Jaccard similarity of their sets is 0.8 or more. Pairs that share a band
    of least hashes are candidates; packed b-bit signatures rule out those far below; links are
    confirmed on the whole sets (by 64-bit hashes of the shingles). Equal sets are one node before
    anything is compared. A pair at 0.8 shares no band with probability 6 in 100,000.

    Texts without words and null texts have no set and are linked with nothing. Null ids take part; a
    component of null ids only has a null component, in which all rows are kept. Rows that share an id
    only stay apart; repeated rows get equal results. An empty table gives no rows. Runs jobs.
    """
    made = store(sketches(df, size, id_col, text_col, seed), "sketches")
    classes = made.where("n > 0").groupBy("h1", "h2").agg(
        F.min("id").alias("least"), F.count("*").alias("copies"), F.first("n").alias("n"),
        F.min(F.struct("k1", "k2")).alias("row"),
    )
    classes = store(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    keys = made.where("n > 0").select("h1", "h2", "sig", "bands").dropDuplicates(["h1", "h2"])
    keys = keys.join(classes.select("h1", "h2", "node", "n", "copies"), ["h1", "h2"])
    keys = store(keys.select("node", "n", "copies", "sig", "bands"), "keys")
    each = keys.select("node", F.explode("bands").alias("key"))
    shared = store(each.groupBy("key").agg(F.count("*").alias("size")).where("size > 1"), "shared")
    members = store(each.join(shared, "key"), "members")
    nodes = store(members.select("node").distinct(), "nodes")
    rows = classes.join(nodes, "node", "left_semi").select("node", "row.k1", "row.k2")
    sets = store(_sets(df, rows, size, id_col, text_col, seed), "sets")
    members = members.join(keys.select("node", "n", "copies", "sig"), "node")
    pairs = store(candidates(members), "pairs")
    links = store(confirmed(pairs, sets), "links")
    roots = components(links)
    links = links.union(block_links(members, roots, sets))
    roots = components(links)
    discard(keys, shared, nodes, sets, pairs)
    named = store(
        classes.join(roots, "node", "left").select("h1", "h2", "least", F.coalesce("root", "node").alias("root")), "named"
    )
    ids = named.groupBy("root").agg(F.min("least").alias("component_id"))
    found = store(named.join(store(ids, "ids"), "root").select("h1", "h2", "component_id"), "found")
    whole = made.select("id", "n", "h1", "h2").join(found, ["h1", "h2"], "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id"))
    return whole.select("id", F.col("n").alias("n_shingles"), component.alias("component_id")).withColumn(
        "kept", F.col("id").eqNullSafe(F.col("component_id"))
    )
