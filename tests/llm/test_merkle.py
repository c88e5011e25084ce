"""Proofs of the manifest against a plain tree, over odd rows and trees of all small sizes."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from shopgrain.llm import merkle

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return sha("".join("-" if row[c] is None else f"{len(str(row[c]).encode())}:{row[c]}" for c in FIELDS))


def tree(level):
    """The root, and for each leaf its (sibling or None, whether it is on the left)."""
    at, paths = list(range(len(level))), [[] for _ in level]
    while len(level) > 1:
        for path, i in zip(paths, at):
            path.append((level[i ^ 1] if i ^ 1 < len(level) else None, i & 1))
        level = [sha("".join(level[i : i + 2])) for i in range(0, len(level), 2)]
        at = [i // 2 for i in at]
    return level[0], paths


def brute(rows, tampered):
    by_lang = {}
    for n, row in enumerate(rows):
        by_lang.setdefault(row["lang"], []).append((row["doc_id"] is not None, row["doc_id"] or 0, leaf(row), n))
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    subroots, low = {}, {}
    for lang in langs:
        leaves = sorted(by_lang[lang])
        subroots[lang], paths = tree([x[2] for x in leaves])
        low |= {x[3]: p for x, p in zip(leaves, paths)}
    root, high = tree([subroots[x] for x in langs])
    out = []
    for n, row in enumerate(rows):
        path = low[n] + high[langs.index(row["lang"])]
        found = leaf(row | {"n_chars": row["n_chars"] + 1} if tampered(row) and row["n_chars"] is not None else row)
        for other, left in path:
            found = sha((other or "") + found if left else found + (other or ""))
        proof = sha("".join(x for x, _ in path if x))
        out.append((row["doc_id"], leaf(row), subroots[row["lang"]], root, proof, found, found == root))
    return sorted(out, key=repr)


def check(df):
    marked = merkle.manifest(df, F.crc32(F.col("doc_id").cast("string")) % 7 == 0)
    rows = [r.asDict() for r in df.select(*FIELDS).collect()]
    want = brute(rows, lambda r: r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0)
    assert sorted(map(tuple, marked.collect()), key=repr) == want
    return want


def test_odd_rows(spark, rowdy):
    langs = rowdy.withColumn("lang", F.when(F.col("doc_id") > 2, F.col("lang")).when(F.col("doc_id") == 1, "é"))
    assert any(not r[-1] for r in check(langs.union(langs.withColumn("doc_id", F.col("doc_id") + 50))))
    assert merkle.manifest(rowdy.limit(0)).collect() == []
    assert all(r["verified"] for r in merkle.manifest(rowdy).collect())


@pytest.mark.parametrize("size", [1, 2, 17, 300])
def test_sizes(spark, size):
    check(spark.range(size).selectExpr(
        "id * 3 AS doc_id", "'s' AS source", "CASE WHEN id < 16 THEN 'b' ELSE 'a' END AS lang", "id AS n_chars",
        "repeat('x', id) AS text",
    ))
