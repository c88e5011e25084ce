"""Near duplicates by MinHash against all pairs in plain Python."""

import random

import numpy as np
import pytest

from shopgrain.llm import minhash
from shopgrain.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def shingles(text, size=4):
    words = [w.lower() for w in (text or "").encode().split()]
    return {tuple(words[j : j + size]) for j in range(len(words) - size + 1)} or ({tuple(words)} if words else set())


def brute(docs):
    """{id: (set size, component, kept)} of {id: text}."""
    sets = {i: shingles(t) for i, t in docs.items()}
    root = {i: i for i in docs}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(docs)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


def found(df):
    rows = df.collect()
    got = {r[0]: tuple(r)[1:] for r in rows}
    assert len(got) == len(rows)
    return got


def test_op11(spark):
    texts = {r[0]: r[1] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    assert found(QUERIES["op11_minhash_near_dedup"](spark, SF)) == brute(texts)


def crowd(rng, base, count, most):
    """Copies of one text with up to ``most`` words changed: some link, others hang by a few or by none."""
    made = []
    for _ in range(count):
        words = list(base)
        for at in rng.sample(range(len(words)), rng.randint(0, most)):
            words[at] = f"x{rng.random()}"
        made.append(" ".join(words))
    return made


@pytest.mark.parametrize("full,block", [(16, 1 << 18), (1, 700), (10_000, 700)])
def test_a_crowd_of_copies(spark, docs, monkeypatch, full, block):
    monkeypatch.setattr(minhash, "FULL_BUCKET", full)
    monkeypatch.setattr(minhash, "BLOCK", block)
    rng = random.Random(1)
    made = ["a b", "A  B", "a b c"]
    for most in (2, 6, 12):
        made += crowd(rng, [f"w{rng.randrange(500)}" for _ in range(100)], 50, most)
    texts = dict(enumerate(made))
    got = found(minhash.near_duplicates(docs(*texts.items())))
    want = brute(texts)
    assert got == want and 5 < len({c for _, c, _ in want.values()}) < 120


def test_estimates_follow_the_similarity(spark):
    rng, factors, rows = np.random.default_rng(5), minhash._factors(42), []
    for share in (0.3, 0.6, 0.8, 0.95):
        for _ in range(30):
            both = rng.integers(0, 1 << 63, 1000, dtype=np.uint64)
            cut = int(1000 * (1 - share) / 2)
            x, y = both[: 1000 - cut], both[cut:]
            sig = [minhash.signature(minhash.least_hashes(np.unique(s), factors)).tolist() for s in (x, y)]
            rows.append((len(both[cut : 1000 - cut]) / 1000, *sig))
    df = spark.createDataFrame(rows, "j double, x array<long>, y array<long>")
    errors = [r["e"] - r["j"] for r in df.select("j", minhash.estimate("x", "y").alias("e")).collect()]
    assert abs(np.mean(errors)) < 0.02 and max(map(abs, errors)) < minhash.SLACK


def test_odd_rows(spark, rowdy):
    got = sorted(map(tuple, minhash.near_duplicates(rowdy).collect()), key=repr)
    one, long, odd = (1, 3), *(len(shingles(rowdy.where(f"doc_id = {i}").first()["text"])) for i in (5, 7))
    assert got == sorted([
        (1, 0, 1, True), (2, 0, 2, True), (None, 0, None, True), (4, 0, 4, True), (3, *one, True), (3, *one, True),
        (None, *one, False), (3, 1, 3, True), (5, long, 5, True), (6, long, 5, False), (7, odd, 7, True), (8, 1, 8, True),
    ], key=repr)
    assert minhash.near_duplicates(rowdy.limit(0)).collect() == []
