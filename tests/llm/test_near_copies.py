"""What the SimHash stage keeps: one of each group within two bits, everything else."""

import random

from shopgrain.llm import simhash


def test_texts_that_share_a_part_all_stay(spark, docs):
    """Half-alike texts (three quarters of the words shared, at other places of the fingerprint) are no copies."""
    rng = random.Random(2)
    shared = [f"s{rng.randrange(10**6)}" for _ in range(300)]
    texts = [" ".join(shared + [f"o{rng.random()}" for _ in range(110)]) for _ in range(60)]
    prints = [simhash.shingle_fingerprint(t, 3, 42) for t in texts]
    near = {b for a in range(60) for b in range(a + 1, 60) if bin((prints[a] ^ prints[b]) & (1 << 64) - 1).count("1") <= 2}
    kept = {r["doc_id"] for r in simhash.keep_one(docs(*texts)).collect()}
    assert kept >= set(range(60)) - near and len(near) < 6


def test_one_of_each_group_of_copies_stays(spark, docs):
    rng = random.Random(3)
    made = [" ".join(f"w{rng.randrange(3000)}" for _ in range(80)) for _ in range(20)]
    out = simhash.keep_one(docs(*[(i + 100 * n, t.upper() if n else t) for i, t in enumerate(made) for n in range(3)]))
    assert sorted(r["doc_id"] for r in out.collect()) == list(range(20))


def test_rows_that_share_an_id_only_stay_apart(spark, rowdy):
    got = simhash.near_duplicates(simhash.fingerprints(rowdy)).select("id", "print", "group").collect()
    assert len({r["group"] for r in got if r["id"] == 3}) == 2
    kept = {(r["doc_id"], r["text"]) for r in simhash.keep_one(rowdy).collect()}
    assert {(3, "one"), (3, "another text")} <= kept and (None, "one") not in kept
