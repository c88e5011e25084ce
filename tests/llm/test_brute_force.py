"""Queries that SQL cannot express, against plain Python over the smallest tables."""

import collections
import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shopgrain.llm import bpe, imatch, outliers, simhash, substrings
from shopgrain.llm.packing import plan, slots
from shopgrain.llm.queries import QUERIES
from shopgrain.llm.tokens import ByteDecoder, ByteEncoder, WordEncoder, byte_table, read_ranks

SF = "/root/testdata/sf0.001"
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    return {r[0]: r[1] or "" for r in rows}


def sha(data):
    return hashlib.sha256(data).hexdigest()


def by_id(spark, name):
    rows = QUERIES[name](spark, SF).collect()
    got = {r["doc_id"]: r.asDict() for r in rows}
    assert len(got) == len(rows)
    return got


def removed(docs, window):
    """Words covered by a window that starts in two places, and the kept words."""
    seen = collections.Counter()
    words = {i: t.encode().split() for i, t in docs.items()}
    for w in words.values():
        seen.update(tuple(w[j : j + window]) for j in range(len(w) - window + 1))
    out = {}
    for i, w in words.items():
        gone = set()
        for j in range(len(w) - window + 1):
            if seen[tuple(w[j : j + window])] > 1:
                gone.update(range(j, j + window))
        out[i] = (len(w), len(gone), b" ".join(x for j, x in enumerate(w) if j not in gone))
    return out


def test_op8(spark, texts):
    got = by_id(spark, "op8_substring_dedup")
    want = removed(texts, 35)
    assert {i: (r["n_words"], r["n_removed"], r["kept_sha256"]) for i, r in got.items()} == {
        i: (n, k, sha(t)) for i, (n, k, t) in want.items()
    }
    assert sum(k for _, k, _ in want.values()) > 0


@pytest.mark.parametrize("window,seed", [(3, 1), (4, 2), (6, 6)])
def test_substrings_of_dense_repeats(spark, docs, window, seed):
    rng = np.random.default_rng(window)
    made = {i: " ".join(rng.choice(list("abc"), rng.integers(0, 40))) for i in range(60)}
    out = substrings.drop_repeated_passages(docs(*made.items()), window=window, seed=seed)
    got = {r["row"]["doc_id"]: (r["n_words"], r["n_removed"], r["kept"].encode()) for r in out.collect()}
    assert got == removed(made, window)


@pytest.mark.parametrize("window,seed", [(3, 1), (5, 2)])
def test_factors_are_copies_of_their_source(spark, docs, window, seed):
    """Copied from its source, each factor gives the text's own words; they cover what is removed."""
    rng = np.random.default_rng(window)
    base = [f"w{i}" for i in range(400)]
    made = {}
    for i in range(40):
        cuts = [base[a : a + rng.integers(1, 30)] for a in rng.integers(0, 380, 6)]
        made[i] = " ".join(x for cut in cuts for x in [*cut, f"own{i}"])
    made |= {100: made[0], 101: made[0], 102: made[1] + " " + made[1], 103: None, 104: ""}
    texts = [*made.items(), (100, made[0])]
    rows = substrings.drop_repeated_passages(docs(*texts), window=window, seed=seed).collect()
    words = {r["key"]: (r["row"]["text"] or "").split() for r in rows}
    elsewhere = 0
    for r in rows:
        own, covered = words[r["key"]], set()
        assert [f["start"] for f in r["factors"]] == sorted(f["start"] for f in r["factors"])
        for f in r["factors"]:
            a, m, p = f["start"], f["length"], f["place"]
            assert m >= window and own[a : a + m] == words[f["source"]][p : p + m]
            elsewhere += (f["source"], p) != (r["key"], a)
            covered.update(range(a, a + m))
        assert len(covered) == r["n_removed"]
    assert elsewhere > 40
    whole = next(r for r in rows if r["row"]["doc_id"] == 101)
    assert len(whole["factors"]) < 20


def groups(prints):
    ids = sorted(prints)
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if bin(prints[a] ^ prints[b]).count("1") <= 2:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("full", [64, 1])
def test_op10(spark, texts, monkeypatch, full):
    monkeypatch.setattr(simhash, "FULL_BUCKET", full)
    prints = {}
    for i, t in texts.items():
        w = [x.lower() for x in t.encode().split()]
        shingles = [b" ".join(w[j : j + 3]) for j in range(len(w) - 2)] or ([b" ".join(w)] if w else [])
        hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
        prints[i] = sum(
            1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)
        )
    want = {i: (f"{prints[i]:016x}", c) for i, c in groups(prints).items()}
    got = by_id(spark, "op10_simhash_near_dedup")
    assert {i: (r["fingerprint"], r["component_id"]) for i, r in got.items()} == want


@pytest.mark.parametrize("full", [64, 2])
def test_links_of_a_crowd(spark, monkeypatch, full):
    """Many fingerprints near one another: a chain, a ball and far ones."""
    monkeypatch.setattr(simhash, "FULL_BUCKET", full)
    rng, made = np.random.default_rng(3), []
    for _ in range(4):
        at = int(rng.integers(1 << 62))
        for _ in range(40):
            made.append(at)
            for bit in rng.integers(0, 63, 3 if rng.random() < 0.3 else 1):
                at ^= 1 << int(bit)
    prints = dict(enumerate(made))
    df = spark.createDataFrame(list(prints.items()), "id long, print long")
    got = {r["id"]: r["component"] for r in simhash.near_duplicates(df).collect()}
    assert got == groups(prints)


def test_op1(spark, texts):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {}
    for i, t in texts.items():
        ids = np.array(library.encode(t, add_special_tokens=False).ids + [1], dtype="<u4")
        for piece, at in enumerate(range(0, len(ids), 4096)):
            part = ids[at : at + 4096]
            want[i, piece] = (at, len(part), zlib.crc32(part.tobytes()))
    rows = [r.asDict() for r in QUERIES["op1_best_fit_packing"](spark, SF).collect()]
    assert {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in rows} == want
    sequences = collections.defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 4096
    least = -(-sum(r["length"] for r in rows) // 4096)
    assert len(sequences) <= least * 1.02 + 1


@pytest.mark.parametrize("most", [1 << 19, 40])
def test_word_ids_of_odd_texts(most):
    path = public_tokenizers.path("word_bpe_49k.json")
    library, own = Tokenizer.from_file(path), WordEncoder(path)
    own.parts.most = own.pieces.most = most  # small generations are forgotten between calls
    rng = np.random.default_rng(4)
    signs = [*"abeEéÉ ß我中あ😀👍🏽12\n\t'sre.,!? İŞqقلب́\xa0\x85Ǆ<|>", "<|endoftext|>", "<|startoftext|>", " "]
    texts = ["".join(rng.choice(signs, rng.integers(0, 60))) for _ in range(2000)] + [None, ""]
    for at in range(0, len(texts), 100):
        for text, ids in zip(texts[at : at + 100], own(texts[at : at + 100]), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == library.encode(text or "", add_special_tokens=False).ids


def test_a_plan_uses_every_document_once():
    rng = np.random.default_rng(5)
    for size in (3, 500, 200_000):
        lengths = np.clip(rng.lognormal(5, 1.2, size).astype(int), 1, 1000)
        counts = np.bincount(lengths, minlength=1001)
        planned = plan(counts, 1000)
        used = np.zeros_like(counts)
        for repeats, parts in planned:
            assert sum(v * n for v, n in parts) <= 1000
            for v, n in parts:
                used[v] += repeats * n
        assert (used == counts).all()
        sequences = sum(r for r, _ in planned)
        assert sequences <= -(-lengths.sum() // 1000) * 1.01 + 1
        assert len(slots(planned, 1000)["length"]) >= len(planned)


def test_op4(spark, texts):
    library = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(RANKS), special_tokens={}
    )
    got = by_id(spark, "op4_byte_bpe")
    for i, t in texts.items():
        ids = np.array(library.encode_ordinary(t), dtype="<u4")
        row = got[i]
        assert (row["n_tokens"], row["ids_sha256"]) == (len(ids), sha(ids.tobytes()))
        assert row["decoded_sha256"] == sha(t.encode())


def test_encoding_of_odd_texts():
    library = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(RANKS), special_tokens={}
    )
    own, back = ByteEncoder(RANKS, public_tokenizers.PATTERN), ByteDecoder(RANKS)
    rng = np.random.default_rng(1)
    signs = list("abeé ß我中あ😀👍🏽12\n\t'srell.,!? قلب")
    for _ in range(3000):
        t = "".join(rng.choice(signs, rng.integers(0, 40)))
        ids = np.frombuffer(own.encode(t), dtype="<u4").tolist()
        assert ids == library.encode_ordinary(t)
        assert back.decode(ids) == t.encode()
        spans = own.offsets(t)
        assert len(spans) == len(ids)
        for i, (a, b) in enumerate(spans):  # the characters hold the token's bytes
            assert back.decode([ids[i]]) in t[a:b].encode()


def test_op5(spark, texts):
    got = by_id(spark, "op5_quality_rules")
    for i, t in texts.items():
        w = t.encode().split()
        seen = collections.Counter(tuple(w[j : j + 5]) for j in range(len(w) - 4))
        covered = {
            k for j in range(len(w) - 4) if seen[tuple(w[j : j + 5])] > 1 for k in range(j, j + 5)
        }
        full = [x for x in t.split("\n") if x.encode().split()]
        want = (
            len(w), sum(len(x.decode()) for x in w), sum(c in outliers.SYMBOLS for c in t),
            len(full) - len(set(full)), len(covered),
        )
        row = got[i]
        names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
        assert tuple(row[n] for n in names) == want
        assert row["base_failed"] == (len(w) < 10 or 100 * len(covered) > 20 * len(w))
        assert not (row["base_failed"] and row["kept"])


def test_bytes_through_the_table():
    """Every byte has a character of its own, and every id decodes to the bytes of the file."""
    chars = byte_table()
    assert len(set(chars)) == 256 and max(map(ord, chars)) < 0x200
    back = ByteDecoder(RANKS)
    assert all(back.decode([rank]) == token for token, rank in read_ranks(RANKS).items())
    assert back.decode([]) == b"" and back.texts([]) == []


def test_ids_cut_inside_characters(spark):
    own, back = ByteEncoder(RANKS, public_tokenizers.PATTERN), ByteDecoder(RANKS)
    rng = np.random.default_rng(7)
    signs = list("aé ß我中あ😀👍🏽𐍈1\nقلب")
    rows, texts = [], []
    for _ in range(300):
        t = "".join(rng.choice(signs, rng.integers(0, 30)))
        ids = np.frombuffer(own.encode(t), dtype="<u4")
        cuts = np.sort(rng.integers(0, len(ids) + 1, 4))
        rows.append(([p.tobytes() for p in np.split(ids, cuts)],))
        texts.append(t)
        single = back.texts([[i] for i in ids.tolist()])  # one id a part: many end inside a character
        assert "".join(single) == t
    assert any("" in back.texts([[i] for i in np.frombuffer(b"".join(r[0]), "<u4").tolist()]) for r in rows)
    rows += [(None,), ([],), ([None],), ([rows[0][0][0][:0]],)]
    df = spark.createDataFrame(rows, "parts array<binary>").repartition(3)
    want = collections.Counter(texts)
    got = [r for r in bpe.decode_parts(df, RANKS).collect()]
    assert collections.Counter("".join(r["texts"]) for r in got if r["texts"] and len(r["texts"]) == 5) == want
    assert sorted(len(r["texts"]) for r in got if r["texts"] is not None and len(r["texts"]) != 5) == [0, 1, 1]
    assert sum(r["texts"] is None for r in got) == 1
    half = own.encode("😀")[:4]
    assert len(own.encode("😀")) > 4 or back.texts([np.frombuffer(half, "<u4").tolist()]) == ["😀"]
    assert back.texts([[read_ranks(RANKS)["é".encode()[:1]]]]) == ["\ufffd"]
    empty = spark.createDataFrame([], "parts array<binary>")
    assert bpe.decode_parts(empty, RANKS).count() == 0


NAMES = "g long, s0 double, s1 double, s2 double, s3 double"


def test_outliers_resist_a_contaminated_group(spark):
    """A fifth of a group far away shifts neither its location nor the verdicts."""
    rng = np.random.default_rng(2)
    near, far = rng.normal(0, 1, (800, 4)), rng.normal(9, 0.3, (200, 4))
    rows = [(0, *map(float, r)) for r in np.vstack([near, far])]
    df = spark.createDataFrame(rows, NAMES)
    est = outliers.shrunk(outliers.estimates(df), df)
    assert all(abs(est.first()[f"m{i}"]) < 0.3 for i in range(4))
    judged = df.join(est, "g").select("s0", (outliers._distance() / F.col("scale")).alias("d"))
    out = [r for r in judged.collect() if r["d"] > outliers.CUTOFF]
    assert sum(r["s0"] > 5 for r in out) == 200 and len(out) <= 205


def on_grid(x):
    return np.sign(x) * np.floor(np.abs(np.sign(x) * np.log1p(np.abs(x)) * outliers.GRID) + 0.5)


def quantile(x, share):
    return np.sort(on_grid(x), axis=0)[int(np.ceil(share * len(x))) - 1]


def off_grid(cell):
    return np.sign(cell) * np.expm1(np.abs(cell) / outliers.GRID)


def squared(x, at, cov):
    return np.einsum("ij,ij->i", (x - at) @ np.linalg.inv(cov), x - at)


def determinant_estimate(x):
    """Concentration steps in plain numpy."""
    least = np.array(outliers.LEAST)
    at = off_grid(quantile(x, 0.5))
    cov = np.diag(np.maximum((1.4826 * off_grid(quantile(np.abs(x - at), 0.5))) ** 2, least))
    best = np.inf
    while True:
        far = squared(x, at, cov)
        some = x[on_grid(far) <= quantile(far, outliers.SUPPORT)]
        mean = some.mean(0)
        new = (some.T @ some) / len(some) - np.outer(mean, mean)
        np.fill_diagonal(new, np.maximum(new.diagonal(), least))
        if not np.linalg.slogdet(new)[1] < best - outliers.TOLERANCE:
            return at, cov
        at, cov, best = mean, new, np.linalg.slogdet(new)[1]


def distances(groups):
    """Scaled squared distances of each group's rows from its estimate drawn towards the one of all."""
    every = np.vstack(list(groups.values()))
    at0, cov0 = determinant_estimate(every)
    scale0 = off_grid(quantile(squared(every, at0, cov0), 0.5)) / outliers.MIDDLE
    out = {}
    for g, x in groups.items():
        own = len(x) / (len(x) + outliers.PRIOR_ROWS)
        at, cov = determinant_estimate(x)
        far = squared(x, own * at + (1 - own) * at0, own * cov + (1 - own) * cov0)
        scale = own * off_grid(quantile(far, 0.5)) / outliers.MIDDLE + (1 - own) * scale0
        out[g] = far / max(scale, 1.0)
    return out


@pytest.mark.parametrize("few", [outliers.FEW_GROUPS, 0])
def test_estimates_of_small_and_large_groups(spark, monkeypatch, few):
    """Sizes from one row on, groups of one value, of mostly one value, and wide ones; broadcast
    estimates and joined ones."""
    monkeypatch.setattr(outliers, "FEW_GROUPS", few)
    rng = np.random.default_rng(8)
    groups = {}
    for g, (size, spread) in enumerate([(1, 1), (2, 1), (5, 2), (30, 0), (60, 1), (700, 1.5)], 1):
        x = np.abs(rng.normal(2, spread, (size, 4)) + rng.normal(0, 1, 4))
        x[rng.random((size, 4)) < 0.5] = 0.0
        x[: size // 10] += 6
        groups[g] = x
    rows = [(k, *map(float, r)) for g, x in groups.items() for r in x for k in (g, 0)]
    df = spark.createDataFrame(rows, NAMES).repartition(5)
    est = outliers.shrunk(outliers.estimates(df), df)
    got = collections.defaultdict(list)
    for r in df.join(est, "g").select("g", (outliers._distance() / F.col("scale")).alias("d")).collect():
        got[r["g"]].append(r["d"])
    for g, want in distances(groups).items():
        assert np.allclose(sorted(got[g]), sorted(want), rtol=1e-6, atol=1e-9)


def test_op5_verdicts(spark):
    got = by_id(spark, "op5_quality_rules")
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang", "source").collect()
    rows = collections.defaultdict(list)
    for r in docs:
        v = got[r["doc_id"]]
        if not v["base_failed"]:
            n = v["n_words"]
            rate = [100 * v[c] / n for c in ("n_symbols", "n_dup_lines", "n_repeat_words")]
            rows[r["lang"], r["source"]].append((r["doc_id"], np.log1p([v["word_chars"] / n, *rate])))
    want = distances({g: np.array([x for _, x in some]) for g, some in rows.items()})
    for g, some in rows.items():
        for (i, _), far in zip(some, want[g], strict=True):
            assert got[i]["distance"] == pytest.approx(far, rel=1e-6, abs=1e-9)
            assert got[i]["kept"] == (far <= outliers.CUTOFF)


def test_texts_far_out_in_one_statistic(spark, docs):
    """Each of the four statistics alone can reject a text; a group of one is no refuge."""
    rng = np.random.default_rng(6)

    def words(n, size=5):
        return ["".join(rng.choice(list("abcdefghij"), size)) for _ in range(n)]

    def lines(parts):
        return "\n".join(" ".join(parts[j : j + 5]) for j in range(0, len(parts), 5))

    plain = [(i, lines(words(200))) for i in range(300)]
    repeated = words(162)
    odd = {
        1000: lines(words(200, 16)), 1001: lines(words(200)) + " #" * 30,
        1002: lines(words(200)) + "\nxy" * 20, 1003: lines(repeated + repeated[100:119] + words(19)),
    }
    df = docs(*plain, *odd.items())
    apart = docs((2000, odd[1000]), (2001, plain[0][1])).withColumn("source", F.lit("rare"))
    out = outliers.judge(df.union(apart)).select("row.doc_id", "base_failed", "kept").collect()
    assert not any(r["base_failed"] for r in out)
    assert {r["doc_id"] for r in out if not r["kept"]} == {*odd, 2000}


def test_op6(spark, texts):
    got = by_id(spark, "op6_document_fingerprints")
    ids = sorted(texts)
    for n, i in enumerate(ids):
        t, after = texts[i], texts[ids[(n + 1) % len(ids)]]
        half = len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        assert (got[i]["n_chars"], got[i]["edited_sha256"]) == (len(t), sha(edited.encode()))
    prints = collections.defaultdict(set)
    for i, t in texts.items():
        prints[t].add(got[i]["fingerprint"])
    assert all(len(p) == 1 for p in prints.values())
    edited, beside = (sum(r[c] for r in got.values()) for c in ("near_edited", "near_next"))
    assert edited > 10 * beside


def test_fingerprints_of_equal_neighbours(spark, docs):
    text = "some words that are found in several texts here"
    out = imatch.compare_edited(docs((1, text), (2, text), (5, "other things"), (9, text)))
    got = {r["id"]: r for r in out.collect()}
    assert got[1]["near_next"] == 1.0 and got[9]["near_next"] == 1.0 and got[2]["near_next"] < 1.0


def test_op3_and_op2_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    known = {r["doc_id"]: r for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = QUERIES["op3_toxicity"](spark, sf).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    held = [(r["predicted"], known[r["doc_id"]]["toxic"]) for r in rows if r["held_out"] and r["doc_id"] in known]
    assert np.mean([a == b for a, b in held]) >= 0.9
    kept = {r["doc_id"]: r["kept"] for r in QUERIES["op2_quality_classifier"](spark, sf).collect()}
    sound = [kept[i] for i, r in known.items() if r["quality"] == 1]
    poor = [kept[i] for i, r in known.items() if r["quality"] == 0]
    assert np.mean(sound) >= 0.98 and np.mean(poor) <= 0.1
