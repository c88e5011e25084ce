"""Each stage's rows against plain Python, on what the stage before kept of the smallest table."""

import collections

import public_tokenizers
from test_brute_force import groups, removed
from tokenizers import Tokenizer

import corpus_pipeline
from shopgrain.llm import simhash

SF = "/root/testdata/sf0.001"


def without_common_lines(docs):
    def key(line):
        return line.strip(" \t\n\x0b\x0c\r").encode().lower()

    seen = collections.Counter()
    for text in docs.values():
        seen.update({key(x) for x in text.split("\n")} - {b""})
    return {
        i: "\n".join(x for x in t.split("\n") if seen[key(x)] < 10) for i, t in docs.items()
    }


def one_of_each_group(docs):
    prints = {i: simhash.shingle_fingerprint(t, 3, 42) & (1 << 64) - 1 for i, t in docs.items()}
    found = groups(prints)
    return {i: t for i, t in docs.items() if found[i] == i}


def without_passages(docs):
    return {
        i: kept.decode() if gone else docs[i] for i, (_, gone, kept) in removed(docs, 35).items()
    }


def test_stages_in_order(spark, tmp_path):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    columns, texts = df.columns, {r["doc_id"]: r["text"] for r in df.collect()}
    brute = {
        "line_dedup": without_common_lines, "simhash_near_dedup": one_of_each_group,
        "substring_dedup": without_passages,
    }
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, df, SF).write.parquet(f"{tmp_path}/{name}")
        df = spark.read.parquet(f"{tmp_path}/{name}")
        assert df.columns == columns
        got = {r["doc_id"]: r["text"] for r in df.collect()}
        assert {r["doc_id"]: r["n_chars"] for r in df.collect()} == {i: len(t) for i, t in got.items()}
        if name in brute:
            assert got == brute[name](texts), name
        else:
            assert all(texts[i] == t for i, t in got.items()) and 0 < len(got) < len(texts)
        texts = got
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    packed = corpus_pipeline.STAGES[-1][1](spark, df, SF).collect()
    lengths = collections.Counter()
    for r in packed:
        lengths[r["doc_id"]] += r["length"]
    assert lengths == {
        i: len(library.encode(t, add_special_tokens=False).ids) + 1 for i, t in texts.items()
    }
    whole = corpus_pipeline.run(spark, SF).collect()
    same = ("doc_id", "piece", "start", "length", "ids_crc32")
    assert sorted(tuple(r[c] for c in same) for r in whole) == sorted(
        tuple(r[c] for c in same) for r in packed
    )
