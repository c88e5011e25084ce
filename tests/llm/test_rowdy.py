"""Every operator takes nulls, empty and long texts, repeats, clashing names and empty tables."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from shopgrain.llm import bpe, imatch, lines, outliers, packing, quality, simhash, substrings, toxicity, urls

WORDS = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def labels(spark):
    return spark.sql("""SELECT * FROM VALUES (1L, 1, 0), (3L, 0, 1), (3L, 0, 1), (5L, 1, NULL), (6L, 1, 0),
        (NULL, 1, 1), (99L, 0, 0) AS t(doc_id, quality, toxic)""")


def rated(spark):
    return labels(spark).select(F.col("doc_id").alias("id"), F.col("toxic").alias("label"))


OPERATORS = {
    "lines": lambda s, d: lines.drop_common_lines(d),
    "substrings": lambda s, d: substrings.drop_repeated_passages(d),
    "simhash": lambda s, d: simhash.near_duplicates(simhash.fingerprints(d)),
    "packing": lambda s, d: packing.pack_documents(d, WORDS),
    "quality": lambda s, d: quality.select_quality(d, labels(s)),
    "toxicity": lambda s, d: toxicity.score(d, toxicity.train(d, rated(s))),
    "bpe": lambda s, d: bpe.decode(
        bpe.encode(d, RANKS, public_tokenizers.PATTERN, offsets=True).select("ids"), RANKS
    ),
    "outliers": lambda s, d: outliers.judge(d),
    "imatch": lambda s, d: imatch.compare_edited(d),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_rowdy_rows(spark, rowdy, name):
    got = OPERATORS[name](spark, rowdy).collect()
    assert len(got) >= rowdy.count()
    if name not in ("packing",):
        assert len(got) == rowdy.count()


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, rowdy, name):
    assert OPERATORS[name](spark, rowdy.limit(0)).collect() == []


def test_urls(spark):
    pages = spark.sql("""SELECT * FROM VALUES (1, NULL), (2, ''), (3, 'no scheme'), (4, 'http://A.net'),
        (4, 'http://A.net'), (5, 'http://x.org/fr/1?b=2&a=1#z'), (6, 'HTTPS://www.Bad.test:443/p/index.html')
        AS t(page_id, url)""").withColumns({c: F.lit(1) for c in ("row", "host", "hit", "block", "by")})
    listed = spark.sql("SELECT 'bad.test/p' AS canonical UNION ALL SELECT NULL UNION ALL SELECT ''")
    rules = [urls.Rule("net", "/", "block"), urls.Rule("org", "/fr/", "allow")]
    got = urls.judge(pages, listed, rules)
    found = {(r["row"]["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in got.collect()}
    assert found == {
        (1, "", "", None, "allow"), (2, "", "", None, "allow"), (3, "", "", None, "allow"),
        (4, "a.net", "", None, "allow"), (5, "x.org", "/fr/1", "org/fr/", "allow"),
        (6, "www.bad.test:443", "/p/index.html", None, "block"),
    }
    assert got.count() == 7
    assert urls.judge(pages.limit(0), listed, rules).collect() == []
    few = urls.judge(pages, listed, rules, blocks=1)  # a full filter passes all, the join decides
    assert {(r["row"]["page_id"], r["verdict"]) for r in few.collect()} == {(f[0], f[4]) for f in found}


def test_stages_keep_the_columns(spark, rowdy, tmp_path):
    labels(spark).write.parquet(f"{tmp_path}/labels.parquet")
    before = rowdy
    for name, stage in corpus_pipeline.STAGES[:-1]:
        for given in (rowdy, rowdy.limit(0)):
            out = stage(spark, given, str(tmp_path))
            assert out.columns == before.columns, name
            kept = out.count()
            assert kept <= given.count()
    last = corpus_pipeline.STAGES[-1][1](spark, rowdy, str(tmp_path))
    assert last.count() >= rowdy.count() and "sequence_id" in last.columns
