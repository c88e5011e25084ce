"""URL filters: host rules, and a list of URLs behind a blocked Bloom filter and an exact join."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from shopgrain.llm.common import UPPER, LOWER, store

WORDS = 8  # 64-bit words of a block; a URL sets one bit in each
BLOCKS = 1 << 14  # blocks of the filter, 64 bytes each; fixed, so its broadcast is bounded
# Query parameters that do not select content, and file names that stand for their folder.
IDLE_PARAMETERS = r"^(utm_[a-z]+|ref|fbclid|gclid|sessionid)(=|$)"
INDEX_PAGE = r"/index\.[a-z]+$"


@dataclass(frozen=True)
class Rule:
    """``verdict`` for a host, its subdomains, and paths that start with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


def url_host(url: Column) -> Column:
    """After the first ``://`` up to / ? # or the end, A-Z lower-cased; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def url_path(url: Column) -> Column:
    """After the host up to ? # or the end; empty where there is no host."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def url_query(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^?#]*\?([^#]*)", 1), F.lit(""))


def canonical_url(url: Column) -> Column:
    """Host without www. and default port, path without index page and last slash, the query's
    parameters in order without those that select nothing; no scheme, no fragment."""
    host = F.regexp_replace(url_host(url), r"^www\.|:(80|443)$", "")
    path = F.regexp_replace(F.regexp_replace(url_path(url), INDEX_PAGE, "/"), "/+$", "")
    kept = F.array_sort(F.filter(
        F.split(url_query(url), "&"), lambda p: (p != "") & ~F.rlike(p, F.lit(IDLE_PARAMETERS))
    ))
    query = F.array_join(kept, "&")
    return F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))


def longest_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """(rule, verdict) of the longest fitting rule, else null. The list is short and given."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: len(r.name)):
        fits = ((host == rule.host) | F.endswith(host, F.lit("." + rule.host))) & F.startswith(
            path, F.lit(rule.path)
        )
        named = F.struct(F.lit(rule.name).alias("rule"), F.lit(rule.verdict).alias("verdict"))
        found = F.when(fits, named).otherwise(found)
    return found


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")


def _masks(key: Column) -> list[Column]:
    """One bit for each word, named by six bits of a second hash."""
    mixed = F.xxhash64(F.lit(7), key)
    return [_bit(mixed, i) for i in range(WORDS)]


def _bit(mixed: Column, i: int) -> Column:
    six = F.shiftrightunsigned(mixed, 6 * i).bitwiseAND(F.lit(63)).cast("int")
    return F.call_function("shiftleft", F.lit(1).cast("long"), six)


def bloom_filter(keys: DataFrame, key: str, blocks: int = BLOCKS) -> DataFrame:
    """(block, w0..w7): the bits of all keys; at most ``blocks`` rows whatever the list's length."""
    return keys.groupBy(_block(F.col(key), blocks).alias("block")).agg(
        *[F.bit_or(mask).alias(f"w{i}") for i, mask in enumerate(_masks(F.col(key)))]
    )


def listed(
    df: DataFrame, keys: DataFrame, col: str, blocks: int = BLOCKS
) -> DataFrame:
    """The distinct values of ``df[col]`` that are in ``keys[col]``.

    The filter is broadcast: at most ``blocks`` rows of nine numbers. Values it refuses are not in
    the list; only the others are shuffled, reduced to distinct values, and joined with the list by
    equality, which removes false positives. A longer list passes more values to the exact join and
    changes nothing else. Nulls are never listed.
    """
    keys = keys.select(col).where(F.col(col).isNotNull()).distinct()
    bits = F.broadcast(bloom_filter(keys, col, blocks))
    hit = F.lit(True)
    for i, mask in enumerate(_masks(F.col(col))):
        hit = hit & (F.col(f"w{i}").bitwiseAND(mask) != 0)
    possible = (
        df.select(col, _block(F.col(col), blocks).alias("block"))
        .join(bits, "block").where(hit).select(col).distinct()
    )
    return possible.join(keys, col, "left_semi")


def judge(
    pages: DataFrame, block_list: DataFrame, rules: list[Rule], url_col: str = "url",
    blocks: int = BLOCKS,
) -> DataFrame:
    """``row`` (the input's columns), ``host``, ``path``, ``canonical``, ``rule``, ``verdict``.

    The longest rule decides; without one, a page is blocked if its canonical URL is in
    ``block_list`` (canonical). Null URLs and those without ``://`` have an empty host and path and
    an empty canonical form, which no list holds. Repeated rows and URLs each get their verdict.
    """
    url = F.col(url_col)
    host, path = url_host(url), url_path(url)
    judged = pages.select(
        F.struct("*").alias("row"), host.alias("host"), path.alias("path"),
        canonical_url(url).alias("canonical"), longest_rule(host, path, rules).alias("by"),
    )
    block_list = block_list.where(F.col("canonical") != "")
    hits = store(
        listed(judged.where("by IS NULL"), block_list, "canonical", blocks), "listed-urls"
    ).withColumn("hit", F.lit(True))
    return judged.join(hits, "canonical", "left").select(
        "row", "host", "path", "canonical", F.col("by.rule").alias("rule"),
        F.coalesce("by.verdict", F.when(F.col("hit"), "block").otherwise("allow")).alias("verdict"),
    )
