"""DuckDB SQL for the queries that SQL can express."""

_WS = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_HOST = _LOWER.format("coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), '')")
_CANONICAL = f"""
    regexp_replace(host, '^www[.]|:(80|443)$', '', 'g')
    || regexp_replace(regexp_replace(path, '/index[.][a-z]+$', '/'), '/+$', '')
    || CASE WHEN len(params) > 0 THEN '?' || array_to_string(params, '&') ELSE '' END"""
_SITES = "'cheap-pills', 'casino-win', 'spam-farm', 'adult-x', 'free-bets', 'ads-track'"


def _fits(host: str, path: str) -> str:
    return f"((host = '{host}' OR host LIKE '%.{host}') AND starts_with(path, '{path}'))"


def _fields(n_chars: str) -> str:
    values = ("doc_id", "source", "lang", n_chars, "text")
    return "sha256(" + " || ".join(
        f"coalesce(strlen(({v})::varchar) || ':' || ({v})::varchar, '-')" for v in values
    ) + ")"


# CRC-32 of the text of doc_id, a byte and then a bit at a time.
_CRC = """xor(list_reduce(
    [4294967295::bigint] || list_transform(string_split(doc_id::varchar, ''), lambda c: ord(c)::bigint),
    lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0],
        lambda x, k: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)"""


def _climb(name: str, start: str) -> str:
    """``start`` (rid, tree, i, cur) carried to the root of its tree by the siblings in nodes."""
    return f"""
        {name} AS (
            SELECT rid, tree, 0 AS lvl, i, cur FROM {start}
            UNION ALL
            SELECT c.rid, c.tree, c.lvl + 1, c.i // 2,
                   sha256(CASE WHEN c.i % 2 = 1 THEN s.digest || c.cur ELSE c.cur || coalesce(s.digest, '') END)
            FROM {name} c JOIN heights h ON h.tree = c.tree AND c.lvl < h.height
            LEFT JOIN nodes s ON s.tree = c.tree AND s.lvl = c.lvl AND s.i = xor(c.i, 1))"""


ORACLES: dict[str, str] = {
    "op7_line_dedup": f"""
        WITH lines AS (
            SELECT doc_id, generate_subscripts(parts, 1) AS pos, unnest(parts) AS line
            FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)),
        keyed AS (
            SELECT *, {_LOWER.format(f"trim(line, {_WS})")} AS key FROM lines),
        common AS (
            SELECT key FROM keyed WHERE length(key) >= 1
            GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
        SELECT doc_id, count(*) AS n_lines,
               count(*) FILTER (key IN (SELECT key FROM common)) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos)
                   FILTER (key NOT IN (SELECT key FROM common)), '')) AS kept_sha256
        FROM keyed GROUP BY doc_id""",
    "op9_url_filters": f"""
        WITH parts AS (
            SELECT page_id, url, {_HOST} AS host,
                   coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path,
                   list_sort(list_filter(
                       string_split(coalesce(regexp_extract(url, '^.*?://[^?#]*[?]([^#]*)', 1, 's'), ''), '&'),
                       lambda p: p <> '' AND NOT regexp_matches(
                           p, '^(utm_[a-z]+|ref|fbclid|gclid|sessionid)(=|$)'))) AS params
            FROM pages),
        whole AS (
            SELECT *, {_CANONICAL} AS canonical,
                   CASE WHEN {_fits("example.net", "/en/")} THEN 'example.net/en/'
                        WHEN {_fits("example.com", "/de/")} THEN 'example.com/de/'
                        WHEN {_fits("org", "/fr/")} THEN 'org/fr/'
                        WHEN {_fits("net", "/")} THEN 'net/' END AS rule
            FROM parts),
        listed AS (
            SELECT DISTINCT canonical FROM whole
            WHERE list_has_any(string_split(host, '.'), [{_SITES}]) AND canonical <> '')
        SELECT page_id, host, path, rule,
               CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block'
                    WHEN rule IS NOT NULL THEN 'allow'
                    WHEN canonical IN (SELECT canonical FROM listed) THEN 'block'
                    ELSE 'allow' END AS verdict
        FROM whole""",
    "op13_merkle_manifest": f"""
        WITH RECURSIVE given AS (
            SELECT row_number() OVER () AS rid, doc_id, coalesce('l' || lang, '') AS tree, lang,
                   {_fields("n_chars")} AS leaf,
                   CASE WHEN {_CRC} % 7 = 0 THEN {_fields("n_chars + 1")} ELSE {_fields("n_chars")} END AS start
            FROM documents),
        leaves AS (
            SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rk,
                   count(*) OVER (PARTITION BY tree) AS n
            FROM given),
        low AS (
            SELECT tree, 0 AS lvl, rk AS i, n, leaf AS digest FROM leaves
            UNION ALL
            SELECT tree, lvl + 1, i // 2, (min(n) + 1) // 2, sha256(string_agg(digest, '' ORDER BY i))
            FROM low WHERE n > 1 GROUP BY tree, lvl, i // 2),
        subroots AS (
            SELECT tree, digest, row_number() OVER (ORDER BY encode(tree)) - 1 AS i, count(*) OVER () AS n
            FROM low WHERE n = 1),
        high AS (
            SELECT 0 AS lvl, i, n, digest FROM subroots
            UNION ALL
            SELECT lvl + 1, i // 2, (min(n) + 1) // 2, sha256(string_agg(digest, '' ORDER BY i))
            FROM high WHERE n > 1 GROUP BY lvl, i // 2),
        nodes AS (SELECT tree, lvl, i, digest FROM low UNION ALL SELECT 'top', lvl, i, digest FROM high),
        heights AS (SELECT tree, max(lvl) AS height FROM nodes GROUP BY tree),
        root AS (SELECT digest AS root FROM high WHERE n = 1),
        starts AS (SELECT rid, tree, rk AS i, start AS cur FROM leaves),
        {_climb("climbed", "starts")},
        tops AS (
            SELECT c.rid, 'top' AS tree, s.i, c.cur FROM climbed c JOIN heights h USING (tree)
            JOIN subroots s USING (tree) WHERE c.lvl = h.height),
        {_climb("over", "tops")},
        folded AS (
            SELECT rid, cur FROM over JOIN heights USING (tree) WHERE lvl = height),
        proofs AS (
            SELECT rid, sha256(coalesce(string_agg(s.digest, '' ORDER BY c.tree = 'top', c.lvl), '')) AS proof
            FROM (SELECT * FROM climbed UNION ALL SELECT * FROM over) c
            LEFT JOIN nodes s ON s.tree = c.tree AND s.lvl = c.lvl AND s.i = xor(c.i, 1)
            GROUP BY rid)
        SELECT doc_id, leaf, s.digest AS subroot, root, proof AS proof_sha256, cur AS folded_root,
               cur = root AS verified
        FROM leaves JOIN subroots s USING (tree) CROSS JOIN root JOIN folded USING (rid) JOIN proofs USING (rid)""",
}
