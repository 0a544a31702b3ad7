"""DuckDB counterparts of the queries that SQL can express."""

from __future__ import annotations

_KEYS = (
    "[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"
    "|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]"
)
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

OP1 = f"""
WITH parts AS (
    SELECT page_id, coalesce(url, '') AS url,
           translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1), '{_UPPER}', '{_UPPER.lower()}') AS host,
           regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path
    FROM pages
), rules(rule, verdict, rule_host, rule_path) AS (
    VALUES ('net/', 'block', 'net', '/'), ('example.net/en/', 'allow', 'example.net', '/en/'),
           ('example.com/de/', 'block', 'example.com', '/de/'), ('org/fr/', 'allow', 'org', '/fr/')
), fits AS (
    SELECT url, max_by(rule, length(rule)) AS rule, max_by(verdict, length(rule)) AS verdict
    FROM (SELECT DISTINCT url, host, path FROM parts) JOIN rules
      ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
    GROUP BY url
)
SELECT page_id, host, path, rule,
       coalesce(verdict, CASE
           WHEN regexp_matches(lower(url), '(?s)^[^/?#]*://([^/?#]*[.])?(casino-win|cheap-pills|free-bets|adult-x|spam-farm)[.]')
             OR regexp_matches(lower(url), '(?s)/tracker/')
             OR regexp_matches(lower(url), '(?s)([^a-z0-9_.%-]|$)popunder([^a-z0-9_.%-]|$)') THEN 'block'
           ELSE 'allow' END) AS verdict
FROM parts LEFT JOIN fits USING (url)
"""


def _spans(kind: str, rank: int, regex: str, group: int, least: int) -> str:
    return f"""
    SELECT doc_id, text, '{kind}' AS kind, {rank} AS rank,
           [length(x) FOR x IN string_split_regex(text, '{regex}')] AS gaps,
           [length(x) FOR x IN regexp_extract_all(text, '{regex}', 0)] AS sizes,
           [length(x) >= {least} FOR x IN regexp_extract_all(text, '{regex}', {group})] AS good
    FROM docs WHERE regexp_matches(text, '{regex}')"""


_RULES = [
    ("assign", f"({_KEYS})[\"'']?\\x20*[:=]\\x20*[\"'']?([A-Za-z0-9+/_.=-]+)", 2, 6),
    ("access", "AKIA[A-Z0-9]{16,}", 0, 1),
    ("hex", "[0-9a-f]{24,}", 0, 1),
    ("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1),
    ("github", "gh[pousr]_[A-Za-z0-9]{36,}", 0, 1),
    ("slack", "xox[abprs]-[A-Za-z0-9-]{15,}", 0, 1),
    ("jwt", "eyJ[A-Za-z0-9_-]+[.]eyJ[A-Za-z0-9_-]+[.][A-Za-z0-9_-]+", 0, 1),
]
OP2 = f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
hits AS ({" UNION ALL ".join(_spans(k, n, r, g, m) for n, (k, r, g, m) in enumerate(_RULES))}),
places AS (
    SELECT doc_id, kind, rank, sizes, good, gaps, unnest(generate_series(1, len(sizes))) AS i FROM hits
), spans AS (
    SELECT doc_id, kind, rank, good[i] AS good,
           (list_sum(gaps[1:i]) + coalesce(list_sum(sizes[1:i - 1]), 0))::BIGINT AS start,
           (list_sum(gaps[1:i]) + list_sum(sizes[1:i]))::BIGINT AS stop
    FROM places
), joined AS (
    SELECT doc_id,
           count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
           count(*) FILTER (kind = 'hex') AS n_hex,
           string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) FILTER (rank < 3) AS base,
           string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) AS spans
    FROM spans WHERE good GROUP BY doc_id
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN joined USING (doc_id)
"""

OP4 = """
WITH hashed AS (
    SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, upper(sha1(coalesce(html, ''))) AS hex
    FROM pages
), kept AS (SELECT hex, max(page_id) AS kept FROM hashed GROUP BY hex)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes,
       array_to_string([
           substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                  1 + (('0x' || substr(hex, 5 * (i // 4) + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) % 32, 1)
           FOR i IN generate_series(0, 31)
       ], '') AS payload_digest,
       CASE WHEN page_id = kept THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> kept THEN kept END AS refers_to
FROM hashed JOIN kept USING (hex)
"""

OP6 = """
WITH codes AS (SELECT vec_id, [x > 0 FOR x IN embedding] AS bits FROM embeddings),
met AS (
    SELECT q.vec_id AS query_id, c.vec_id,
           len([p FOR p IN list_zip(q.bits, c.bits) IF p[1] <> p[2]])::INTEGER AS distance
    FROM codes q JOIN codes c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id)::INTEGER AS rank FROM met
)
SELECT query_id, rank, vec_id, distance FROM ranked WHERE rank <= 10
"""

OP9 = f"""
WITH lines AS (
    SELECT doc_id, place, unnest(generate_series(1, len(parts))) AS i, unnest(parts) AS line
    FROM (SELECT doc_id, row_number() OVER () AS place, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)
), keyed AS (
    SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                        '{_UPPER}', '{_UPPER.lower()}') AS key
    FROM lines
), repeated AS (
    SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 40
    GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), judged AS (
    SELECT doc_id, place, i, line, keeper IS NOT NULL AND keeper <> doc_id AS dropped
    FROM keyed LEFT JOIN repeated USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY doc_id, place
"""

OP11 = f"""
WITH pieces AS (
    SELECT lang, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS w
    FROM (SELECT coalesce(lang, 'und') AS lang,
                 unnest(string_split_regex(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'),
                                           '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents)
), totals AS (SELECT lang, sum(len(w)) AS n FROM pieces GROUP BY lang),
counts AS (
    SELECT lang, size, phrase, count(*) AS f
    FROM (SELECT lang, size, unnest([array_to_string(w[i:i + size - 1], ' ') FOR i IN range(1, len(w) - size + 2)]) AS phrase
          FROM pieces, range(1, 6) AS sizes(size))
    GROUP BY ALL HAVING count(*) >= 100
), cuts AS (
    SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w, unnest(range(1, size)) AS k
    FROM counts WHERE size > 1
), scored AS (
    SELECT c.lang, c.size, c.phrase, c.a, c.k, x.f AS l, y.f AS r, t.n,
           ((1000::HUGEINT * c.a * t.n) // (x.f::HUGEINT * y.f))::BIGINT AS score
    FROM cuts c JOIN totals t USING (lang)
    JOIN counts x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[:c.k], ' ')
    JOIN counts y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.k + 1:], ' ')
), lowest AS (
    SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), inner_phrases AS (
    SELECT lang, unnest([array_to_string(w[i:i + m - 1], ' ') FOR i IN range(1, size - m + 2)]) AS phrase, f
    FROM (SELECT lang, size, f, string_split(phrase, ' ') AS w FROM counts WHERE size > 2), range(2, 5) AS parts(m)
    WHERE m < size
), covered AS (SELECT lang, phrase, max(f) AS longest FROM inner_phrases GROUP BY ALL),
ranked AS (
    SELECT lang, phrase, a, l, r, n, score,
           row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
    FROM lowest LEFT JOIN covered USING (lang, phrase) WHERE longest IS NULL OR longest < a
)
SELECT lang, rank, phrase, a, l, r, n::BIGINT AS n, score FROM ranked WHERE rank <= 2000
"""


def _entry(value: str) -> str:
    return f"coalesce(octet_length(encode({value}::VARCHAR)) || ':' || {value}, '-')"


def _levels(name: str, count: int) -> str:
    """Tables {name}0 to {name}{count}: the nodes of each level with their siblings; {name}0 must come first."""
    parts = []
    for k in range(count):
        parts.append(f"""
{name}_runs{k} AS MATERIALIZED (
    SELECT tree, i, h, count(*) OVER (PARTITION BY tree) AS c,
           coalesce(lag(h, 2) OVER run, '') || coalesce(lag(h, 1) OVER run, '') AS before,
           coalesce(lead(h, 1) OVER run, '') || coalesce(lead(h, 2) OVER run, '') AS after
    FROM {name}{k} WINDOW run AS (PARTITION BY tree, i // 3 ORDER BY i)
), {name}{k + 1} AS MATERIALIZED (
    SELECT tree, i // 3 AS i,
           CASE WHEN any_value(c) = 1 THEN any_value(h) ELSE sha256(string_agg(h, '' ORDER BY i)) END AS h
    FROM {name}_runs{k} GROUP BY tree, i // 3
)""")
    return ",".join(parts)


def _climb(name: str, first: str, count: int) -> str:
    """Tables climbing from ``first`` (tree, i, f, proof and more) to the root of {name}."""
    parts = []
    for k in range(count):
        parts.append(f"""
{name}_up{k} AS MATERIALIZED (
    SELECT x.* REPLACE (CASE WHEN c = 1 THEN f ELSE sha256(before || f || after) END AS f,
                        proof || before || after AS proof)
    FROM {first if k == 0 else f"{name}_up{k - 1}"} x JOIN {name}_runs{k} r ON x.tree = r.tree AND x.i // {3**k} = r.i
)""")
    return ",".join(parts)


_STEP = "xor(x >> 1, 3988292384 * (x & 1))"  # fixed value: the polynomial of CRC-32, reversed
_CRC = f"""xor(4294967295, list_reduce(
    [4294967295::BIGINT] || [unicode(c)::BIGINT FOR c IN string_split(doc_id::VARCHAR, '')],
    lambda a, b: list_reduce([xor(a, b)] || [0::BIGINT FOR _ IN range(8)], lambda x, y: {_STEP})))"""
_TREE_LEVELS, _TOP_LEVELS = 12, 8  # 531,441 rows of a source and 6,561 sources

OP12 = f"""
WITH rows AS MATERIALIZED (
    SELECT doc_id, coalesce('=' || source, '-') AS tree, {" || ".join(_entry(c) for c in ("doc_id", "source", "lang", "n_chars"))} AS head,
           {_entry("text")} AS body,
           {_entry("replace(text, chr(10), '')")} AS cut, {_CRC} % 2 = 0 AS tampered
    FROM documents
), leaves AS MATERIALIZED (
    SELECT doc_id, tree, sha256(head || body) AS leaf,
           sha256(head || CASE WHEN tampered THEN cut ELSE body END) AS claimed
    FROM rows
), numbered AS MATERIALIZED (
    SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM leaves
), t0 AS (SELECT tree, i, leaf AS h FROM numbered),{_levels("t", _TREE_LEVELS)},
s0 AS MATERIALIZED (SELECT 'top' AS tree, row_number() OVER (ORDER BY tree) - 1 AS i, h, tree AS name FROM t{_TREE_LEVELS}),{_levels("s", _TOP_LEVELS)},
start AS (SELECT doc_id, tree, i, leaf, claimed AS f, '' AS proof FROM numbered),{_climb("t", "start", _TREE_LEVELS)},
middle AS (
    SELECT doc_id, 'top' AS tree, s0.i, leaf, s0.h AS subroot, f, proof
    FROM t_up{_TREE_LEVELS - 1} u JOIN s0 ON s0.name = u.tree
),{_climb("s", "middle", _TOP_LEVELS)}
SELECT doc_id, leaf, subroot, s{_TOP_LEVELS}.h AS root, sha256(proof) AS proof_sha256, f AS folded_root,
       f = s{_TOP_LEVELS}.h AS verified
FROM s_up{_TOP_LEVELS - 1}, s{_TOP_LEVELS}
"""

ORACLE = {
    "op1_url_filter": OP1,
    "op2_secret_scan": OP2,
    "op4_warc_convert": OP4,
    "op6_hamming_search": OP6,
    "op9_line_dedup": OP9,
    "op11_phrase_collocations": OP11,
    "op12_merkle_manifest": OP12,
}
