"""DuckDB SQL for the operators that SQL can express over whole tables."""

OP1 = r"""
WITH parts AS (
    SELECT page_id,
           coalesce(CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END, '') AS rest
    FROM pages
), judged AS (
    SELECT page_id,
           translate(regexp_extract(rest, '^([^/?#]*)([^?#]*)', 1),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(rest, '^([^/?#]*)([^?#]*)', 2) AS path
    FROM parts
), fitted AS (
    SELECT page_id, host, path,
           CASE
             WHEN (host = 'example.net' OR host LIKE '%.example.net') AND path LIKE '/en/%' THEN 'example.net/en/'
             WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/de/%' THEN 'example.com/de/'
             WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/fr/%' THEN 'org/fr/'
             WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/%' THEN 'net/'
           END AS rule
    FROM judged
)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict
FROM fitted
"""

OP7 = r"""
WITH texts AS (
    SELECT doc_id, coalesce(text, '') AS whole,
           regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS normal
    FROM documents
)
SELECT doc_id,
       first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY normal) AS group_size,
       row_number() OVER w = 1 AS kept,
       sha256(normal) AS text_sha256
FROM texts
WINDOW w AS (PARTITION BY normal ORDER BY length(whole) DESC, doc_id)
"""

_WEIGHTS = """
weights(depth, domain, lang, source, weight) AS (VALUES
    (1, 'web', NULL, NULL, 40), (1, 'books', NULL, NULL, 30), (1, 'code', NULL, NULL, 20), (1, 'news', NULL, NULL, 10),
    (2, 'web', 'en', NULL, 50), (2, 'web', 'de', NULL, 20), (2, 'books', 'en', NULL, 40))
"""


def _level(name: str, keys: str, parent: str, last: str) -> str:
    """CTEs that give each node below ``parent`` its share of the parent's budget."""
    by = f"PARTITION BY {parent}" if parent else ""
    up = f"JOIN {name[:-1]}{int(name[-1]) - 1} USING ({parent})" if parent else "CROSS JOIN (SELECT sum(tokens) // 2 AS share FROM leaves)"
    return f"""
{name}_in AS (
    SELECT {keys}, share AS budget, own.cap, own.weight, own.tokens FROM
      (SELECT {keys}, sum(tokens) * 4 AS cap, sum(tokens) AS tokens, max(w{name[-1]}) AS weight FROM leaves GROUP BY {keys}) own {up}
), {name}_full AS (
    SELECT *, cap::HUGEINT * sum(weight) OVER back <= weight::HUGEINT * (budget - (sum(cap) OVER fore - cap)) AS filled
    FROM {name}_in
    WINDOW fore AS ({by} ORDER BY cap / weight, {last} ROWS UNBOUNDED PRECEDING),
           back AS ({by} ORDER BY cap / weight, {last} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
), {name}_open AS (
    SELECT *, budget - coalesce(sum(cap) FILTER (filled) OVER (PARTITION BY {parent or 1}), 0) AS rest,
           sum(weight) FILTER (NOT filled) OVER (PARTITION BY {parent or 1}) AS open_weight,
           coalesce(sum(weight) FILTER (NOT filled) OVER ({by} ORDER BY cap / weight, {last} ROWS UNBOUNDED PRECEDING), 0) AS upto
    FROM {name}_full
), {name} AS (
    SELECT {keys}, tokens, CASE WHEN filled THEN cap
        ELSE (upto::HUGEINT * rest) // open_weight - ((upto - weight)::HUGEINT * rest) // open_weight END AS share
    FROM {name}_open
)"""


OP4 = f"""
WITH {_WEIGHTS}, sized AS (
    SELECT doc_id, coalesce(lang, '(none)') AS lang, coalesce(source, '(none)') AS source,
           ['web', 'books', 'code', 'news'][coalesce(try_cast(regexp_extract(source, '([0-9]{{1,9}})$', 1) AS INT), 0) % 4 + 1] AS domain,
           len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS n_tokens
    FROM documents
), leaves AS (
    SELECT s.domain, s.lang, s.source, s.tokens, coalesce(a.weight, 10) AS w1, coalesce(b.weight, 10) AS w2, 10 AS w3
    FROM (SELECT domain, lang, source, sum(n_tokens) AS tokens FROM sized WHERE n_tokens > 0 GROUP BY ALL) s
    LEFT JOIN weights a ON a.depth = 1 AND a.domain = s.domain
    LEFT JOIN weights b ON b.depth = 2 AND b.domain = s.domain AND b.lang = s.lang
), {_level("node1", "domain", "", "domain")}, {_level("node2", "domain, lang", "domain", "lang")},
{_level("node3", "domain, lang, source", "domain, lang", "source")},
used AS (
    SELECT s.*, share // tokens AS whole, share % tokens AS due FROM sized s JOIN node3 USING (domain, lang, source) WHERE n_tokens > 0
), ordered AS (
    SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source
        ORDER BY md5('20240601:' || (whole + 1) || ':' || doc_id), doc_id ROWS UNBOUNDED PRECEDING) - n_tokens AS before
    FROM used
)
SELECT doc_id, domain, lang, source, n_tokens::BIGINT AS n_tokens, epoch::BIGINT AS epoch, n_tokens::BIGINT AS take_tokens
FROM (SELECT *, unnest(range(1, whole::BIGINT + 1)) AS epoch FROM used)
UNION ALL
SELECT doc_id, domain, lang, source, n_tokens::BIGINT, (whole + 1)::BIGINT, least(n_tokens, due - before)::BIGINT
FROM ordered WHERE before < due
"""

# crc32 of the decimal id, bit by bit (reversed polynomial 0xEDB88320).
_CRC32 = """xor(4294967295, list_reduce(
    list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)),
    lambda a, b: list_reduce(range(8), lambda y, i: CASE WHEN y & 1 = 1 THEN xor(y >> 1, 3988292384) ELSE y >> 1 END, xor(a, b)),
    4294967295))"""

OP11 = f"""
WITH own AS (
    SELECT conv_id, sha256(coalesce(role, '') || chr(31) || coalesce(text, '')) AS turn_hash, length(coalesce(text, '')) AS chars,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS pos
    FROM conversations WHERE conv_id IS NOT NULL
), sizes AS (
    SELECT conv_id, count(*) AS n, {_CRC32} % 6 AS h FROM own GROUP BY conv_id
), convs AS (
    SELECT s.conv_id, s.n, s.h, s.conv_id - s.conv_id % 100 AS base, least(s.h, coalesce(b.n, 0)) AS shared
    FROM sizes s LEFT JOIN sizes b ON b.conv_id = s.conv_id - s.conv_id % 100
), rebuilt AS (
    SELECT c.conv_id, o.pos, turn_hash, chars FROM convs c JOIN own o ON o.conv_id = c.base AND o.pos < c.h
    UNION ALL
    SELECT c.conv_id, o.pos - c.h + c.shared, turn_hash, chars FROM convs c JOIN own o ON o.conv_id = c.conv_id AND o.pos >= c.h
), lists AS (
    SELECT conv_id, list(turn_hash ORDER BY pos) AS turns, list(chars ORDER BY pos) AS chars FROM rebuilt GROUP BY conv_id
), whole AS (
    SELECT conv_id, coalesce(turns, []) AS turns, coalesce(chars, []) AS chars FROM convs LEFT JOIN lists USING (conv_id)
), prefixes AS (
    SELECT conv_id, depth, turns[1:depth] AS node, turns[1:depth - 1] AS parent, depth = len(turns) AS ends,
           CASE WHEN depth > 0 THEN chars[depth] ELSE 0 END AS last_chars
    FROM (SELECT *, unnest(range(len(turns) + 1)) AS depth FROM whole)
), nodes AS (
    SELECT depth, node, any_value(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs,
           (count(*) - 1) * any_value(last_chars) AS saved,
           sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
    FROM prefixes GROUP BY depth, node
), children AS (
    SELECT depth - 1 AS depth, parent AS node, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY depth, parent
), told AS (
    SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN children USING (depth, node)
), below AS (
    SELECT above AS depth, node[1:above] AS node, sum(saved) AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves
    FROM (SELECT *, unnest(range(depth + 1)) AS above FROM told) GROUP BY 1, 2
)
SELECT t.conv_id, t.depth, p.conv_id AS parent_conv_id, t.n_convs, t.n_children, b.n_leaves,
       CAST(b.saved_tokens AS BIGINT) AS saved_tokens, t.ends_sha256
FROM told t JOIN below b ON t.depth = b.depth AND t.node = b.node
     LEFT JOIN told p ON t.depth > 0 AND p.depth = t.depth - 1 AND p.node = t.parent
"""


def _assigned(r: int) -> str:
    """CTE: the nearest entry of round ``r``'s codebooks to every part."""
    return f"""
a{r} AS MATERIALIZED (
    SELECT rid, part, min_by(entry, d * 256 + entry) AS entry, min(d) AS d FROM (
        SELECT p.rid, p.part, b.entry, sum((p.x - b.x) * (p.x - b.x)) AS d
        FROM points p JOIN b{r} b USING (part, pos) GROUP BY ALL
    ) GROUP BY rid, part
)"""


def _moved(r: int) -> str:
    """CTE: the codebooks after round ``r``."""
    return f"""
b{r + 1} AS MATERIALIZED (
    SELECT part, entry, pos, coalesce(m.x, b.x) AS x FROM b{r} b LEFT JOIN (
        SELECT p.part, a.entry, p.pos, CAST(floor(sum(p.x) / count(*)) AS BIGINT) AS x
        FROM points p JOIN a{r} a USING (rid, part) GROUP BY ALL
    ) m USING (part, entry, pos)
)"""


OP13 = f"""
WITH kept AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY vec_id) AS rid, vec_id, label,
           list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), points AS MATERIALIZED (
    SELECT rid, (i - 1) // (len(v) // 8) AS part, (i - 1) % (len(v) // 8) AS pos, v[i] AS x
    FROM (SELECT rid, v, unnest(range(1, len(v) + 1)) AS i FROM kept)
), b0 AS MATERIALIZED (
    SELECT part, rid - 1 AS entry, pos, x FROM points WHERE rid <= 16
), {", ".join(step(r) for r in range(6) for step in (_assigned, _moved))}, {_assigned(6)}
, codes AS (
    SELECT rid, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM a6 GROUP BY rid
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY part, entry, pos)) FROM b6) AS codebooks_sha256
FROM kept JOIN codes USING (rid)
"""

ORACLES = {
    "op1_url_filter": OP1,
    "op4_mixing": OP4,
    "op7_exact_dedup": OP7,
    "op11_prefix_trie": OP11,
    "op13_vector_codes": OP13,
}
