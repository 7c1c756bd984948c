"""DuckDB statements for the queries that SQL can express, written from their definitions."""

_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

URLS = f"""
WITH cut AS (
  SELECT page_id, row_number() OVER () AS n,
         CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT page_id, n, translate(regexp_extract(rest, '^[^/?#]*'), {_LOWER}) AS host,
         regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path FROM cut),
rules(h, p, v) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
                          ('com', '/fr/', 'allow'), ('com', '/de/', 'block'))
SELECT page_id, any_value(host) AS host, any_value(path) AS path, arg_max(h || p, length(h || p)) AS rule,
       coalesce(arg_max(v, length(h || p)), 'allow') AS verdict
FROM parts LEFT JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
GROUP BY n, page_id
"""

LINES = f"""
WITH lines AS (
  SELECT doc_id, pos, l, translate(trim(l, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), {_LOWER}) AS k
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS l,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents)),
common AS (SELECT k, max(doc_id) AS last FROM lines WHERE length(k) >= 40
           GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
marked AS (SELECT doc_id, pos, l, coalesce(doc_id <> last, FALSE) AS gone FROM lines LEFT JOIN common USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(l, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

RULES = """
WITH words AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws
  FROM documents),
windows AS (SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g
            FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM words)),
again AS (SELECT doc_id, g FROM windows GROUP BY ALL HAVING count(*) > 1),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM windows JOIN again USING (doc_id, g), range(3) r(k)
            GROUP BY doc_id),
lines AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT l) AS n_dup_lines
          FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS l FROM words)
          WHERE regexp_matches(l, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id),
base AS (
  SELECT doc_id, len(ws) AS n_words, length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g')) AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines,
         length(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_upper
  FROM words LEFT JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id)),
judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM base)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > n_words OR 10 * n_dup_lines > 3 * n_lines
            OR 10 * n_upper > 3 * word_chars OR word_chars < 2 * n_words OR word_chars > 14 * n_words) AS kept
FROM judged
"""

# budgets as a water level: the budget of a node is min(capacity, weight x level), found among the siblings
_LEVEL = """
{name}_n AS (SELECT {path}, any_value(room) AS room, sum(cap) AS cap, any_value({weight}) AS w
             FROM (SELECT l.*, {room} AS room FROM leaves l {up}) GROUP BY ALL),
{name}_s AS (SELECT *, 
             coalesce(sum(cap) OVER ({part} ORDER BY cap / w, {last} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
                      0) AS c0,
             sum(w) OVER ({part} ORDER BY cap / w, {last} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS w0
             FROM {name}_n),
{name}_f AS (SELECT *, cap * w0 <= w * (room - c0) AS full_node FROM {name}_s),
{name} AS (SELECT {path}, CASE WHEN full_node THEN cap ELSE (w * (room - coalesce(sum(cap) FILTER (WHERE full_node)
             OVER ({part}), 0))) // sum(w) FILTER (WHERE NOT full_node) OVER ({part}) END AS budget FROM {name}_f)
"""

MIX = """
WITH docs AS (
  SELECT doc_id, lang, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS n_tokens,
         CASE WHEN regexp_matches(source, '[0-9]$')
              THEN 'd' || (CAST(regexp_extract(source, '([0-9]{1,9})$', 1) AS BIGINT) % 4) ELSE 'dx' END AS domain
  FROM documents),
leaves AS (SELECT domain, lang, source, sum(n_tokens)::BIGINT AS supply, (2 * sum(n_tokens))::BIGINT AS cap
           FROM docs GROUP BY ALL),
all_tokens AS (SELECT least(CAST(floor(sum(supply) * 0.6::DOUBLE) AS BIGINT), sum(cap)) AS room FROM leaves),
""" + _LEVEL.format(name="b1", path="domain", last="domain", part="", room="t.room", up=", all_tokens t",
                    weight="CASE domain WHEN 'd0' THEN 4 WHEN 'd1' THEN 3 WHEN 'd2' THEN 2 ELSE 1 END") + "," + \
    _LEVEL.format(name="b2", path="domain, lang", last="lang", part="PARTITION BY domain", room="u.budget",
                  up="JOIN b1 u ON u.domain IS NOT DISTINCT FROM l.domain",
                  weight="CASE lang WHEN 'en' THEN 6 WHEN 'de' THEN 2 WHEN 'fr' THEN 2 ELSE 1 END") + "," + \
    _LEVEL.format(name="b3", path="domain, lang, source", last="source", part="PARTITION BY domain, lang",
                  room="u.budget", weight="1", up="JOIN b2 u ON u.domain IS NOT DISTINCT FROM l.domain "
                  "AND u.lang IS NOT DISTINCT FROM l.lang") + """,
plan AS (SELECT l.domain, l.lang, l.source, budget // supply AS whole_epochs, budget % supply AS rest
         FROM leaves l JOIN b3 ON l.domain IS NOT DISTINCT FROM b3.domain AND l.lang IS NOT DISTINCT FROM b3.lang
              AND l.source IS NOT DISTINCT FROM b3.source WHERE supply > 0),
ordered AS (SELECT d.*, whole_epochs, rest, sum(n_tokens) OVER (PARTITION BY d.domain, d.lang, d.source
              ORDER BY md5('17|' || (whole_epochs + 1)::BIGINT || '|' || doc_id), doc_id ROWS UNBOUNDED PRECEDING) AS run
            FROM docs d JOIN plan p ON d.domain IS NOT DISTINCT FROM p.domain AND d.lang IS NOT DISTINCT FROM p.lang
                 AND d.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, domain, lang, source, n_tokens::BIGINT AS n_tokens,
       unnest(range(1, CAST(whole_epochs + CASE WHEN rest > 0 AND run <= rest THEN 1 ELSE 0 END AS BIGINT) + 1))::INTEGER
         AS epoch
FROM ordered
"""

# base 32 of a SHA-1: the i-th letter stands for the five bits from bit 5i, cut from two neighbouring hexadecimal digits
WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, row_number() OVER () AS r FROM pages),
d AS (SELECT page_id, r, octet_length(encode(html)) AS payload_bytes, sha1(html) AS h, sha256(html) AS s,
             list_transform(string_split(sha1(html), ''), lambda c: instr('0123456789abcdef', c) - 1) AS x FROM p),
named AS (SELECT *, list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
            ((((16 * x[5 * i // 4 + 1] + x[5 * i // 4 + 2]) >> (3 - 5 * i % 4)) & 31) + 1)::BIGINT, 1)), 'string_agg', '')
            AS payload_digest,
            first_value(page_id) OVER w AS top, row_number() OVER w AS place
          FROM d WINDOW w AS (PARTITION BY s ORDER BY page_id DESC NULLS LAST, r))
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
       CASE WHEN place = 1 THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN place > 1 THEN top END AS refers_to
FROM named
"""

NEGATIVES = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (SELECT a.r AS ar, a.vec_id AS anchor_id, b.r AS br, b.vec_id, a.label = b.label AS same,
             list_inner_product(a.x, b.x)::BIGINT AS score
      FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.r <> b.r),
p AS (SELECT * FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY ar ORDER BY score DESC, vec_id NULLS LAST, br) <= 5),
n AS (SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score,
             s.score AS negative_score,
             row_number() OVER (PARTITION BY p.ar, p.br ORDER BY s.score DESC, s.vec_id NULLS LAST, s.br) AS rank
      FROM p JOIN s ON p.ar = s.ar AND NOT s.same AND 100 * s.score BETWEEN 30 * p.score AND 90 * p.score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
"""

ORACLES = {"op1_url_filters": URLS, "op3_quality_rules": RULES, "op6_line_dedup": LINES, "op8_mixing": MIX,
           "op11_warc": WARC, "op12_hard_negatives": NEGATIVES}
