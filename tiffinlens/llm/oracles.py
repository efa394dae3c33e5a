"""DuckDB SQL for the training-data queries that SQL can express, written from their definitions."""

from __future__ import annotations

LINES = r"""
WITH cut AS (
    SELECT doc_id, source, text, unnest(string_split(text, chr(10))) AS line,
           unnest(range(len(string_split(text, chr(10))))) AS place
    FROM documents
), named AS (
    SELECT *, trim(line, ' ' || chr(9) || chr(13)) AS bare FROM cut
), sites AS (
    SELECT source, count(*) AS pages FROM documents WHERE source IS NOT NULL GROUP BY source
), common AS (
    SELECT n.source, n.bare
    FROM named n JOIN sites s USING (source)
    WHERE n.bare <> ''
    GROUP BY n.source, n.bare
    HAVING count(DISTINCT n.doc_id) >= 5 AND count(DISTINCT n.doc_id) > 0.1 * any_value(s.pages)
), cleaned AS (
    SELECT n.doc_id,
           coalesce(string_agg(n.line, chr(10) ORDER BY n.place) FILTER (WHERE c.bare IS NULL), '') AS text,
           count(*) FILTER (WHERE n.bare <> '') AS n_lines,
           count(c.bare) AS n_dropped
    FROM named n LEFT JOIN common c ON n.source = c.source AND n.bare = c.bare
    GROUP BY n.doc_id
)
SELECT d.doc_id, d.source, k.text, coalesce(k.n_lines, 0)::BIGINT AS n_lines,
       coalesce(k.n_dropped, 0)::BIGINT AS n_dropped
FROM documents d LEFT JOIN cleaned k USING (doc_id)
"""

# Matches and the gaps between them add up to positions; RE2 and Java agree on these patterns.
SECRETS = r"""
WITH rules(kind, place, pattern, grp, least) AS (
    VALUES
    ('assign', 0, '((?i:password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2, 12),
    ('access', 1, '(AKIA[A-Z0-9]+)', 1, 18),
    ('hex', 2, '([0-9a-f]+)', 1, 16)
), runs AS (
    SELECT d.doc_id, r.kind, r.place, r.least,
           CASE r.kind
               WHEN 'assign' THEN regexp_extract_all(d.text, '((?i:password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 0)
               WHEN 'access' THEN regexp_extract_all(d.text, 'AKIA[A-Z0-9]+', 0)
               ELSE regexp_extract_all(d.text, '[0-9a-f]+', 0) END AS found,
           CASE r.kind
               WHEN 'assign' THEN regexp_extract_all(d.text, '((?i:password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2)
               WHEN 'access' THEN regexp_extract_all(d.text, 'AKIA[A-Z0-9]+', 0)
               ELSE regexp_extract_all(d.text, '[0-9a-f]+', 0) END AS checked,
           CASE r.kind
               WHEN 'assign' THEN string_split_regex(d.text, '(?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?[A-Za-z0-9+/_.=-]+')
               WHEN 'access' THEN string_split_regex(d.text, 'AKIA[A-Z0-9]+')
               ELSE string_split_regex(d.text, '[0-9a-f]+') END AS gaps
    FROM documents d CROSS JOIN rules r
    WHERE d.text IS NOT NULL
), one AS (
    SELECT doc_id, kind, place, least, unnest(range(len(found))) AS i,
           unnest(found) AS m, unnest(checked) AS c, unnest(gaps[1:len(found)]) AS gap
    FROM runs WHERE len(found) > 0
), placed AS (
    SELECT *, sum(length(gap) + length(m)) OVER (PARTITION BY doc_id, kind ORDER BY i) AS stop FROM one
), spans AS (
    SELECT doc_id, kind, place, (stop - length(m))::BIGINT AS start, stop::BIGINT AS stop
    FROM placed WHERE length(c) >= least
), told AS (
    SELECT doc_id, count(*) FILTER (WHERE kind = 'assign') AS n_assign,
           count(*) FILTER (WHERE kind = 'access') AS n_access, count(*) FILTER (WHERE kind = 'hex') AS n_hex,
           string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, place) AS spans
    FROM spans GROUP BY doc_id
)
SELECT d.doc_id, coalesce(t.n_assign, 0)::BIGINT AS n_assign, coalesce(t.n_access, 0)::BIGINT AS n_access,
       coalesce(t.n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(t.spans, '')) AS base_sha256,
       coalesce(t.spans, '') AS spans
FROM documents d LEFT JOIN told t USING (doc_id)
"""

RULES = r"""
WITH texts AS (
    SELECT doc_id, coalesce(text, '') AS text,
           list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words,
           list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
    FROM documents
), windows AS (
    SELECT doc_id, p, list_slice(words, p, p + 7) AS w
    FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS p FROM texts WHERE len(words) >= 8)
), often AS (
    SELECT doc_id, w FROM windows GROUP BY doc_id, w HAVING count(*) > 1
), covered AS (
    SELECT doc_id, count(DISTINCT q) AS n
    FROM (SELECT v.doc_id, unnest(range(v.p, v.p + 8)) AS q FROM windows v JOIN often o ON v.doc_id = o.doc_id AND v.w = o.w)
    GROUP BY doc_id
), counted AS (
    SELECT t.doc_id, t.text, t.words, len(t.words)::BIGINT AS n_words, len(t.lines) AS n_lines,
           coalesce(list_sum(list_transform(t.words, lambda w: length(w))), 0)::BIGINT AS word_chars,
           length(regexp_replace(t.text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
           (len(t.lines) - len(list_distinct(t.lines)))::BIGINT AS n_dup_lines,
           coalesce(c.n, 0)::BIGINT AS n_repeat_words
    FROM texts t LEFT JOIN covered c USING (doc_id)
), judged AS (
    SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
           n_symbols > 0.1 * n_words OR n_dup_lines > 0.3 * n_lines
           OR word_chars < 2 * n_words OR word_chars > 15 * n_words
           OR len(list_filter(words, lambda w: w = upper(w) AND w <> lower(w))) > 0.5 * n_words
           OR len(regexp_extract_all(text, '[!?]{2,}')) > 0.1 * n_words AS bad
    FROM counted
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT bad AS kept
FROM judged
"""

WARC = r"""
WITH payloads AS (
    SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, ''))::BIGINT AS payload_bytes FROM pages
), firsts AS (
    SELECT html, min(page_id) AS first FROM payloads WHERE payload_bytes >= 100 GROUP BY html
)
SELECT p.page_id, p.payload_bytes, sha256(p.html) AS payload_digest,
       CASE WHEN f.first <> p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN f.first <> p.page_id THEN f.first END AS refers_to,
       NULL::VARCHAR AS error
FROM payloads p LEFT JOIN firsts f ON p.html = f.html
"""

CHAT = r"""
WITH asked AS (
    SELECT conv_id, turn, text, turn + turn % 2 AS place, 'call-' || turn AS call_id,
           len(string_split(text, ' ')) AS words
    FROM conversations WHERE role = 'user'
), told AS (
    SELECT conv_id, turn, text, 'call-' || (turn - 1) AS call_id FROM conversations WHERE role = 'assistant'
), calls AS (
    SELECT a.conv_id, a.place AS position, 0 AS step, a.place AS turn, 'tool_call' AS role, a.call_id,
           CASE WHEN t.conv_id IS NULL THEN 'unanswered call'
                WHEN a.text = '' THEN 'invalid arguments: $.question: too short'
                WHEN a.words > 40 THEN 'invalid arguments: $.words: out of range'
                ELSE 'ok' END AS status,
           '{"role":"assistant","tool_calls":[{"arguments":{"question":' || to_json(a.text) || ',"words":' || a.words
           || '},"id":' || to_json(a.call_id) || ',"name":"lookup"}]}' AS json
    FROM asked a LEFT JOIN told t USING (conv_id, call_id)
), results AS (
    SELECT t.conv_id, greatest(t.turn, coalesce(a.place, t.turn)) AS position,
           CASE WHEN a.place >= t.turn THEN 1 ELSE 0 END AS step, t.turn, 'tool' AS role, t.call_id,
           CASE WHEN a.conv_id IS NULL THEN 'unknown call' ELSE 'ok' END AS status,
           '{"content":' || to_json(t.text) || ',"role":"tool","tool_call_id":' || to_json(t.call_id) || '}' AS json
    FROM told t LEFT JOIN asked a USING (conv_id, call_id)
), plain AS (
    SELECT conv_id, turn AS position, 0 AS step, turn, role, NULL::VARCHAR AS call_id, 'ok' AS status,
           '{"content":' || to_json(text) || ',"role":' || to_json(role) || '}' AS json
    FROM conversations
), everything AS (
    SELECT * FROM calls UNION ALL SELECT * FROM results UNION ALL SELECT * FROM plain
)
SELECT conv_id, position, step::BIGINT AS step, turn, role, call_id, status, json FROM everything
"""

CHAINED_CHAT = r"""
WITH RECURSIVE asked AS (
    SELECT conv_id, turn, text, 'call-' || turn AS call_id, len(string_split(text, ' ')) AS words,
           CASE WHEN turn % 4 >= 2 THEN greatest(turn - 3, 0) ELSE turn + turn % 2 END AS place
    FROM conversations WHERE role = 'user'
), told AS (
    SELECT conv_id, turn, text, 'call-' || (turn - 1) AS call_id FROM conversations WHERE role = 'assistant'
), placed AS (
    SELECT conv_id, turn, place AS position, 0::BIGINT AS step FROM asked WHERE turn < 2
    UNION ALL
    SELECT a.conv_id, a.turn, greatest(a.place, t.turn, p.position),
           CASE WHEN a.place > greatest(t.turn, p.position) THEN 0 WHEN t.turn > p.position THEN 1 ELSE p.step + 2 END
    FROM placed p
    JOIN told t ON t.conv_id = p.conv_id AND t.turn = p.turn + 1
    JOIN asked a ON a.conv_id = p.conv_id AND a.turn = p.turn + 2
), ordered AS (
    SELECT a.*, coalesce(p.position, a.place) AS position, coalesce(p.step, 0) AS step, p.conv_id IS NULL AS stuck
    FROM asked a LEFT JOIN placed p ON p.conv_id = a.conv_id AND p.turn = a.turn
), calls AS (
    SELECT a.conv_id, a.position, a.step, a.place AS turn, 'tool_call' AS role, a.call_id,
           CASE WHEN a.stuck THEN 'unresolved'
                WHEN t.conv_id IS NULL THEN 'unanswered call'
                WHEN a.text = '' THEN 'invalid arguments: $.question: too short'
                WHEN a.words > 40 THEN 'invalid arguments: $.words: out of range'
                ELSE 'ok' END AS status,
           '{"role":"assistant","tool_calls":[{"arguments":{"question":' || to_json(a.text) || ',"words":' || a.words
           || '},"id":' || to_json(a.call_id) || ',"name":"lookup"}]}' AS json
    FROM ordered a LEFT JOIN told t USING (conv_id, call_id)
), results AS (
    SELECT t.conv_id, greatest(t.turn, coalesce(a.position, t.turn)) AS position,
           CASE WHEN a.position >= t.turn THEN a.step + 1 ELSE 0 END AS step, t.turn, 'tool' AS role, t.call_id,
           CASE WHEN a.conv_id IS NULL THEN 'unknown call' ELSE 'ok' END AS status,
           '{"content":' || to_json(t.text) || ',"role":"tool","tool_call_id":' || to_json(t.call_id) || '}' AS json
    FROM told t LEFT JOIN ordered a USING (conv_id, call_id)
), plain AS (
    SELECT conv_id, turn AS position, 0 AS step, turn, role, NULL::VARCHAR AS call_id, 'ok' AS status,
           '{"content":' || to_json(text) || ',"role":' || to_json(role) || '}' AS json
    FROM conversations
)
SELECT conv_id, position, step::BIGINT AS step, turn, role, call_id, status, json
FROM (SELECT * FROM calls UNION ALL SELECT * FROM results UNION ALL SELECT * FROM plain)
"""

# Trees level by level, then every leaf upwards; CRC-32 bit by bit.
MERKLE = r"""
WITH RECURSIVE leaves AS (
    SELECT doc_id, source, text,
           row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST) - 1 AS place,
           coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
               || coalesce(strlen(lang) || ':' || lang, '-')
               || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS front,
           coalesce(strlen(text) || ':' || text, '-') AS body,
           coalesce(strlen(text) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-') AS spoilt
    FROM documents
), checks(doc_id, left_over, crc) AS (
    SELECT doc_id, doc_id::VARCHAR, 4294967295::BIGINT FROM documents WHERE doc_id IS NOT NULL
    UNION ALL
    SELECT doc_id, left_over[2:],
           list_reduce(list_prepend(xor(crc, ascii(left_over)::BIGINT), range(8)),
                       lambda c, step: xor(c >> 1, 3988292384 * (c & 1)))
    FROM checks WHERE left_over <> ''
), tampered AS (
    SELECT DISTINCT doc_id FROM checks WHERE left_over = '' AND xor(crc, 4294967295) % 5 = 0
), nodes(source, level, place, digest, more) AS (
    SELECT source, 0, place, sha256(front || body), count(*) OVER (PARTITION BY source) > 1 FROM leaves
    UNION ALL
    SELECT * FROM (
        SELECT source, level, place, digest, count(*) OVER (PARTITION BY source) > 1 FROM (
            SELECT source, any_value(level) + 1 AS level, place // 16 AS place,
                   sha256(string_agg(digest, '' ORDER BY place)) AS digest
            FROM nodes WHERE more GROUP BY source, place // 16
        )
    )
), subroots AS (
    SELECT source, digest AS subroot, level AS top, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS seat
    FROM nodes WHERE NOT more
), upper_nodes(level, place, digest, more) AS (
    SELECT 0, seat, subroot, count(*) OVER () > 1 FROM subroots
    UNION ALL
    SELECT * FROM (
        SELECT level, place, digest, count(*) OVER () > 1 FROM (
            SELECT any_value(level) + 1 AS level, place // 16 AS place,
                   sha256(string_agg(digest, '' ORDER BY place)) AS digest
            FROM upper_nodes WHERE more GROUP BY place // 16
        )
    )
), sides AS (
    SELECT n.source, n.level, n.place,
           coalesce(string_agg(o.digest, '' ORDER BY o.place) FILTER (WHERE o.place < n.place), '') AS before,
           coalesce(string_agg(o.digest, '' ORDER BY o.place) FILTER (WHERE o.place > n.place), '') AS behind
    FROM nodes n JOIN nodes o
      ON n.source IS NOT DISTINCT FROM o.source AND n.level = o.level AND n.place // 16 = o.place // 16
    WHERE n.more GROUP BY ALL
    UNION ALL
    SELECT s.source, s.top + n.level, n.place,
           coalesce(string_agg(o.digest, '' ORDER BY o.place) FILTER (WHERE o.place < n.place), ''),
           coalesce(string_agg(o.digest, '' ORDER BY o.place) FILTER (WHERE o.place > n.place), '')
    FROM upper_nodes n JOIN upper_nodes o ON n.level = o.level AND n.place // 16 = o.place // 16
    JOIN subroots s ON s.seat // (16 ** n.level)::BIGINT = n.place
    WHERE n.more GROUP BY ALL
), climb AS (
    SELECT l.doc_id, l.source, l.place, sha256(l.front || l.body) AS leaf, 0 AS level, '' AS proof,
           sha256(l.front || CASE WHEN t.doc_id IS NULL THEN l.body ELSE l.spoilt END) AS folded
    FROM leaves l LEFT JOIN tampered t ON l.doc_id = t.doc_id
    UNION ALL
    SELECT c.doc_id, c.source, c.place, c.leaf, c.level + 1, c.proof || i.before || i.behind,
           sha256(i.before || c.folded || i.behind)
    FROM climb c JOIN subroots s ON c.source IS NOT DISTINCT FROM s.source
    JOIN sides i ON c.source IS NOT DISTINCT FROM i.source AND c.level = i.level
      AND i.place = CASE WHEN c.level < s.top THEN c.place // (16 ** c.level)::BIGINT
                         ELSE s.seat // (16 ** (c.level - s.top))::BIGINT END
), ends AS (
    SELECT * FROM climb QUALIFY level = max(level) OVER (PARTITION BY source)
)
SELECT e.doc_id, e.leaf, s.subroot, u.digest AS root, sha256(e.proof) AS proof_sha256, e.folded AS folded_root,
       e.folded = u.digest AS verified
FROM ends e JOIN subroots s ON e.source IS NOT DISTINCT FROM s.source
JOIN upper_nodes u ON NOT u.more
"""

ORACLES: dict[str, str] = {
    "op1_line_dedup": LINES,
    "op3_quality_rules": RULES,
    "op4_secret_scans": SECRETS,
    "op6_warc": WARC,
    "op10_chat_format": CHAT,
    "op12_merkle_manifest": MERKLE,
}

MORE_ORACLES: dict[str, str] = {"op10_chat_format_chained": CHAINED_CHAT}
