"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

#: Row k of a conversation: cheapest (cost c, audit a) per state of the automaton, insertions before the row first.
_INSERTED = """
  SELECT *, s0 AS y0, s1 AS y1,
         least(s2, {'c': s0.c + 2, 'a': s0.a || 'I'}, {'c': s1.c + 2, 'a': s1.a || 'I'}, {'c': s3.c + 2, 'a': s3.a || 'I'}) AS y2,
         least(s3, {'c': s2.c + 2, 'a': s2.a || 'I'}, {'c': s0.c + 4, 'a': s0.a || 'II'}, {'c': s1.c + 4, 'a': s1.a || 'II'}) AS y3"""

ORACLE_SQL = {
    "op11_structure_repair": rf"""
WITH RECURSIVE bits AS (SELECT i, 0 AS k, i AS c FROM range(256) t(i)
  UNION ALL SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM bits WHERE k < 8),
crc AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE k = 8),
src AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(
              coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda x: CAST(ascii(x) AS BIGINT))),
            lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295::BIGINT) % 20 AS draw
        FROM conversations, crc),
dam AS (SELECT conv_id, turn, CASE WHEN draw = 4 THEN 'user' ELSE role END AS role,
        CASE draw WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
        unnest(range(CASE WHEN draw = 3 THEN 2 ELSE 1 END)) AS copy FROM src WHERE draw <> 0),
num AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, left(role, 64), left(text, 64),
             sha256(length(role) || ':' || role || text)) AS k,
             regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS ending FROM dam),
flt AS (SELECT *, CASE WHEN ending = '' THEN 1 WHEN min(k) OVER (PARTITION BY conv_id, role, text) < k THEN 2
                       WHEN ending NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault,
               lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY k) || left(role, 1) AS pair FROM num),
cnt AS (SELECT conv_id, CAST(coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS BIGINT) AS gaps,
               count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated,
               count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM flt GROUP BY conv_id),
vec AS (SELECT conv_id, 0::BIGINT AS k, {{'c': 0, 'a': ''}} AS s0, {{'c': 900000000, 'a': ''}} AS s1,
               {{'c': 900000000, 'a': ''}} AS s2, {{'c': 900000000, 'a': ''}} AS s3 FROM cnt
  UNION ALL
  SELECT conv_id, k + 1,
         {{'c': y0.c + 3, 'a': y0.a || 'D'}},
         least({{'c': y1.c + 3, 'a': y1.a || 'D'}}, {{'c': y0.c + CASE WHEN i = 's' THEN keeps ELSE 900000000 END, 'a': y0.a || 'K'}}),
         least({{'c': y2.c + 3, 'a': y2.a || 'D'}},
               {{'c': y0.c + CASE WHEN i = 'u' THEN keeps ELSE 900000000 END, 'a': y0.a || 'K'}},
               {{'c': y1.c + CASE WHEN i = 'u' THEN keeps ELSE 900000000 END, 'a': y1.a || 'K'}},
               {{'c': y3.c + CASE WHEN i = 'u' THEN keeps ELSE 900000000 END, 'a': y3.a || 'K'}},
               {{'c': y0.c + keeps + 2, 'a': y0.a || 'R'}}, {{'c': y1.c + keeps + 2, 'a': y1.a || 'R'}}, {{'c': y3.c + keeps + 2, 'a': y3.a || 'R'}}),
         least({{'c': y3.c + 3, 'a': y3.a || 'D'}}, {{'c': y2.c + CASE WHEN i = 'a' THEN keeps ELSE 900000000 END, 'a': y2.a || 'K'}},
               {{'c': y2.c + keeps + 2, 'a': y2.a || 'R'}})
  FROM ({_INSERTED}
        FROM (SELECT vec.*, left(role, 1) AS i, CASE fault WHEN 0 THEN 0 WHEN 3 THEN 1 ELSE 900000000 END AS keeps
              FROM vec JOIN flt ON flt.conv_id IS NOT DISTINCT FROM vec.conv_id AND flt.k = vec.k + 1))),
fin AS (SELECT conv_id, max(k) AS k, arg_max(least(s0, s3, {{'c': s2.c + 2, 'a': s2.a || 'I'}}, {{'c': s1.c + 4, 'a': s1.a || 'II'}}), k) AS best
        FROM vec GROUP BY conv_id),
-- The audit applied: edit i, rows consumed k, state q.
fix AS (SELECT conv_id, best.a AS audit, 1 AS i, 0::BIGINT AS k, 0 AS q, CAST([] AS VARCHAR[]) AS said FROM fin
  UNION ALL
  SELECT fix.conv_id, audit, i + 1, fix.k + CASE WHEN e = 'I' THEN 0 ELSE 1 END,
         CASE WHEN e = 'D' THEN q WHEN e = 'K' THEN CASE left(role, 1) WHEN 's' THEN 1 WHEN 'u' THEN 2 ELSE 3 END
              WHEN q = 2 THEN 3 ELSE 2 END,
         CASE WHEN e = 'D' THEN said ELSE list_append(said, CASE WHEN e = 'K' THEN role WHEN q = 2 THEN 'assistant' ELSE 'user' END || ':'
              || CASE WHEN e = 'I' THEN '' ELSE text END) END
  FROM (SELECT *, substr(audit, i, 1) AS e FROM fix WHERE i <= length(audit)) fix
  LEFT JOIN flt ON flt.conv_id IS NOT DISTINCT FROM fix.conv_id AND flt.k = fix.k + 1),
rep AS (SELECT conv_id, arg_max(sha256(array_to_string(said, chr(10))), i) AS h FROM fix GROUP BY conv_id)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(best.c, 0) AS BIGINT) AS cost,
       coalesce(best.a, '') AS audit, coalesce(h, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN cnt ON cnt.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN fin ON fin.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN rep ON rep.conv_id IS NOT DISTINCT FROM o.conv_id
""",
    "op4_chat_formatting": r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
t AS (SELECT *, (strlen(text) + 3) // 4 + 4 AS tokens FROM c),
s AS (SELECT *, coalesce(sum(tokens) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text
                         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start,
             -- characters of the turn: each mark once more, and each quoted instruction mark
             length(role) + length(regexp_replace(role, '[^\\<|>]', '', 'g'))
             + length(text) + length(regexp_replace(text, '[^\\<|>]', '', 'g'))
             + (length(role) - length(replace(role, '[INST]', ''))) // 6 + (length(role) - length(replace(role, '[/INST]', ''))) // 7
             + (length(text) - length(replace(text, '[INST]', ''))) // 6 + (length(text) - length(replace(text, '[/INST]', ''))) // 7
             + 8 AS chars FROM t),
y AS (SELECT conv_id, tokens AS system, chars FROM s WHERE start = 0 AND role = 'system'),
n AS (SELECT s.*, coalesce(system, 0) AS system, greatest(1024 - 192 - coalesce(system, 0), 128) AS step
      FROM s LEFT JOIN y USING (conv_id) WHERE NOT (start = 0 AND role = 'system')),
w AS (SELECT *, 2 * ((start - system) // step)
             + CASE WHEN (start - system + tokens - 1) // step <> (start - system) // step THEN 1 ELSE 0 END AS win FROM n),
b AS (SELECT conv_id, win, min(start) AS begins FROM w GROUP BY conv_id, win),
f AS (SELECT conv_id, chars FROM w
      UNION ALL SELECT w.conv_id, w.chars FROM w JOIN b ON w.conv_id = b.conv_id
                AND b.begins >= w.start + w.tokens AND b.begins <= w.start + 192
      UNION ALL SELECT y.conv_id, y.chars FROM y LEFT JOIN b USING (conv_id)),
k AS (SELECT conv_id, sum(chars) AS formatted_chars FROM f GROUP BY conv_id)
SELECT t.conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(any_value(formatted_chars) AS BIGINT) AS formatted_chars
FROM t JOIN k USING (conv_id) GROUP BY t.conv_id
""",
    "op13_lexical_search": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents),
i AS (SELECT item_id, unnest(list_distinct(regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))) AS term FROM benchmark),
s AS (SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(len(t)) AS BIGINT) AS n_terms FROM d WHERE len(t) > 0),
e AS (SELECT doc_id, CAST(len(t) AS BIGINT) AS n, unnest(t) AS term FROM d),
p AS (SELECT doc_id, n, term, count(*) AS tf FROM e GROUP BY doc_id, n, term),
w AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM p, s GROUP BY term, n_docs),
x AS (SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * n_docs) // n_terms)))) AS BIGINT) AS score
      FROM i JOIN p USING (term) JOIN w USING (term), s GROUP BY item_id, doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM x WHERE score > 0 QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 50
""",
    "op5_warc_archive": """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)
""",
    "op2_substring_dedup": f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
p AS (SELECT doc_id, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13),
g AS (SELECT p.doc_id, i, array_to_string(w[i:i + 12], ' ') AS s FROM p JOIN d USING (doc_id)),
m AS (SELECT s, min(doc_id) AS first FROM g GROUP BY s),
r AS (SELECT g.doc_id, i FROM g JOIN m USING (s) WHERE first < g.doc_id),
c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS k FROM r),
x AS (SELECT doc_id, list(k) AS ks FROM c GROUP BY doc_id),
e AS (SELECT d.doc_id, unnest(range(1, len(w) + 1)) AS k, unnest(w) AS word FROM d),
kept AS (SELECT e.doc_id, string_agg(word, ' ' ORDER BY e.k) AS t, count(*) AS n
         FROM e ANTI JOIN c ON e.doc_id = c.doc_id AND e.k = c.k GROUP BY e.doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
""",
    "op7_source_mixing": rf"""
WITH d AS (SELECT doc_id, source, CAST(len({_WORDS}) AS BIGINT) AS size, md5(coalesce(text, '')) AS digest FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, 3 * source_size AS most, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM s),
-- the water level: the sources that are full at the level which leaves the rest in proportion
l AS (SELECT a.source, a.most / a.weight AS full_at,
             ((SELECT sum(source_size) FROM s)
              - coalesce(sum(b.most) FILTER (b.most / b.weight < a.most / a.weight
                  OR (b.most / b.weight = a.most / a.weight
                      AND (b.source < a.source OR (a.source IS NULL AND b.source IS NOT NULL)))), 0))
             / (a.weight + coalesce(sum(b.weight) FILTER (b.most / b.weight > a.most / a.weight
                  OR (b.most / b.weight = a.most / a.weight
                      AND (b.source > a.source OR (b.source IS NULL AND a.source IS NOT NULL)))), 0)) AS level
      FROM w a, w b GROUP BY a.source, a.most, a.weight),
c AS (SELECT max(level) FILTER (full_at > level) AS common FROM l),
t AS (SELECT source, source_size,
             least(CAST(most AS DOUBLE), coalesce(common * weight, CAST(most AS DOUBLE))) AS target FROM w, c),
q AS (SELECT d.*, source_size, target, floor(coalesce(target / nullif(source_size, 0), 0)) AS certain,
             greatest(1, CAST(floor(sqrt(CAST(size AS DOUBLE))) AS BIGINT)) AS weight,
             (CAST('0x' || substr(md5('7:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || digest), 1, 13) AS BIGINT)
              + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE AS u
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
r AS (SELECT *, target - certain * source_size AS rest FROM q),
-- inclusion probabilities in proportion to the weight; documents that would pass 1 are certain
g AS (SELECT source, weight, any_value(rest) AS rest, CAST(sum(size) AS BIGINT) AS words FROM r GROUP BY source, weight),
h AS (SELECT a.source, a.weight, a.rest, CAST(coalesce(sum(b.words) FILTER (b.weight > a.weight), 0) AS DOUBLE) AS heavier,
             CAST(sum(b.words * b.weight) FILTER (b.weight <= a.weight) AS DOUBLE) AS onward
      FROM g a JOIN g b ON a.source IS NOT DISTINCT FROM b.source GROUP BY a.source, a.weight, a.rest),
m AS (SELECT source, max(weight) AS top, arg_max(heavier, weight) AS sure, arg_max(onward, weight) AS weighed
      FROM h WHERE (rest - heavier) * weight < onward GROUP BY source),
p AS (SELECT r.*, CASE WHEN rest <= 0 THEN 0.0::DOUBLE WHEN weight > coalesce(top, 0) THEN 1.0::DOUBLE
                       ELSE least(1.0::DOUBLE, (rest - sure) * weight / weighed) END AS chance
      FROM r LEFT JOIN m ON r.source IS NOT DISTINCT FROM m.source),
o AS (SELECT *, CASE WHEN chance >= 1 THEN u - 1 WHEN chance > 0 THEN (u * (1 - chance)) / ((1 - u) * chance)
                     ELSE u / (1 - u) END AS odds FROM p),
a AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY odds, doc_id NULLS LAST, size
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead FROM o)
SELECT doc_id, size, source_size, target,
       CAST((certain + CASE WHEN rest > 0 AND 2 * ahead + size <= 2 * rest THEN 1 ELSE 0 END) * size AS BIGINT) AS taken
FROM a
""",
}
