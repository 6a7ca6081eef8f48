"""DuckDB SQL of the queries whose whole result SQL can state on the tables of the correctness run."""

from __future__ import annotations

from citeflow.llm.line_templates import DEPTH, SHAPES, SIMILARITY

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: every pair of documents that share a shingle, counted; then all that can be reached by links
PARTENUM = f"""
WITH RECURSIVE w AS (
    SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
    FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
             ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS sh FROM w),
n AS (SELECT doc_id, len(sh) AS n FROM s),
e AS (SELECT doc_id, unnest(sh) AS g FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM e a JOIN e b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
both_ways AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
reach AS (SELECT doc_id, doc_id AS at FROM n UNION SELECT r.doc_id, k.b FROM reach r JOIN both_ways k ON r.at = k.a)
SELECT r.doc_id, CAST(any_value(n.n) AS BIGINT) AS n_shingles, min(r.at) AS component_id FROM reach r JOIN n USING (doc_id) GROUP BY r.doc_id
"""

LINES = f"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS raw FROM documents),
l AS (SELECT doc_id, unnest(raw) AS raw, unnest(range(len(raw))) AS place FROM d),
m AS (SELECT *, regexp_replace(raw, '(^|\\s)[^\\s\\d]*\\d\\S*', '\\1<*>', 'g') AS line FROM l),
t AS (SELECT *, length(line) - length(replace(line, ' ', '')) + 1 AS tokens, array_to_string(string_split(line, ' ')[1:{DEPTH}], ' ') AS head,
             (length(line) - length(replace(line, '<*>', ''))) // 3 AS fields FROM m),
k AS (SELECT doc_id, count(*) AS n_lines, CAST(floor(ln(greatest(sum(tokens), 1)) / ln(2) * 8) AS BIGINT) AS size FROM t GROUP BY doc_id),
u AS (SELECT t.*, length(trim(line)) > 0 AND 2 * fields <= tokens AS fit, n_lines * 100000 + size AS shape FROM t JOIN k USING (doc_id)),
counted AS (SELECT DISTINCT tokens, head, line, shape FROM u WHERE fit),
exact AS (SELECT line FROM counted GROUP BY line HAVING count(*) >= {SHAPES}),
rest AS (SELECT * FROM counted WHERE line NOT IN (SELECT line FROM exact)),
leaves AS (SELECT tokens, head FROM rest GROUP BY ALL HAVING count(DISTINCT shape) >= {SHAPES} AND count(DISTINCT line) > 1),
texts AS (SELECT DISTINCT tokens, head, line, string_split(line, ' ') AS words FROM rest JOIN leaves USING (tokens, head)),
places AS (SELECT tokens, head, unnest(words) AS word, unnest(range(len(words))) AS place FROM texts),
votes AS (SELECT tokens, head, place, word, count(*) AS n FROM places GROUP BY ALL),
best AS (SELECT tokens, head, place, word FROM votes QUALIFY row_number() OVER (PARTITION BY tokens, head, place ORDER BY n DESC, word DESC) = 1),
templates AS (SELECT tokens, head, list(word ORDER BY place) AS template FROM best GROUP BY ALL),
held AS (SELECT tokens, head, line FROM texts JOIN templates USING (tokens, head)
         WHERE len(list_filter(list_zip(words, template), lambda z: z[1] = z[2])) >= {SIMILARITY} * len(words)),
wide AS (SELECT tokens, head FROM counted JOIN held USING (tokens, head, line) GROUP BY ALL HAVING count(DISTINCT shape) >= {SHAPES}),
dropped AS (SELECT line FROM exact UNION SELECT line FROM held JOIN wide USING (tokens, head)),
f AS (SELECT *, fit AND line IN (SELECT line FROM dropped) AS gone FROM u),
o AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
             coalesce(string_agg(raw, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '') AS kept FROM f GROUP BY doc_id)
SELECT doc_id, n_lines, n_dropped, length(kept) AS kept_chars, sha256(kept) AS kept_sha256 FROM o
"""

#: the rows after damage (crc32 from its table), their faults, then the cheapest audit by position and state; between
#: two turns up to three inserts, more than that return to a state at a cost
REPAIR = f"""
WITH RECURSIVE crc AS (SELECT list(v ORDER BY i) AS t FROM (SELECT i, list_reduce(list_prepend(i, range(8)),
                            lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) r(i))),
k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
             list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda c: CAST(ascii(c) AS BIGINT)) AS bytes
      FROM conversations),
h AS (SELECT k.*, xor(list_reduce(list_prepend(4294967295, bytes), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS code FROM k, crc),
d AS (SELECT conv_id, turn, CASE WHEN code = 4 THEN 'user' ELSE role END AS role,
             CASE code WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
             unnest(range(CASE WHEN code = 3 THEN 2 ELSE 1 END)) AS copy FROM h WHERE code <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
             row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth, left(role, 1) AS c,
             regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS seen FROM d),
f AS (SELECT *, seen = '' AS blank, seen <> '' AND nth > 1 AS again, seen <> '' AND nth = 1 AND right(seen, 1) NOT IN ('.', '!', '?') AS cut,
             i > 1 AND lag(c) OVER (PARTITION BY conv_id ORDER BY i) || c NOT IN ('su', 'ua', 'au') AS odd FROM o),
counts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE blank) AS blank,
             count(*) FILTER (WHERE again) AS duplicate, count(*) FILTER (WHERE cut) AS truncated, count(*) FILTER (WHERE odd) AS illegal, max(i) AS n
           FROM f GROUP BY conv_id),
ins(st, n, st2) AS (VALUES (0, 0, 0), (1, 0, 1), (2, 0, 2), (3, 0, 3), (0, 1, 2), (0, 2, 3), (1, 1, 2), (1, 2, 3), (2, 1, 3), (3, 1, 2)),
follows(st, c, st2) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
forced(st, st2, role) AS (VALUES (0, 2, 'user'), (1, 2, 'user'), (2, 3, 'assistant'), (3, 2, 'user')),
made(st, n, lines) AS (VALUES (0, 0, []), (1, 0, []), (2, 0, []), (3, 0, []), (0, 1, ['user:']), (0, 2, ['user:', 'assistant:']),
             (1, 1, ['user:']), (1, 2, ['user:', 'assistant:']), (2, 1, ['assistant:']), (3, 1, ['user:'])),
way AS (
    SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS i, 0 AS st, {{'cost': CAST(0 AS BIGINT), 'audit': '', 'lines': CAST([] AS VARCHAR[])}} AS best FROM conversations
    UNION ALL
    SELECT conv_id, i, st, min(best) FROM (
        SELECT w.conv_id, f.i, e.st2 AS st, {{'cost': w.best.cost + 2 * j.n + e.cost, 'audit': w.best.audit || repeat('I', j.n) || e.op,
                                             'lines': list_concat(w.best.lines, m.lines, CASE WHEN e.line IS NULL THEN [] ELSE [e.line] END)}} AS best
        FROM way w JOIN f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.i = w.i + 1 JOIN ins j ON j.st = w.st JOIN made m ON m.st = w.st AND m.n = j.n,
        LATERAL (SELECT j.st2 AS st2, 3 AS cost, 'D' AS op, CAST(NULL AS VARCHAR) AS line
                 UNION ALL SELECT x.st2, CAST(f.cut AS INTEGER), 'K', f.role || ':' || f.text FROM follows x WHERE x.st = j.st2 AND x.c = f.c AND NOT f.blank AND NOT f.again
                 UNION ALL SELECT y.st2, 2 + CAST(f.cut AS INTEGER), 'R', y.role || ':' || f.text FROM forced y WHERE y.st = j.st2 AND NOT f.blank AND NOT f.again) e)
    GROUP BY conv_id, i, st),
whole AS (SELECT w.conv_id, min({{'cost': w.best.cost + 2 * j.n, 'audit': w.best.audit || repeat('I', j.n), 'lines': list_concat(w.best.lines, m.lines)}}) AS best
          FROM way w LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM w.conv_id JOIN ins j ON j.st = w.st JOIN made m ON m.st = w.st AND m.n = j.n
          WHERE w.i = coalesce(c.n, 0) AND j.st2 IN (0, 3) GROUP BY w.conv_id)
SELECT w.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, best.cost AS cost, best.audit AS audit, sha256(array_to_string(best.lines, chr(10))) AS repaired_sha256
FROM whole w LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM w.conv_id
"""

#: phrases as lists of words of each piece; every cut and every longer phrase by name
PHRASES = f"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM p),
g AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
      FROM w, (SELECT unnest([1, 2, 3]) AS k) WHERE len(w) >= k),
f AS (SELECT lang, k, phrase, CAST(count(*) AS HUGEINT) AS a FROM g GROUP BY ALL HAVING count(*) >= 10),
n AS (SELECT lang, sum(len(w)) AS n FROM w GROUP BY lang),
c AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
cuts AS (SELECT c.lang, c.phrase, c.k, c.a, j, x.a AS l, y.a AS r, 1000000 * c.a * c.a // (x.a * y.a) AS score
         FROM c, (SELECT unnest([1, 2]) AS j), f x, f y WHERE j < c.k AND x.lang = c.lang AND x.phrase = array_to_string(c.w[:j], ' ')
         AND y.lang = c.lang AND y.phrase = array_to_string(c.w[j + 1:], ' ')),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
inner_pairs AS (SELECT lang, array_to_string(w[i:i + 1], ' ') AS phrase, max(a) AS longer FROM c, (SELECT unnest([1, 2]) AS i) WHERE k = 3 GROUP BY ALL),
kept AS (SELECT b.* FROM best b LEFT JOIN inner_pairs i ON b.k = 2 AND i.lang = b.lang AND i.phrase = b.phrase WHERE i.longer IS NULL OR 100 * i.longer < 50 * b.a)
SELECT kept.lang, row_number() OVER (PARTITION BY kept.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l,
       CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM kept JOIN n ON n.lang = kept.lang QUALIFY rank <= 2000
"""
