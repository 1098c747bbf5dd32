"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

LLM_ORACLE: dict[str, str] = {}


def _positions(kind: str, number: int, pattern: str, group: int, least: int) -> str:
    return f"""
    SELECT doc_id, t, unnest(list_transform(range(1, len(h) + 1), lambda i: struct_pack(
               start := CAST(coalesce(list_sum(p[1:i]), 0) + coalesce(list_sum(h[1:i - 1]), 0) AS BIGINT),
               no := {number}, kind := '{kind}', size := h[i], held := g[i]))) AS m
    FROM (SELECT doc_id, t, list_transform(string_split_regex(t, '{pattern}'), lambda x: length(x)) AS p,
                 list_transform(regexp_extract_all(t, '{pattern}', 0), lambda x: length(x)) AS h,
                 list_transform(regexp_extract_all(t, '{pattern}', {group}), lambda x: length(x)) AS g
          FROM d) WHERE len(h) > 0"""


def _either(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_NAMES = "|".join(_either(w) for w in ("password", "passwd", "secret", "token", "api_?key"))
_ASSIGN = rf"""({_NAMES})["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""

LLM_ORACLE["op7_secret_scan"] = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
m AS ({_positions("assign", 1, _ASSIGN, 2, 6)}
    UNION ALL {_positions("access", 2, "AKIA[A-Z0-9]+", 0, 20)}
    UNION ALL {_positions("hex", 3, "[0-9a-f]+", 0, 24)}),
s AS (SELECT doc_id, count(*) FILTER (m.no = 1) AS n_assign, count(*) FILTER (m.no = 2) AS n_access,
             count(*) FILTER (m.no = 3) AS n_hex,
             string_agg(m.kind || ':' || m.start || ':' || (m.start + m.size), ',' ORDER BY m.start, m.no) AS spans
      FROM m WHERE m.held >= CASE m.no WHEN 1 THEN 6 WHEN 2 THEN 20 ELSE 24 END GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN s USING (doc_id)"""

LLM_ORACLE["op2_mix_sources"] = r"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
                  CAST('0x' || substr(md5('7:mix:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) AS place
           FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight,
             2 * source_size AS clamp, row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM s),
l AS (SELECT *, row_number() OVER o AS pos,
             (1.5::DOUBLE * (SELECT sum(source_size) FROM s)
              - coalesce(sum(clamp) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
             / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
      FROM w WINDOW o AS (ORDER BY clamp / weight, rank)),
t AS (SELECT source, source_size, least(clamp, weight * (SELECT arg_min(level, pos) FROM l WHERE level * weight <= clamp))
             AS target FROM l),
b AS (SELECT *, CAST(floor(target + 0.5) AS BIGINT) AS budget,
             CASE WHEN source_size > 0 THEN CAST(floor(target + 0.5) AS BIGINT) // source_size ELSE 0 END AS whole FROM t),
c AS (SELECT d.*, b.source_size, b.target, b.whole, b.budget - b.whole * b.source_size AS part,
             coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY place, doc_id, size
                                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, source_size, target,
       CAST(whole * size + greatest(0, least(size, part - before)) AS BIGINT) AS taken FROM c"""

# Everything is to come back as it went in; only the formatted length is the template's own.
LLM_ORACLE["op4_chat_format"] = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (SELECT *, length(regexp_replace(text, '([\[<])(\\*)(/?INST\]|/?ROLE\]|TEXT\]|/s>)', '\1\\\2\3', 'g'))
             + CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 4
                    ELSE 19 + length(regexp_replace(role, '([\[<])(\\*)(/?INST\]|/?ROLE\]|TEXT\]|/s>)', '\1\\\2\3', 'g')) END AS size FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(size) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id"""

LLM_ORACLE["op9_line_dedup"] = r"""
WITH l AS (SELECT doc_id, unnest(a) AS line, generate_subscripts(a, 1) - 1 AS line_no
           FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS a FROM documents)),
w AS (SELECT *, list_sort(list_distinct(regexp_extract_all(line, '[^\x20\x09-\x0D]+'))) AS ws FROM l),
c AS (SELECT ws, len(ws) AS n, row_number() OVER (ORDER BY min((doc_id, line_no))) AS id, min((doc_id, line_no)) AS first
      FROM w WHERE len(ws) > 0 GROUP BY ws),
u AS (SELECT id, n, unnest(ws) AS word FROM c),
f AS (SELECT word, count(*) AS df FROM u GROUP BY word),
p AS (SELECT id, n, word FROM u JOIN f USING (word)
      QUALIFY row_number() OVER (PARTITION BY id ORDER BY df, word) <= n - ((4 * n + 4) // 5) + 1),
k AS (SELECT DISTINCT a.id AS id, b.id AS earlier FROM p a JOIN p b ON a.word = b.word AND b.id < a.id
      AND 5 * least(a.n, b.n) >= 4 * greatest(a.n, b.n)),
g AS (SELECT DISTINCT k.id FROM k JOIN c a ON a.id = k.id JOIN c b ON b.id = k.earlier
      WHERE 9 * len(list_intersect(a.ws, b.ws)) >= 4 * (a.n + b.n)),
s AS (SELECT w.doc_id, w.line_no, w.line FROM w LEFT JOIN c ON w.ws = c.ws
      WHERE len(w.ws) = 0 OR (c.first = (w.doc_id, w.line_no) AND c.id NOT IN (SELECT id FROM g)))
SELECT d.doc_id, (SELECT len(string_split(coalesce(d.text, ''), chr(10)))) AS n_lines, count(s.line_no) AS n_kept,
       coalesce(string_agg(s.line, chr(10) ORDER BY s.line_no), '') AS text
FROM documents d LEFT JOIN s ON d.doc_id = s.doc_id GROUP BY d.doc_id, d.text"""

_A_TO_Z = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

LLM_ORACLE["op12_source_divergence"] = rf"""
WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  translate(coalesce(text, ''), {_A_TO_Z}) AS t FROM documents),
w AS (SELECT id, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
k AS (SELECT lang, term FROM w GROUP BY ALL HAVING count(DISTINCT id) >= 30),
v AS (SELECT lang, count(*) AS v FROM k GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS n FROM w JOIN k USING (lang, term) GROUP BY ALL),
cl AS (SELECT lang, term, sum(n) AS n FROM c GROUP BY ALL),
g AS (SELECT g.lang, g.source, coalesce(v.v, 0)::HUGEINT AS v, coalesce(x.n, 0)::HUGEINT AS n
      FROM (SELECT DISTINCT lang, source FROM d) g LEFT JOIN v USING (lang)
      LEFT JOIN (SELECT lang, source, sum(n) AS n FROM c GROUP BY ALL) x USING (lang, source)),
l AS (SELECT lang, sum(n)::HUGEINT AS n FROM cl GROUP BY lang),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
             1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (g.n + 5 * g.v) AS p
      FROM g JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)),
q AS (SELECT cl.lang, cl.term, 1 + (1000000000::HUGEINT * (cl.n + 5)) // (l.n + 5 * v.v) AS q
      FROM cl JOIN l USING (lang) JOIN v USING (lang)),
a AS (SELECT x.lang, x.source, 'pair' AS part, y.source AS item, coalesce(s.value, 0) AS value
      FROM g x JOIN g y ON x.lang = y.lang AND x.source <> y.source
      LEFT JOIN (SELECT p1.lang, p1.source, p2.source AS item, sum(abs(p1.p - p2.p)) AS value
                 FROM p p1 JOIN p p2 ON p1.lang = p2.lang AND p1.term = p2.term AND p1.source <> p2.source GROUP BY ALL) s
      ON s.lang = x.lang AND s.source = x.source AND s.item = y.source
      UNION ALL SELECT p.lang, p.source, 'term', p.term, p.p - q.q FROM p JOIN q USING (lang, term) WHERE p.n > 0 AND p.p > q.q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
       CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INT) AS rank
FROM a QUALIFY part = 'pair' OR rank <= 50"""

LLM_ORACLE["op13_collocations"] = rf"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), {_A_TO_Z}) AS t FROM documents),
s AS (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM s),
g AS (SELECT lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i:i + k - 1], ' '))) AS phrase
      FROM w, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(ws) >= k),
f AS (SELECT lang, k, phrase, count(*)::HUGEINT AS f FROM g GROUP BY ALL HAVING count(*) >= 30),
n AS (SELECT lang, sum(len(ws)) AS n FROM w GROUP BY lang),
c AS (SELECT lang, k AS size, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE k > 1),
u AS (SELECT lang, a, ws, unnest(list_filter([[1, 2], [2, 2], [3, 2], [1, 3], [2, 3]],
             lambda p: p[2] < len(ws) AND p[1] + p[2] - 1 <= len(ws))) AS sub FROM c),
i AS (SELECT lang, array_to_string(ws[sub[1]:sub[1] + sub[2] - 1], ' ') AS phrase, max(a) AS longest FROM u GROUP BY ALL),
e AS (SELECT c.* FROM c LEFT JOIN i USING (lang, phrase) WHERE longest IS NULL OR 100 * longest < 80 * a),
x AS (SELECT lang, phrase, a, ws, unnest(range(1, size)) AS k FROM e),
z AS (SELECT x.lang, x.phrase, x.a, x.k, l.f AS l, r.f AS r, (2000000 * x.a) // (l.f + r.f) AS score
      FROM x JOIN f l ON l.lang = x.lang AND l.phrase = array_to_string(ws[1:x.k], ' ')
      JOIN f r ON r.lang = x.lang AND r.phrase = array_to_string(ws[x.k + 1:], ' ')
      QUALIFY row_number() OVER (PARTITION BY x.lang, x.phrase ORDER BY (2000000 * x.a) // (l.f + r.f), x.k) = 1)
SELECT z.lang, row_number() OVER (PARTITION BY z.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase,
       CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n.n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM z JOIN n USING (lang) QUALIFY rank <= 2000"""
