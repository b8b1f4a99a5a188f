"""DuckDB SQL for the queries of this package that SQL can express."""

from __future__ import annotations

from ledgerflow.llm import audit, chat, licenses, linededup, manifest

_BLANKS = "'[ \\t\\n\\x0B\\f\\r]+'"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP4 = f"""
WITH w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), {_BLANKS}), lambda x: x <> '') AS ws FROM documents),
win AS (
  SELECT doc_id, s, array_to_string(list_slice(ws, s, s + 49), ' ') AS body
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS s FROM w WHERE len(ws) >= 50)),
lost AS (
  SELECT doc_id, s FROM (SELECT doc_id, s, min(doc_id) OVER (PARTITION BY body) AS first_doc FROM win)
  WHERE first_doc < doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 50)) AS p FROM lost),
places AS (SELECT doc_id, unnest(range(1, len(ws) + 1)) AS p, unnest(ws) AS word FROM w),
kept AS (
  SELECT doc_id, count(*) AS n_kept, string_agg(word, ' ' ORDER BY p) AS body
  FROM places ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, len(ws) AS n_words, len(ws) - coalesce(n_kept, 0) AS n_removed, sha256(coalesce(body, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""

OP8 = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), {_BLANKS}),
                             lambda x: x <> '') AS ws FROM documents),
sh AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(ws, s, s + 4), ' ') AS g
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS s FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS size FROM sh GROUP BY doc_id),
pairs AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common FROM sh x JOIN sh y ON x.g = y.g AND x.doc_id <> y.doc_id
  GROUP BY 1, 2),
links AS (
  SELECT a, b FROM pairs JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b
  WHERE 100 * common >= 75 * (p.size + q.size - common)),
reach AS (
  SELECT doc_id AS id, doc_id AS other FROM documents
  UNION
  SELECT id, b FROM reach JOIN links ON other = a),
comp AS (SELECT id AS doc_id, min(other) AS component_id FROM reach GROUP BY id)
SELECT d.doc_id, coalesce(size, 0) AS n_shingles, component_id, component_id = d.doc_id AS kept
FROM documents d JOIN comp USING (doc_id) LEFT JOIN n USING (doc_id)
"""

OP9 = f"""
WITH l AS (
  SELECT doc_id, source, text, generate_subscripts(string_split(text, chr(10)), 1) AS i,
         unnest(string_split(text, chr(10))) AS line FROM documents WHERE text IS NOT NULL),
common AS (
  SELECT trim(line, ' ') AS line FROM l WHERE trim(line, ' ') <> '' GROUP BY 1
  HAVING count(DISTINCT source) >= {linededup.MIN_SITES} AND count(DISTINCT text) >= {linededup.MIN_SITES}),
marked AS (
  SELECT l.*, c.line IS NOT NULL AS is_common FROM l LEFT JOIN common c ON trim(l.line, ' ') = c.line),
per AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (is_common) AS hits,
         coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT is_common), '') AS rest
  FROM marked GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN hits > 0 THEN rest ELSE d.text END AS text,
       coalesce(n_lines, 0) AS n_lines, coalesce(hits, 0) AS n_removed
FROM documents d LEFT JOIN per USING (doc_id)
"""


def _op6() -> str:
    templates = ", ".join(f"({i}, '{n}', '{t}')" for i, (n, t) in enumerate(licenses.TEMPLATES))
    marker, term = licenses.MARKER, licenses.TERM
    return f"""
WITH files AS (
  SELECT doc_id, text, source || '/' || CASE WHEN doc_id % 1000 = 0 THEN '' ELSE
           (doc_id // 1000)::VARCHAR || '/' || (doc_id // 100)::VARCHAR || '/' END
         || CASE WHEN doc_id % 100 = 0 THEN 'LICENSE' ELSE doc_id::VARCHAR || '.txt' END AS path
  FROM documents),
headers AS (
  SELECT DISTINCT doc_id, line FROM (SELECT doc_id, trim(unnest(string_split(text, chr(10))), ' ') AS line FROM files)
  WHERE regexp_matches(line, '{marker}')),
t(no, license, line) AS (VALUES {templates}),
lw AS (
  SELECT line, term, count(*) AS tf FROM (
    SELECT line, unnest(regexp_extract_all(lower(line), '{term}')) AS term FROM (SELECT DISTINCT line FROM headers))
  GROUP BY 1, 2),
tw AS (
  SELECT no, license, term, count(*) AS tf FROM (
    SELECT no, license, unnest(regexp_extract_all(lower(line), '{term}')) AS term FROM t) GROUP BY 1, 2, 3),
df AS (SELECT term, count(*) AS df FROM (SELECT term FROM lw UNION ALL SELECT term FROM tw) GROUP BY 1),
idf AS (
  SELECT term, ln((1 + (SELECT count(DISTINCT line) FROM headers) + {len(licenses.TEMPLATES)})::DOUBLE / (1 + df)) + 1 AS idf
  FROM df),
a AS (SELECT line, term, tf * idf AS w FROM lw JOIN idf USING (term)),
b AS (SELECT no, license, term, tf * idf AS w FROM tw JOIN idf USING (term)),
cosine AS (
  SELECT x.line, license, round(dot / (la * lb), 6) AS score
  FROM (SELECT line, no, license, sum(a.w * b.w) AS dot FROM a JOIN b USING (term) GROUP BY 1, 2, 3) x
  JOIN (SELECT line, sqrt(sum(w * w)) AS la FROM a GROUP BY 1) y ON x.line = y.line
  JOIN (SELECT no, sqrt(sum(w * w)) AS lb FROM b GROUP BY 1) z ON x.no = z.no),
own AS (
  SELECT doc_id, license, score FROM headers JOIN cosine USING (line) WHERE score >= {licenses.MIN_COSINE}
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, license) = 1),
judged AS (
  SELECT f.doc_id, path, regexp_replace(path, '/?[^/]*$', '') AS dir, license, score FROM files f LEFT JOIN own USING (doc_id)),
dirs AS (
  SELECT dir, license, score FROM judged WHERE score IS NOT NULL AND regexp_extract(path, '[^/]*$') = 'LICENSE'
  QUALIFY row_number() OVER (PARTITION BY dir ORDER BY score DESC, license) = 1),
near AS (
  SELECT j.doc_id, d.license, d.score, d.dir FROM judged j JOIN dirs d
    ON j.score IS NULL AND (j.dir = d.dir OR starts_with(j.dir, d.dir || '/'))
  QUALIFY row_number() OVER (PARTITION BY j.doc_id ORDER BY length(d.dir) DESC) = 1)
SELECT j.doc_id, path, coalesce(j.license, n.license) AS license, coalesce(j.score, n.score) AS score,
       CASE WHEN j.score IS NOT NULL THEN 'header' WHEN n.score IS NOT NULL THEN 'inherited' ELSE 'none' END AS via,
       CASE WHEN j.score IS NOT NULL THEN path ELSE n.dir END AS found_in
FROM judged j LEFT JOIN near n USING (doc_id)
"""


def _field(column: str) -> str:
    return f"coalesce(strlen(CAST({column} AS VARCHAR))::VARCHAR || ':' || CAST({column} AS VARCHAR), '-')"


def _row_digest(text: str = "text") -> str:
    return "sha256(" + " || ".join(_field(text if c == "text" else c) for c in manifest.FIELDS) + ")"


# crc32 of a decimal number, bit by bit.
_CRC32 = """xor(4294967295, list_reduce(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT),
  lambda acc, byte: list_reduce([0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[],
    lambda r, z: xor(r >> 1, (r & 1) * 3988292384), xor(acc, byte)), 4294967295::BIGINT))"""


def _steps(nodes: str) -> str:
    """(tree, level, place, bef, aft): the joined hashes of a node's run on either side of it."""
    return f"""
  SELECT a.tree, a.level, a.place, coalesce(string_agg(b.h, '' ORDER BY b.place) FILTER (b.place < a.place), '') AS bef,
         coalesce(string_agg(b.h, '' ORDER BY b.place) FILTER (b.place > a.place), '') AS aft
  FROM {nodes} a JOIN {nodes} b ON a.tree = b.tree AND a.level = b.level AND a.place // 8 = b.place // 8
  WHERE a.n > 1 GROUP BY 1, 2, 3"""


def _climb(nodes: str) -> str:
    return f"""SELECT tree, level + 1, place // 8, (any_value(n) + 7) // 8, sha256(string_agg(h, '' ORDER BY place))
  FROM {nodes} WHERE n > 1 GROUP BY tree, level, place // 8"""


OP11 = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce('=' || lang, '') AS tree, {_row_digest()} AS leaf,
         CASE WHEN {_CRC32} % 3 = 0 THEN {_row_digest(f"translate(text, '{_UPPER}', '{_LOWER}')")} END AS presented
  FROM documents),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
         count(*) OVER (PARTITION BY tree) AS n FROM d),
nodes(tree, level, place, n, h) AS (SELECT tree, 0, place, n, leaf FROM leaves UNION ALL {_climb("nodes")}),
subroots AS (
  SELECT tree AS grp, level AS height, h, row_number() OVER (ORDER BY tree) - 1 AS place, count(*) OVER () AS n
  FROM nodes WHERE n = 1),
tops(tree, level, place, n, h) AS (SELECT '^', 0, place, n, h FROM subroots UNION ALL {_climb("tops")}),
top_steps AS ({_steps("tops")}),
steps AS (
  {_steps("nodes")}
  UNION ALL
  SELECT grp, height + t.level, 0, bef, aft FROM subroots s JOIN top_steps t ON t.place = s.place >> (3 * t.level)),
proofs AS (
  SELECT l.doc_id, l.leaf, l.tree, l.place, sha256(coalesce(string_agg(bef || aft, '' ORDER BY level), '')) AS proof_sha256
  FROM leaves l LEFT JOIN steps s ON s.tree = l.tree AND s.place = l.place >> (3 * s.level) GROUP BY ALL),
fold(tree, place, level, h) AS (
  SELECT tree, place, 0, coalesce(presented, leaf) FROM leaves
  UNION ALL
  SELECT f.tree, f.place, f.level + 1, sha256(bef || f.h || aft)
  FROM fold f JOIN steps s ON s.tree = f.tree AND s.level = f.level AND s.place = f.place >> (3 * f.level))
SELECT p.doc_id, p.leaf, r.h AS subroot, t.h AS root, p.proof_sha256, f.h AS folded_root, f.h = t.h AS verified
FROM proofs p JOIN subroots r ON r.grp = p.tree JOIN (SELECT h FROM tops WHERE n = 1) t ON true
JOIN (SELECT tree, place, arg_max(h, level) AS h FROM fold GROUP BY 1, 2) f ON f.tree = p.tree AND f.place = p.place
"""

OP12 = f"""
WITH letters AS (SELECT unnest(string_split('{audit.FILTERS}', '')) AS x),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
w AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
         list_filter(regexp_split_to_array(coalesce(text, ''), {_BLANKS}), lambda x: x <> '') AS ws FROM documents),
marks AS (
  SELECT doc_id, max(coalesce(quality, 0) = 1) AS good, max(coalesce(toxic, 0) = 1) AS toxic FROM labels GROUP BY 1),
bits AS (
  SELECT part, [len(ws) < 200, 100 * len(list_distinct(ws)) < 50 * len(ws),
                100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t), regexp_matches(t, '{audit.SYMBOLS}'),
                coalesce(min(w.doc_id) OVER (PARTITION BY t) < w.doc_id, false)] AS fails,
         coalesce(good, false) AS good, coalesce(toxic, false) AS toxic
  FROM w LEFT JOIN marks ON marks.doc_id = w.doc_id),
cells AS (SELECT part, fails, count(*) AS n, count_if(good) AS good, count_if(toxic) AS toxic FROM bits GROUP BY 1, 2),
judged AS (
  SELECT part, filter_order, n, good, toxic, len(list_filter(fails, lambda f: f)) AS n_fails,
         list_transform(string_split(filter_order, ''), lambda x: fails[instr('{audit.FILTERS}', x)]) AS f
  FROM cells, orders),
steps AS (
  SELECT *, unnest(range(1, 6)) AS step, coalesce(list_position(f, true), 6) AS hit FROM judged),
figures AS (
  SELECT part, filter_order, step, sum(CASE WHEN hit > step THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN hit = step THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN f[step] AND hit < step THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN f[step] AND n_fails = 1 THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN hit = step THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN hit = step THEN toxic ELSE 0 END) AS toxic_lost
  FROM steps GROUP BY 1, 2, 3)
SELECT part, filter_order, step::INTEGER AS step,
       kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails,
       good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, substr(filter_order, step::INTEGER, 1)))::BIGINT AS shapley
FROM figures
"""


def _escaped(column: str) -> str:
    return rf"regexp_replace({column}, '<(\\*)\|', '<\\\1|', 'g')"


_MARKS = len(chat.START) + len(chat.SEP) + len(chat.CLOSE)
OP13 = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{chat.CONTROL_TEXT}' UNION ALL SELECT -1, 1, 'assistant', '{chat.CONTROL_TEXT}'),
said AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS turns,
         coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '') AS loss,
         sum({_MARKS} + length({_escaped('role')}) + length({_escaped('text')}))::BIGINT AS formatted_chars
  FROM t GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
       formatted_chars
FROM said
"""


ORACLE_SQL = {
    "op4_substring_dedup": OP4,
    "op6_license_scan": _op6(),
    "op8_minhash_near_dedup": OP8,
    "op9_line_dedup": OP9,
    "op11_merkle_manifest": OP11,
    "op12_filter_audit": OP12,
    "op13_chat_formatting": OP13,
}
