"""DuckDB SQL of the operators that SQL can express; see ``queries``."""
from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from .chat_format import CLOSE, NAMED, OPEN

LOWER = f"translate(text, '{ascii_uppercase}', '{ascii_lowercase}')"
_BLANK = r"[\x20\x09-\x0D]"

OP1 = rf"""
WITH doc AS (SELECT doc_id, coalesce(regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS ws FROM documents),
item AS (SELECT item_id, regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
cut AS (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 12, 1) + 1)) AS i FROM item WHERE len(ws) > 0),
win AS (SELECT DISTINCT item_id, array_to_string(ws[i:i+12], ' ') AS w, least(len(ws), 13) AS n FROM cut),
spot AS (SELECT doc_id, n, ws, unnest(range(1, len(ws) - n + 2)) AS i FROM doc, (SELECT DISTINCT n FROM win) WHERE len(ws) >= n),
hit AS (SELECT doc_id, item_id, i, win.n FROM (SELECT doc_id, i, n, array_to_string(ws[i:i+n-1], ' ') AS w FROM spot) s
        JOIN win ON win.w = s.w AND win.n = s.n),
word AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY 1),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
          FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM hit) GROUP BY 1)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * n_hit >= len(ws) AS contaminated
FROM doc LEFT JOIN word USING (doc_id) LEFT JOIN named USING (doc_id)
"""

OP3 = rf"""
WITH line AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS l, unnest(range(len(string_split(t, chr(10))))) AS i
              FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)),
keyed AS (SELECT doc_id, i, l, regexp_replace(regexp_replace(translate(l, '{ascii_uppercase}', '{ascii_lowercase}'),
          '^{_BLANK}+', ''), '{_BLANK}+$', '') AS k FROM line),
gone AS (SELECT k FROM keyed WHERE k <> '' GROUP BY k HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(gone.k)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(l, chr(10) ORDER BY i) FILTER (gone.k IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN gone USING (k) GROUP BY doc_id
"""

OP4 = rf"""
WITH doc AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws, string_split(text, chr(10)) AS ls FROM doc),
line AS (SELECT doc_id, source, unnest(ls) AS l FROM w),
own AS (SELECT doc_id, source, l, lower(trim(regexp_replace(l, '{_BLANK}+', ' ', 'g'))) AS k FROM line WHERE regexp_matches(l, '[^\x20\x09-\x0D]')),
bad AS (SELECT source, k FROM own GROUP BY ALL HAVING count(DISTINCT doc_id) > 50),
per AS (SELECT doc_id, count(*) - count(DISTINCT l) AS n_dup_lines,
        sum(len(regexp_replace(l, '{_BLANK}+', '', 'g'))) FILTER (bad.k IS NOT NULL) AS dropped
        FROM own LEFT JOIN bad ON own.k = bad.k AND own.source IS NOT DISTINCT FROM bad.source GROUP BY 1),
win AS (SELECT doc_id, i, array_to_string(ws[i:i+4], chr(10)) AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM w WHERE len(ws) >= 5)),
rep AS (SELECT doc_id, i FROM win WHERE (doc_id, g) IN (SELECT (doc_id, g) FROM win GROUP BY doc_id, g HAVING count(*) > 1)),
cov AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM rep) GROUP BY 1),
base AS (SELECT doc_id, len(ws)::BIGINT AS n_words, len(array_to_string(ws, ''))::BIGINT AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
         coalesce(cov.n, 0)::BIGINT AS n_repeat_words, coalesce(dropped, 0)::BIGINT AS dropped_chars
         FROM w LEFT JOIN per USING (doc_id) LEFT JOIN cov USING (doc_id))
SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND word_chars - dropped_chars >= 0.5 * word_chars AS kept
FROM base
"""

OP6 = rf"""
WITH RECURSIVE doc AS (SELECT doc_id, coalesce(regexp_extract_all({LOWER}, '[^\x20\x09-\x0D]+'), []) AS ws FROM documents),
sh AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i+2], ' ') AS s
       FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 2, 1) + 1)) AS i FROM doc WHERE len(ws) > 0)),
size AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY 1),
meet AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM sh a JOIN sh b USING (s) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
link AS (SELECT a, b FROM meet JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b WHERE 100 * k >= 90 * (x.n + y.n - k)),
reach(a, b) AS (SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON l.a = r.b),
least AS (SELECT a AS doc_id, min(b) AS c FROM reach GROUP BY 1)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(doc_id, coalesce(c, doc_id)) AS component_id
FROM doc LEFT JOIN size USING (doc_id) LEFT JOIN least USING (doc_id)
"""


def _sql(text: str) -> str:
    return "'" + text.replace("'", "''").replace("\n", "' || chr(10) || '") + "'"


def _escaped(col: str) -> str:
    return rf"replace(replace(replace({col}, '\', '\\'), '#', '\#'), '</', '<\/')"


OP8 = rf"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')),
e AS (SELECT *, len({_sql(OPEN)}) + len({_sql(NAMED)}) + len({_sql(CLOSE)}) + len({_escaped('text')})
      + len(replace(replace({_escaped('role')}, ':', '\:'), chr(10), '\' || chr(10))) AS n FROM c)
SELECT conv_id, count(*)::BIGINT AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       len(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), ''))::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(n)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""


def _op10(bits: int = 5, shards: int = 40) -> str:
    """The same curve, written as one subquery for each step."""
    q = rf"""
WITH tbl AS (SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce([i::BIGINT, 0, 0, 0, 0, 0, 0, 0, 0],
             lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS c FROM range(256) r(i))),
d AS (SELECT doc_id, strlen(coalesce(text, '')) + 16 AS size, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
      md5(coalesce(doc_id::VARCHAR, '')) AS tie, hex(encode(coalesce(text, ''))) AS hx FROM documents),
crc AS (SELECT d.* EXCLUDE (hx), xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(strlen(hx) // 2),
        lambda i: ((instr('0123456789ABCDEF', hx[2*i+1]) - 1) * 16 + instr('0123456789ABCDEF', hx[2*i+2]) - 1)::BIGINT)),
        lambda a, b: xor(a >> 8, t[xor(a & 255, b) + 1]))) AS text_crc32 FROM d, tbl),
p AS (SELECT doc_id, size, text_crc32, tie, ('0x' || md5(lang)[1:2])::INT & {(1 << bits) - 1} AS x0, ('0x' || md5(source)[1:2])::INT & {(1 << bits) - 1} AS x1,
      least(2 * (len(bin(size)) - 5) + ((size >> (len(bin(size)) - 2)) & 1), {(1 << bits) - 1})::INT AS x2 FROM crc)"""
    last = "p"
    for k in range(bits - 1, 0, -1):
        for i in range(3):
            name, mask = f"s{k}{i}", (1 << k) - 1
            keep = ", ".join(f"x{j}" for j in range(1, 3) if j != i)
            own = f", CASE WHEN x{i} & {1 << k} <> 0 THEN x{i} ELSE xor(x{i}, xor(x0, x{i}) & {mask}) END AS x{i}" if i else ""
            q += (f",\n{name} AS (SELECT doc_id, size, text_crc32, tie, CASE WHEN x{i} & {1 << k} <> 0 THEN xor(x0, {mask}) "
                  f"ELSE xor(x0, xor(x0, x{i}) & {mask}) END AS x0, {keep}{own} FROM {last})")
            last = name
    turn = "0"
    for k in range(bits - 1, 0, -1):
        turn = f"xor({turn}, CASE WHEN x2 & {1 << k} <> 0 THEN {(1 << k) - 1} ELSE 0 END)"
    code = " + ".join(f"(((x{i} >> {k}) & 1)::BIGINT << {3 * k + 2 - i})" for k in range(bits) for i in range(3))
    return q + f""",
g1 AS (SELECT * REPLACE (xor(x1, x0) AS x1) FROM {last}), g2 AS (SELECT * REPLACE (xor(x2, x1) AS x2) FROM g1),
g3 AS (SELECT *, {turn} AS t FROM g2), g4 AS (SELECT * REPLACE (xor(x0, t) AS x0, xor(x1, t) AS x1, xor(x2, t) AS x2) FROM g3),
r AS (SELECT *, row_number() OVER (ORDER BY {code}, tie, doc_id, text_crc32, size) - 1 AS pos, count(*) OVER () // {shards} AS k, count(*) OVER () % {shards} AS m FROM g4)
SELECT doc_id, size::BIGINT AS size, text_crc32, 'rows' AS law,
       (CASE WHEN pos < m * (k + 1) THEN pos // (k + 1) ELSE m + (pos - m * (k + 1)) // greatest(k, 1) END)::INT AS shard,
       (CASE WHEN pos < m * (k + 1) THEN pos % (k + 1) ELSE (pos - m * (k + 1)) % greatest(k, 1) END)::BIGINT AS slot, NULL::INT AS grown_shard
FROM r"""


OP11 = rf"""
WITH doc AS (SELECT doc_id, regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM documents WHERE text IS NOT NULL),
item AS (SELECT DISTINCT item_id, unnest(regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark),
total AS (SELECT count(*)::HUGEINT AS docs, sum(len(ws))::HUGEINT AS terms FROM doc WHERE len(ws) > 0),
tf AS (SELECT doc_id, t, count(*)::HUGEINT AS tf FROM (SELECT doc_id, unnest(ws) AS t FROM doc) GROUP BY ALL),
w AS (SELECT t, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM tf, total GROUP BY t),
size AS (SELECT doc_id, 10 + (90 * len(ws)::HUGEINT * docs) // terms AS m FROM doc, total),
score AS (SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
          FROM item JOIN tf USING (t) JOIN w USING (t) JOIN size USING (doc_id) GROUP BY ALL)
SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INT AS rank, doc_id, score
FROM score WHERE score > 0 QUALIFY rank <= 10
"""

OP12 = """
WITH vec AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
             list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
             WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
dim AS (SELECT vec_id, label, unnest(v) AS x, unnest(range(len(v))) AS d FROM vec),
score AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, sum(a.x * b.x)::BIGINT AS s
          FROM dim a JOIN dim b USING (d) WHERE a.vec_id % 100 = 0 GROUP BY a.vec_id, a.label, b.vec_id, b.label),
pos AS (SELECT anchor_id, other AS positive_id, s AS positive_score FROM score WHERE same AND other <> anchor_id
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY s DESC, other) <= 5)
SELECT anchor_id, positive_id, (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s DESC, other))::INT AS rank,
       other AS negative_id, positive_score, s AS negative_score
FROM pos JOIN score USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * s AND 100 * s <= 90 * positive_score
QUALIFY rank <= 10
"""


ORACLE = {"op1_decontamination": OP1, "op3_line_dedup": OP3, "op4_quality_rules": OP4, "op6_ngram_join": OP6,
          "op8_chat_format": OP8, "op10_sharding": _op10(), "op11_lexical_search": OP11, "op12_hard_negatives": OP12}
