"""DuckDB SQL for the operators that SQL can express, written from their contracts.

Strings that must agree are compared whole (op3, op4) or by md5 (op1, whose
200-byte strings are many); nothing here knows of triggers, signatures or tiles.
"""

from __future__ import annotations

_WORDS = r"'[^\x20\x09-\x0D]+'"

#: Bytes as pairs of hex digits, dealt in stretches of 256 that overlap by a string's length, as a slice costs its offset.
OP1 = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
part AS (SELECT doc_id, k, substr(x, 512 * k + 1, 512 + 398) AS p FROM (SELECT doc_id, x, unnest(range(0, (length(x) + 511) // 512)) AS k FROM d)),
byte AS (SELECT doc_id, 256 * k + i AS pos, substr(p, 2 * i + 1, 2) AS b, CASE WHEN length(p) >= 2 * i + 400 THEN md5(substr(p, 2 * i + 1, 400)) END AS h FROM (SELECT doc_id, k, p, unnest(range(0, least(256, length(p) // 2))) AS i FROM part)),
twice AS (SELECT h FROM byte WHERE h IS NOT NULL GROUP BY h HAVING count(*) > 1),
cut AS (SELECT doc_id, pos, b, coalesce(max(CASE WHEN t.h IS NOT NULL THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 199 PRECEDING AND CURRENT ROW), 0) AS gone FROM byte LEFT JOIN twice t USING (h)),
run AS (SELECT *, CASE WHEN gone = 1 AND coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY pos), 0) = 0 THEN 1 ELSE 0 END AS opens FROM cut),
s AS (SELECT doc_id, sum(gone) AS g, sum(opens) AS o, string_agg(b, '' ORDER BY pos) FILTER (gone = 0) AS kept FROM run GROUP BY doc_id)
SELECT doc_id, CAST(length(x) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(g, 0) AS BIGINT) AS n_removed, CAST(coalesce(o, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256 FROM d LEFT JOIN s USING (doc_id)
"""

OP3 = f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), {_WORDS}) AS words FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) >= 5 THEN [array_to_string(words[i:i + 4], ' ') for i in range(1, len(words) - 3)] WHEN len(words) > 0 THEN [array_to_string(words, ' ')] ELSE [] END) AS shingle FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL),
link AS (SELECT x, y FROM shared JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 85 * (a.n + b.n - c)),
edge AS (SELECT x, y FROM link UNION ALL SELECT y, x FROM link),
reach AS (SELECT doc_id AS x, doc_id AS y FROM w UNION SELECT r.x, e.y FROM reach r JOIN edge e ON r.y = e.x),
least AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x)
SELECT doc_id, coalesce(n.n, 0) AS n_shingles, component_id, doc_id = component_id AS kept FROM w JOIN least ON x = doc_id LEFT JOIN n USING (doc_id)
"""

OP4 = f"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {_WORDS}) AS words FROM documents),
t AS (SELECT doc_id, unnest(range(1, len(words) + 1)) AS i, unnest(words) AS word, unnest([CASE WHEN i + 49 <= len(words) THEN array_to_string(words[i:i + 49], ' ') END for i in range(1, len(words) + 1)]) AS win FROM w),
f AS (SELECT win, min(doc_id) AS first FROM t WHERE win IS NOT NULL GROUP BY win HAVING min(doc_id) < max(doc_id)),
cut AS (SELECT t.doc_id, i, word, max(CASE WHEN f.first < t.doc_id THEN 1 ELSE 0 END) OVER (PARTITION BY t.doc_id ORDER BY i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone FROM t LEFT JOIN f USING (win)),
s AS (SELECT doc_id, count(*) AS n, sum(gone) AS g, string_agg(word, ' ' ORDER BY i) FILTER (gone = 0) AS kept FROM cut GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_words, CAST(coalesce(g, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM w LEFT JOIN s USING (doc_id)
"""

#: Sums go from the first component on, in double precision, as the contract's measure does.
OP6 = """
WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
u AS (SELECT * FROM v WHERE len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
p AS (SELECT q.vec_id AS query_id, c.vec_id, list_reduce(list_prepend(CAST(0 AS DOUBLE), [q.e[i] * c.e[i] for i in range(1, len(q.e) + 1)]), lambda a, x: a + x) AS score FROM u q JOIN u c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 20 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p) WHERE rank <= 20
"""

OP8 = r"""
WITH c AS (
SELECT 0 AS own, conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
UNION ALL SELECT 1, -1, turn, role, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) v(turn, role)),
e AS (SELECT *, '<|' || replace(replace(replace(replace(role, '\', '\\'), '<', '<\'), '[', '[\'), '|', '|\') || '|>' || chr(10) || replace(replace(replace(text, '\', '\\'), '<', '<\'), '[', '[\') || '<|end|>' || chr(10) AS shown FROM c)
SELECT CAST(conv_id AS BIGINT) AS conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars, sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
CAST(sum(length(shown)) AS BIGINT) AS formatted_chars, false AS rewrites_history FROM e GROUP BY own, conv_id
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_suffix_array": OP1, "op3_near_duplicates": OP3, "op4_substrings": OP4, "op6_nearest_neighbours": OP6, "op8_chat_format": OP8}
