"""Queries of this package, and SQL for those that SQL can express."""

from __future__ import annotations

from .bpe import op5_byte_bpe
from .decontaminate import op7_decontaminate
from .id_planes import op4_id_planes
from .lm import op2_ef_trie
from .ngram_join import op6_ngram_join
from .pii import op1_pii
from .quality import op3_quality
from .resample import op11_trie_resample
from .reshard import op12_flow_reshard
from .spelling import op13_wildcard_groups
from .syncmers import op10_syncmers
from .token_counts import op8_token_counts
from .warc import op9_warc

QUERIES = {f.__name__: f for f in (op1_pii, op2_ef_trie, op3_quality, op4_id_planes, op5_byte_bpe, op6_ngram_join, op7_decontaminate, op8_token_counts, op9_warc, op10_syncmers, op11_trie_resample, op12_flow_reshard, op13_wildcard_groups)}


def pipeline(spark, sf_dir: str):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES["pipeline"] = pipeline

_WORDS = r"list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '')"
_SHINGLES = "CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {n} THEN [array_to_string(w, ' ')] ELSE list_distinct(list_transform(range(1, len(w) - {n} + 2), lambda i: array_to_string(w[i:i + {n} - 1], ' '))) END"

#: The join's components by plain label propagation over all linking pairs.
_OP6 = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
s AS (SELECT doc_id, {_SHINGLES.format(n=3)} AS g FROM d),
n AS (SELECT doc_id, len(g) AS n_shingles FROM s),
e AS (SELECT doc_id, unnest(g) AS x FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM e a JOIN e b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n m ON m.doc_id = a JOIN n o ON o.doc_id = b WHERE 100 * c >= 90 * (m.n_shingles + o.n_shingles - c)),
r AS (SELECT doc_id AS a, doc_id AS c FROM d UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.c)
SELECT doc_id, CAST(n_shingles AS BIGINT) AS n_shingles, min(c) AS component_id FROM n JOIN r ON r.a = doc_id GROUP BY ALL
"""

_OP7 = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
i AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
s AS (SELECT doc_id, unnest({_SHINGLES.format(n=5)}) AS x FROM d),
t AS (SELECT item_id, {_SHINGLES.format(n=5)} AS g FROM i),
u AS (SELECT item_id, len(g) AS n, unnest(g) AS x FROM t)
SELECT doc_id, item_id, count(*) / n AS containment FROM s JOIN u USING (x) GROUP BY doc_id, item_id, n HAVING count(*) * 100 >= n * 80
"""

#: The table of CRC-32, a value for each byte; and the CRC of a text by its bytes.
_CRC_TABLE = "ct AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, [1, 2, 3, 4, 5, 6, 7, 8]), lambda s, k: CASE WHEN s % 2 = 1 THEN xor(s // 2, 3988292384) ELSE s // 2 END)) AS tab)"
_CRC = "xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(0, strlen({x}) // 2), lambda i: CAST('0x' || substr({x}, 2 * i + 1, 2) AS BIGINT))), lambda s, b: xor(s >> 8, tab[(xor(s, b) & 255) + 1])))"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_RUNS = "list_concat(w, list_transform(range(1, len(w)), lambda i: array_to_string(w[i:i + 1], ' ')), list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')))"
_FEATURES = rf"list_filter(regexp_split_to_array({_LOWER}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"

_OP11 = f"""
WITH {_CRC_TABLE},
d AS (SELECT doc_id, {_FEATURES} AS w FROM documents),
g AS (SELECT {_FEATURES} AS w FROM benchmark),
e AS (SELECT doc_id, x, count(*) AS n FROM (SELECT doc_id, unnest({_RUNS}) AS x FROM d) GROUP BY ALL),
h AS (SELECT x, count(*) AS n FROM (SELECT unnest({_RUNS}) AS x FROM g) GROUP BY ALL),
u AS (SELECT x, {_CRC.format(x="hx")} % 10000 AS b FROM (SELECT x, hex(encode(x)) AS hx FROM (SELECT x FROM e UNION SELECT x FROM h)) CROSS JOIN ct),
s AS (SELECT b, sum(n) AS n FROM e JOIN u USING (x) GROUP BY 1),
t AS (SELECT b, sum(n) AS n FROM h JOIN u USING (x) GROUP BY 1),
z AS (SELECT (SELECT coalesce(sum(n), 0) FROM s) AS sn, (SELECT coalesce(sum(n), 0) FROM t) AS tn),
k AS (SELECT s.b, floor(1000 * ln(CAST(coalesce(t.n, 0) + 1 AS DOUBLE) * CAST(sn + 10000 AS DOUBLE) / (CAST(s.n + 1 AS DOUBLE) * CAST(tn + 10000 AS DOUBLE)))) AS gain FROM s LEFT JOIN t ON t.b = s.b CROSS JOIN z),
v AS (SELECT doc_id, sum(n) AS n_features, sum(n * gain) AS weight FROM e JOIN u USING (x) JOIN k USING (b) GROUP BY 1),
r AS (SELECT doc_id, len(w) >= 20 AS fit, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
  coalesce(weight, 0) + floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('42:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS score FROM d LEFT JOIN v USING (doc_id)),
o AS (SELECT *, row_number() OVER (PARTITION BY fit ORDER BY score DESC, doc_id) AS place, count(*) FILTER (fit) OVER () AS total FROM r)
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, CAST(weight AS BIGINT) AS weight, CAST(score AS BIGINT) AS score, CASE WHEN fit AND place <= 5 * total // 100 THEN place END AS rank FROM o
"""

#: Near words meet on the text with a star at a place, and on the text without a letter.
_OP13 = f"""
WITH RECURSIVE {_CRC_TABLE},
o AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS k, unnest(regexp_extract_all({_LOWER}, '[A-Za-zÀ-ÿ]+')) AS x FROM documents),
c AS (SELECT k, x, count(*) AS n FROM o GROUP BY ALL),
h AS (SELECT x, n, {_CRC.format(x="hx")} AS h FROM (SELECT x, n, hex(encode(k || ':' || x)) AS hx FROM c) CROSS JOIN ct),
m AS (SELECT CASE WHEN h % 199 = 0 THEN substr(x, 1, h % length(x)) || substr(x, h % length(x) + 2) ELSE x END AS word, n FROM h),
v AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM m WHERE length(word) >= 6 GROUP BY 1 HAVING sum(n) >= 5),
p AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v),
st AS (SELECT word, n, substr(word, 1, i - 1) || '*' || substr(word, i + 1) AS g FROM p),
le AS (SELECT DISTINCT word, n, substr(word, 1, i - 1) || substr(word, i + 1) AS g FROM p),
nr AS (SELECT a.word, b.word AS other, b.n AS m FROM st a JOIN st b ON a.g = b.g AND a.word <> b.word
  UNION ALL SELECT le.word, v.word, v.n FROM le JOIN v ON v.word = le.g UNION ALL SELECT v.word, le.word, le.n FROM le JOIN v ON v.word = le.g),
bs AS (SELECT word, count(*) AS n_near, max(m) AS m FROM nr GROUP BY 1),
fo AS (SELECT bs.word, n_near, bs.m, min(other) AS other FROM bs JOIN nr ON nr.word = bs.word AND nr.m = bs.m GROUP BY ALL),
f AS (SELECT v.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 5 * n THEN other END AS form, CASE WHEN m >= 5 * n THEN m END AS form_n FROM v LEFT JOIN fo USING (word)),
w AS (SELECT word, word AS root FROM f WHERE form IS NULL UNION ALL SELECT f.word, w.root FROM f JOIN w ON f.form = w.word)
SELECT word, form, root, n, n_near, form_n FROM f JOIN w USING (word)
"""

ORACLE_SQL: dict[str, str] = {"op6_ngram_join": _OP6, "op7_decontaminate": _OP7, "op11_trie_resample": _OP11, "op13_wildcard_groups": _OP13}
