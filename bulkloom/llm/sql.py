"""DuckDB SQL of the numbered queries."""

from __future__ import annotations

ORACLE_SQL: dict[str, str] = {}

ORACLE_SQL["op2_exact_dedup"] = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
  row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
"""

ORACLE_SQL["op6_mix"] = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size, md5(coalesce(text, '')) AS h FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, 2.0::DOUBLE * sum(size) AS cap,
  ([5.0, 2.0, 1.0])[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS w FROM d GROUP BY source),
r AS (SELECT *, cap / w AS filled, 1.5::DOUBLE * (sum(source_size) OVER ())::DOUBLE AS total,
  coalesce(sum(cap) OVER up, 0.0) AS below, sum(w) OVER () - coalesce(sum(w) OVER up, 0.0) AS above
  FROM s WINDOW up AS (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT *, least(cap, max(CASE WHEN (total - below) / above <= filled THEN (total - below) / above END) OVER () * w) AS target FROM r),
t AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate FROM l),
c AS (SELECT d.doc_id, d.size, t.source, t.source_size, t.target, t.rate, k,
  ('0x' || substr(md5(k || '|' || coalesce(d.doc_id::VARCHAR, 'null') || '|' || d.h), 1, 8))::BIGINT::DOUBLE / 4294967296.0 < t.rate - floor(t.rate) AS more
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source, generate_series(0, 15) g(k)),
m AS (SELECT source, k, row_number() OVER (PARTITION BY source ORDER BY abs(floor(any_value(rate)) * sum(size) + sum(CASE WHEN more THEN size ELSE 0 END) - any_value(target)), k) AS rn FROM c GROUP BY source, k)
SELECT c.doc_id, c.size, c.source_size, c.target, (c.size * (floor(c.rate)::BIGINT + CASE WHEN c.more THEN 1 ELSE 0 END))::BIGINT AS taken
FROM c JOIN m ON c.source IS NOT DISTINCT FROM m.source AND c.k = m.k WHERE m.rn = 1
"""

_SPANS = """SELECT doc_id, t, '{kind}' AS kind, {rank} AS rank, regexp_extract_all(t, '{re}') AS m, regexp_extract_all(t, '{re}', {group}) AS x, string_split_regex(t, '{re}') AS g, {least} AS least FROM d WHERE regexp_matches(t, '{re}')"""
_KINDS = [
    {"kind": "assign", "rank": 0, "group": 1, "least": 6, "re": r"""(?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""},
    {"kind": "access", "rank": 1, "group": 0, "least": 20, "re": "AKIA[A-Z0-9]+"},
    {"kind": "hex", "rank": 2, "group": 0, "least": 24, "re": "[0-9a-f]{24,}"},
    {"kind": "pem", "rank": 3, "group": 0, "least": 0, "re": "-----BEGIN [A-Z ]*PRIVATE KEY-----"},
    {"kind": "forge", "rank": 4, "group": 0, "least": 0, "re": "gh[pousr]_[A-Za-z0-9]{36,}"},
    {"kind": "chat", "rank": 5, "group": 0, "least": 0, "re": "xox[abprs]-[A-Za-z0-9-]{10,}"},
    {"kind": "cloud", "rank": 6, "group": 0, "least": 0, "re": "AIza[0-9A-Za-z_-]{35}"},
]
ORACLE_SQL["op5_secrets"] = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
f AS ({" UNION ALL ".join(_SPANS.format(**k) for k in _KINDS)}),
e AS (SELECT doc_id, kind, rank, m, x, g, least, unnest(generate_series(1, len(m))) AS i FROM f),
p AS (SELECT doc_id, kind, rank, length(x[i]) >= least AS good, list_sum(list_transform(g[1:i], lambda y: length(y)))::BIGINT + coalesce(list_sum(list_transform(m[1:i - 1], lambda y: length(y))), 0)::BIGINT AS s, length(m[i]) AS n FROM e),
a AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
  string_agg(kind || ':' || s || ':' || (s + n), ',' ORDER BY s, rank) AS spans, string_agg(kind || ':' || s || ':' || (s + n), ',' ORDER BY s, rank) FILTER (rank < 3) AS base FROM p WHERE good GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN a ON d.doc_id = a.doc_id
"""

ORACLE_SQL["op4_substring_dedup"] = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, unnest(generate_series(1, len(w) - 19)) AS i, w FROM d WHERE len(w) >= 20),
k AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 19], ' ')) AS h FROM s),
f AS (SELECT doc_id, i, row_number() OVER (PARTITION BY h ORDER BY doc_id, i) > 1 AS later FROM k),
g AS (SELECT DISTINCT doc_id, i + o AS i FROM f, generate_series(0, 19) x(o) WHERE later),
u AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d),
r AS (SELECT u.doc_id, count(*) AS n, count(g.i) AS gone, coalesce(string_agg(u.word, ' ' ORDER BY u.i) FILTER (g.i IS NULL), '') AS kept FROM u LEFT JOIN g ON u.doc_id = g.doc_id AND u.i = g.i GROUP BY u.doc_id)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_words, coalesce(gone, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN r ON d.doc_id = r.doc_id
"""

ORACLE_SQL["op10_embedding_dedup"] = """
WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e, label FROM embeddings WHERE label IS NOT NULL AND len(embedding) > 0
  AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
u AS (SELECT vec_id, e, label, list_dot_product(e, e) AS s FROM v),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id WHERE list_dot_product(a.e, b.e) / sqrt(a.s * b.s) >= 0.93),
r(a, c) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, l.b FROM r JOIN l ON r.c = l.a),
m AS (SELECT a, min(c) AS component_id FROM r GROUP BY a),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT m.a AS vec_id, coalesce(n.n, 0)::BIGINT AS n_links, m.component_id::BIGINT AS component_id, m.a = m.component_id AS kept FROM m LEFT JOIN n ON m.a = n.a
"""

ORACLE_SQL["op11_resample"] = r"""
WITH tb AS (SELECT list(c ORDER BY i) AS tab FROM (SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) r(i))),
dw AS (SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
bw AS (SELECT coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM benchmark),
df AS (SELECT doc_id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]), list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) AS f FROM dw),
bf AS (SELECT unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]), list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) AS f FROM bw),
fs AS (SELECT f, sum(s)::BIGINT AS s, sum(t)::BIGINT AS t FROM (SELECT f, count(*) AS s, 0 AS t FROM df GROUP BY f UNION ALL SELECT f, 0, count(*) FROM bf GROUP BY f) GROUP BY f),
fh AS (SELECT f, s, t, hex(encode(f)) AS h FROM fs),
fb AS (SELECT f, s, t, xor(list_reduce(list_prepend(4294967295, list_transform(range(len(h) // 2), lambda i: 16 * (instr('0123456789ABCDEF', h[2 * i + 1]) - 1) + instr('0123456789ABCDEF', h[2 * i + 2]) - 1)), lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS b FROM fh, tb),
tot AS (SELECT sum(s)::BIGINT AS ns, sum(t)::BIGINT AS nt FROM fs),
g AS (SELECT b, floor(1000 * ln(((sum(t) + 1)::DOUBLE * (any_value(ns) + 10000)) / ((sum(s) + 1)::DOUBLE * (any_value(nt) + 10000))))::BIGINT AS gain FROM fb, tot GROUP BY b),
wt AS (SELECT doc_id, count(*) AS n, sum(gain)::BIGINT AS weight FROM df JOIN fb USING (f) JOIN g USING (b) GROUP BY doc_id),
sc AS (SELECT dw.doc_id, coalesce(n, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight, len(w) >= 20 AS can,
  coalesce(weight, 0)::BIGINT + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || dw.doc_id), 1, 8))::BIGINT + 0.5)::DOUBLE / 4294967296.0)))::BIGINT AS score FROM dw LEFT JOIN wt USING (doc_id)),
rk AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r FROM sc WHERE can)
SELECT sc.doc_id, n_features, weight, score, CASE WHEN r <= 5 * (SELECT count(*) FROM rk) // 100 THEN r END AS rank FROM sc LEFT JOIN rk USING (doc_id)
"""

ORACLE_SQL["op12_lexical"] = r"""
WITH dt AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS term FROM documents),
it AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS term FROM benchmark),
dn AS (SELECT doc_id, count(*) AS n FROM dt GROUP BY doc_id),
al AS (SELECT count(*)::BIGINT AS nd, sum(n)::BIGINT AS l FROM dn),
dm AS (SELECT doc_id, 50 + (50 * n * nd) // l AS m FROM dn, al),
tf AS (SELECT doc_id, term, count(*) AS tf FROM dt WHERE term IN (SELECT term FROM it) GROUP BY doc_id, term),
w AS (SELECT term, floor(1000 * ln((2 * any_value(nd) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tf, al GROUP BY term),
sc AS (SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score FROM it JOIN tf USING (term) JOIN w USING (term) JOIN dm USING (doc_id) GROUP BY item_id, doc_id),
rk AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank FROM sc WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM rk WHERE rank <= 50
"""
