"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from quire.llm.secrets import BASE, RULES


def _kind(i: int) -> str:
    r = RULES[i]
    p = r.pattern.replace("'", "''")
    return (
        f"SELECT doc_id, '{r.kind}' AS kind, {i} AS rank, {r.least} AS least, regexp_extract_all(t, '{p}') AS ms, "
        f"regexp_extract_all(t, '{p}', {r.group}) AS gs, string_split_regex(t, '{p}') AS ps FROM d WHERE regexp_matches(t, '{p}')"
    )


OP8 = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
k AS ({' UNION ALL '.join(map(_kind, range(len(RULES))))}),
u AS (SELECT doc_id, kind, rank, least, unnest(ms) AS m, unnest(gs) AS g, unnest(ps[1:len(ms)]) AS p, generate_subscripts(ms, 1) AS i FROM k),
s AS (SELECT doc_id, kind, rank, least, g, m, CAST(sum(length(p) + length(m)) OVER (PARTITION BY doc_id, kind ORDER BY i) AS BIGINT) AS e FROM u),
f AS (SELECT doc_id, kind, rank, e - length(m) AS b, kind || ':' || (e - length(m)) || ':' || e AS said FROM s WHERE length(g) >= least)
SELECT d.doc_id, {', '.join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in BASE)},
 sha256(coalesce(string_agg(said, ',' ORDER BY b, rank) FILTER (rank < {len(BASE)}), '')) AS base_sha256, coalesce(string_agg(said, ',' ORDER BY b, rank), '') AS spans
FROM d LEFT JOIN f ON d.doc_id = f.doc_id GROUP BY d.doc_id"""

OP2 = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
w AS (SELECT doc_id, unnest(generate_series(1, len(ws) - 19)) AS p, ws FROM d WHERE len(ws) >= 20),
k AS (SELECT doc_id, p, array_to_string(ws[p:p + 19], ' ') AS key FROM w),
x AS (SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY key ORDER BY doc_id, p) AS n FROM k) WHERE n > 1),
c AS (SELECT DISTINCT doc_id, p + j AS i FROM x, (SELECT unnest(generate_series(0, 19)) AS j)),
a AS (SELECT d.doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM d),
r AS (SELECT a.doc_id, a.i, a.word, c.i IS NOT NULL AS gone FROM a LEFT JOIN c ON a.doc_id = c.doc_id AND a.i = c.i)
SELECT d.doc_id, CAST(len(d.ws) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN (SELECT doc_id, count(*) FILTER (gone) AS n, string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS kept FROM r GROUP BY doc_id) g ON d.doc_id = g.doc_id"""

#: Bytes are handled as pairs of hexadecimal digits.
OP3 = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, h, unnest(generate_series(0, length(h) // 2 - 100)) AS p FROM d WHERE length(h) >= 200),
x AS (SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY key ORDER BY doc_id, p) AS n FROM (SELECT doc_id, p, substr(h, 2 * p + 1, 200) AS key FROM w)) WHERE n > 1),
g AS (SELECT doc_id, p, CASE WHEN p > lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 100 THEN 1 WHEN lag(p) OVER (PARTITION BY doc_id ORDER BY p) IS NULL THEN 1 ELSE 0 END AS head FROM x),
r AS (SELECT doc_id, run, min(p) AS b, max(p) + 100 AS e FROM (SELECT doc_id, p, sum(head) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM g) GROUP BY doc_id, run),
n AS (SELECT r.doc_id, r.b, r.e, coalesce(lag(r.e) OVER (PARTITION BY r.doc_id ORDER BY r.b), 0) AS a FROM r),
k AS (SELECT n.doc_id, CAST(sum(e - b) AS BIGINT) AS n_removed, count(*) AS n_spans, string_agg(substr(h, 2 * a + 1, 2 * (b - a)), '' ORDER BY b) AS head, max(e) AS last FROM n JOIN d ON d.doc_id = n.doc_id GROUP BY n.doc_id)
SELECT d.doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(from_hex(CASE WHEN k.doc_id IS NULL THEN h ELSE head || substr(h, 2 * last + 1) END)) AS kept_sha256
FROM d LEFT JOIN k ON d.doc_id = k.doc_id"""

#: Integer components as doubles, whose products and sums are exact below 2**53.
WHOLE = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"

OP11 = f"""
WITH v AS (SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x FROM embeddings WHERE vec_id IS NOT NULL AND {WHOLE}),
s AS (SELECT q.vec_id AS query_id, v.vec_id, list_inner_product(q.x, v.x)::BIGINT AS score FROM v AS q JOIN v ON q.vec_id <> v.vec_id AND len(q.x) = len(v.x) WHERE q.vec_id % 50 = 0)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5"""


def _round(i: int) -> str:
    """Round i of the codebooks: every part's nearest entry, then floored means; an unused entry stays."""
    return f"""
a{i} AS MATERIALIZED (SELECT w.n, w.p, arg_min(b.e, (w.s - 2 * list_inner_product(w.x, b.x) + b.s, b.e)) AS e, min(w.s - 2 * list_inner_product(w.x, b.x) + b.s)::BIGINT AS d
 FROM w JOIN b{i} AS b ON w.p = b.p GROUP BY w.n, w.p),
m{i} AS (SELECT p, e, list((CASE WHEN t % c < 0 THEN t // c - 1 ELSE t // c END)::DOUBLE ORDER BY pos) AS x FROM
 (SELECT p, e, pos, sum(v)::BIGINT AS t, count(*) AS c FROM (SELECT a.p, a.e, unnest(w.x)::BIGINT AS v, generate_subscripts(w.x, 1) AS pos FROM a{i} AS a JOIN w ON a.n = w.n AND a.p = w.p) GROUP BY p, e, pos) GROUP BY p, e),
b{i + 1} AS MATERIALIZED (SELECT p, e, x, list_inner_product(x, x) AS s FROM (SELECT b.p, b.e, coalesce(m.x, b.x) AS x FROM b{i} AS b LEFT JOIN m{i} AS m ON b.p = m.p AND b.e = m.e))"""


OP12 = f"""
WITH v AS (SELECT row_number() OVER (ORDER BY vec_id) AS n, vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS x FROM embeddings WHERE {WHOLE}),
w AS MATERIALIZED (SELECT n, p, x, list_inner_product(x, x) AS s FROM (SELECT n, p, x[p * (len(x) // 4) + 1:(p + 1) * (len(x) // 4)] AS x FROM v, (SELECT unnest(range(4)) AS p))),
b0 AS MATERIALIZED (SELECT p, n - 1 AS e, x, s FROM w WHERE n <= 256),{",".join(map(_round, range(4)))},
z AS (SELECT w.n, w.p, arg_min(b.e, (w.s - 2 * list_inner_product(w.x, b.x) + b.s, b.e)) AS e, min(w.s - 2 * list_inner_product(w.x, b.x) + b.s)::BIGINT AS d
 FROM w JOIN b4 AS b ON w.p = b.p GROUP BY w.n, w.p),
c AS (SELECT n, string_agg(printf('%02x', e::INTEGER), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM z GROUP BY n),
h AS (SELECT sha256(string_agg(t, ',' ORDER BY p, e)) AS codebooks_sha256 FROM (SELECT p, e, array_to_string(list_transform(x, lambda y: y::BIGINT::VARCHAR), ',') AS t FROM b4))
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM v JOIN c ON v.n = c.n, h"""

#: CRC-32 by single bits: the polynomial, reflected.
CRC = "xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(range(0, length(h), 2), lambda i: list_transform(range(8), lambda j: (('0x' || substr(h, i + 1, 2))::BIGINT >> j) & 1)))), lambda a, b: xor(a >> 1, 3988292384 * (xor(a, b) & 1))), 4294967295)"
WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP13 = f"""
WITH d AS (SELECT 0 AS side, row_number() OVER () AS n, doc_id, {WORDS} AS ws FROM documents UNION ALL SELECT 1, item_id, NULL, {WORDS} FROM benchmark),
f AS MATERIALIZED (SELECT side, n, unnest(list_concat(ws, list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]))) AS f FROM d),
k AS MATERIALIZED (SELECT f, ({CRC}) % 10000 AS b FROM (SELECT DISTINCT f, hex(encode(f)) AS h FROM f)),
c AS MATERIALIZED (SELECT side, n, b, count(*) AS c FROM f JOIN k ON f.f = k.f GROUP BY side, n, b),
t AS (SELECT b, coalesce(sum(c) FILTER (side = 0), 0)::BIGINT AS s, coalesce(sum(c) FILTER (side = 1), 0)::BIGINT AS t FROM c GROUP BY b),
g AS (SELECT b, floor(1000 * ln((t + 1)::DOUBLE * ((SELECT sum(s) FROM t) + 10000)::DOUBLE / ((s + 1)::DOUBLE * ((SELECT sum(t) FROM t) + 10000)::DOUBLE)))::BIGINT AS gain FROM t),
w AS (SELECT n, sum(c)::BIGINT AS m, floor(sum(c * gain)::DOUBLE / sum(c))::BIGINT AS weight FROM c JOIN g ON c.b = g.b WHERE side = 0 GROUP BY n),
r AS (SELECT doc_id, len(ws) >= 20 AS fit, coalesce(m, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
 FROM d LEFT JOIN w ON d.n = w.n WHERE side = 0),
o AS (SELECT *, row_number() OVER (PARTITION BY fit ORDER BY score DESC, doc_id) AS place FROM r)
SELECT doc_id, n_features, weight, score, CASE WHEN fit AND place <= 25 * (SELECT count(*) FROM r WHERE fit) // 100 THEN place END AS rank FROM o"""

SQL = {
    "op2_substring_dedup": OP2,
    "op3_suffix_array_dedup": OP3,
    "op8_secret_scans": OP8,
    "op11_ball_tree_search": OP11,
    "op12_exponion_codes": OP12,
    "op13_crc_ring_resampling": OP13,
}
