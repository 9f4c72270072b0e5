"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

_WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS hx FROM pages),
m AS (SELECT hx, max(page_id) AS first FROM p GROUP BY hx),
b AS (
  SELECT p.*, m.first, array_to_string(list_transform(range(1, 41),
    lambda j: lpad(bin(instr('0123456789abcdef', substr(p.hx, j::INTEGER, 1)) - 1), 4, '0')), '') AS bits
  FROM p JOIN m USING (hx))
SELECT page_id, strlen(h)::BIGINT AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (1
         + 16 * substr(bits, (5 * i + 1)::INTEGER, 1)::INTEGER + 8 * substr(bits, (5 * i + 2)::INTEGER, 1)::INTEGER
         + 4 * substr(bits, (5 * i + 3)::INTEGER, 1)::INTEGER + 2 * substr(bits, (5 * i + 4)::INTEGER, 1)::INTEGER
         + substr(bits, (5 * i + 5)::INTEGER, 1)::INTEGER)::INTEGER, 1)), '') AS payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to, TRUE AS digest_ok
FROM b"""

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = f"regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
_TEXT = "coalesce(text, '')"

_DECONTAMINATION = f"""
WITH i AS (SELECT DISTINCT item_id, {_WORDS.format(_TEXT)} AS w FROM benchmark),
iw AS (SELECT item_id, least(13, len(w)) AS k, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS a
       FROM i WHERE len(w) > 0),
windows AS (SELECT DISTINCT item_id, k, array_to_string(w[a : a + k - 1], ' ') AS win FROM iw),
sizes AS (SELECT DISTINCT k FROM windows),
d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS.format(_TEXT)} AS w FROM documents),
dw AS (SELECT r, k, w, unnest(range(1, len(w) - k + 2)) AS a FROM d JOIN sizes ON len(w) >= k),
hits AS (SELECT x.r, x.a, x.k, windows.item_id
         FROM (SELECT r, a, k, array_to_string(w[a : a + k - 1], ' ') AS win FROM dw) x
         JOIN windows ON x.k = windows.k AND x.win = windows.win),
words AS (SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT r, unnest(range(a, a + k)) AS q FROM hits) GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS joined
          FROM (SELECT DISTINCT r, coalesce(item_id::VARCHAR, 'None') AS item FROM hits) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(joined, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)"""

_MIXING = """
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
                  md5(coalesce(doc_id::VARCHAR, '')) AS k FROM documents),
src AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1)::INTEGER] AS weight,
             3 * source_size AS most FROM src),
lv AS (SELECT *,
  ((SELECT sum(source_size) FROM w) - coalesce(sum(most) OVER q, 0))::DOUBLE
  / ((SELECT sum(weight) FROM w) - coalesce(sum(weight) OVER q, 0))::DOUBLE AS level
  FROM w WINDOW q AS (ORDER BY most::DOUBLE / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, source_size, least(most::DOUBLE, (SELECT max(level) FROM lv) * weight) AS target,
  ('0x' || substr(md5('mix' || coalesce('=' || source, '')), 1, 4))::INTEGER / 65536.0::DOUBLE AS shift FROM lv),
r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY
  length(bin(size)) * 8 + ((size >> greatest(length(bin(size)) - 4, 0)) & 7), k, size) - 1 AS rank FROM d),
x AS (SELECT r.*, source_size, target, shift, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate
  FROM r JOIN t ON r.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       ((floor((rank + 1) * rate + shift) - floor(rank * rate + shift)) * size)::BIGINT AS taken
FROM x"""

_TERMS = f"regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"

_FPTREE = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS.format(_TEXT)} AS w FROM documents),
n AS (SELECT r, doc_id, len(w)::BIGINT AS n FROM d WHERE len(w) > 0),
totals AS (SELECT count(*)::BIGINT AS docs, coalesce(sum(n), 0)::BIGINT AS len FROM n),
tf AS (SELECT r, t, count(*)::BIGINT AS tf FROM (SELECT r, unnest(w) AS t FROM d) GROUP BY r, t),
df AS (SELECT t, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS weight
       FROM tf, totals GROUP BY t),
m AS (SELECT r, doc_id, 100 - 75 + ((75 * n * docs) // len) AS m FROM n, totals),
i AS (SELECT q, item_id, t, count(*)::BIGINT AS times FROM (
        SELECT row_number() OVER () AS q, item_id, unnest({_TERMS.format(_TEXT)}) AS t FROM benchmark)
      GROUP BY q, item_id, t),
s AS (SELECT q, item_id, r, doc_id,
             sum(times * weight * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
      FROM i JOIN df USING (t) JOIN tf USING (t) JOIN m USING (r) GROUP BY q, item_id, r, doc_id),
o AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST) AS place FROM s WHERE score > 0)
SELECT item_id, place::INTEGER AS rank, doc_id, score FROM o WHERE place <= 10"""

_PIVOTS = """
WITH v AS (SELECT row_number() OVER () AS r, vec_id,
                  list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
           FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.r, q.vec_id AS query_id, x.vec_id, list_inner_product(q.v, x.v)::BIGINT AS score
      FROM v q JOIN v x ON q.r <> x.r AND q.vec_id % 50 = 0),
o AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id NULLS LAST) AS place FROM s)
SELECT query_id, place::INTEGER AS rank, vec_id, score FROM o WHERE place <= 5"""

_CRC_TABLE = """list_transform(range(256), lambda n: list_reduce(range(8), lambda c, k:
  CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n))"""
_RESAMPLING = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS.format(_TEXT)} AS w FROM documents),
dw AS (SELECT r, unnest(w) AS f FROM d),
bw AS (SELECT unnest({_WORDS.format(_TEXT)}) AS f FROM benchmark),
tab AS (SELECT {_CRC_TABLE} AS t),
f AS (SELECT DISTINCT f FROM (SELECT f FROM dw UNION ALL SELECT f FROM bw)),
b AS (SELECT f, xor(4294967295, list_reduce(
        list_transform(range(1, octet_length(encode(f)) + 1),
          lambda i: 16 * (instr('0123456789ABCDEF', substr(hex(encode(f)), (2 * i - 1)::INTEGER, 1)) - 1)
                    + instr('0123456789ABCDEF', substr(hex(encode(f)), (2 * i)::INTEGER, 1)) - 1),
        lambda c, x: xor(c >> 8, t[(xor(c & 255, x) + 1)::INTEGER]), 4294967295)) % 10000 AS bucket
      FROM f, tab),
s AS (SELECT bucket, count(*)::BIGINT AS s FROM dw JOIN b USING (f) GROUP BY bucket),
t AS (SELECT bucket, count(*)::BIGINT AS t FROM bw JOIN b USING (f) GROUP BY bucket),
g AS (SELECT x.bucket, floor(1000 * ln(
        ((coalesce(t, 0) + 1) * ((SELECT coalesce(sum(s), 0) FROM s)::BIGINT + 10000))::DOUBLE
        / ((coalesce(s, 0) + 1) * ((SELECT coalesce(sum(t), 0) FROM t)::BIGINT + 10000))::DOUBLE))::BIGINT AS gain
      FROM (SELECT DISTINCT bucket FROM b) x LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket)),
w AS (SELECT r, sum(gain)::BIGINT AS weight FROM dw JOIN b USING (f) JOIN g USING (bucket) GROUP BY r),
h AS (SELECT r, doc_id, len(w)::BIGINT AS n_features,
             list_reduce(list_transform(range(1, 9), lambda i:
               instr('0123456789abcdef', substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), i::INTEGER, 1)) - 1),
               lambda x, y: 16 * x + y)::BIGINT AS h FROM d),
x AS (SELECT r, doc_id, n_features, coalesce(weight, 0) AS weight,
             coalesce(weight, 0) + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
      FROM h LEFT JOIN w USING (r)),
p AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, n_features) AS place
      FROM x WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score,
       CASE WHEN place <= 10 * (SELECT count(*) FROM p) // 100 THEN place END AS rank
FROM x LEFT JOIN p USING (r)"""

ORACLES: dict[str, str] = {
    "op1_warc": _WARC,
    "op3_decontamination": _DECONTAMINATION,
    "op7_mixing": _MIXING,
    "op11_fptree": _FPTREE,
    "op12_pivots": _PIVOTS,
    "op13_resampling": _RESAMPLING,
}
