"""DuckDB SQL for the queries that SQL can express."""

OP3 = """
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents)
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY text) AS keep_id,
       count(*) OVER (PARTITION BY text) AS group_size,
       row_number() OVER (PARTITION BY text ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
       sha256(text) AS text_sha256
FROM t
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP5 = rf"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(list_slice(w, i, i + least(len(w), 10) - 1), ' ') AS g
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS i FROM b WHERE len(w) > 0)
),
lengths AS (SELECT DISTINCT n FROM windows),
grams AS (
  SELECT r, i, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS g
  FROM (SELECT r, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM d, lengths WHERE len(w) >= n)
),
hits AS (SELECT r, i, n, item_id FROM grams JOIN windows USING (n, g)),
words AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(generate_series(i, i + n - 1)) AS p FROM hits) GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT r, item_id FROM hits) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)
"""

OP6 = rf"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT r, array_to_string(list_slice(w, i, i + least(3, len(w)) - 1), ' ') AS g
  FROM (SELECT r, w, unnest(generate_series(1, greatest(len(w) - 2, 1))) AS i FROM d WHERE len(w) > 0)
),
sizes AS (SELECT r, count(*) AS n FROM shingles GROUP BY r),
common AS (SELECT a.r AS a, b.r AS b, count(*) AS c FROM shingles a JOIN shingles b ON a.g = b.g AND a.r <> b.r GROUP BY ALL),
links AS (SELECT o.a, o.b FROM common o JOIN sizes x ON x.r = o.a JOIN sizes y ON y.r = o.b WHERE 100 * o.c >= 90 * (x.n + y.n - o.c)),
reach AS (SELECT r, r AS s FROM d UNION SELECT reach.r, links.b FROM reach JOIN links ON links.a = reach.s)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id
FROM d LEFT JOIN sizes USING (r) JOIN (SELECT reach.r, min(o.doc_id) AS component_id FROM reach JOIN d o ON o.r = reach.s GROUP BY reach.r) USING (r)
"""

# crc32 of the decimal id, bit by bit; a run of period q is an island of positions whose
# three words equal those q words on (such an island is two positions shorter)
OP11 = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         CAST(list_reduce(
           list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
           lambda x, y: list_reduce(list_prepend(xor(x, y), [0, 0, 0, 0, 0, 0, 0, 0]), lambda v, z: xor(v >> 1, CAST(3988292384 AS BIGINT) * (v & 1)))
         ) AS BIGINT) AS c
  FROM documents
),
h AS (SELECT r, doc_id, w, len(w) AS n, xor(coalesce(c, 4294967295), 4294967295) AS h FROM d),
a AS (SELECT *, h // 10 AS g, CASE WHEN n > 0 THEN (h // 10) % n END AS a FROM h),
p AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM a),
t AS (
  SELECT r, doc_id, n,
         CASE WHEN h % 10 = 0 AND n > 0 THEN list_transform(generate_series(0, n - 1), lambda i: CASE WHEN i < a THEN w[i + 1] ELSE w[a + (i - a) % p + 1] END) ELSE w END AS w
  FROM p
),
grams AS (
  SELECT r, n, i, w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3] AS k
  FROM (SELECT r, n, w, unnest(generate_series(0, n - 3)) AS i FROM t WHERE n >= 6)
),
same AS (SELECT x.r, y.i - x.i AS q, x.i FROM grams x JOIN grams y ON x.r = y.r AND x.k = y.k AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
islands AS (
  SELECT r, q, min(i) AS s, count(*) + 2 + q AS l
  FROM (SELECT r, q, i, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS k FROM same) GROUP BY r, q, k
),
runs AS (SELECT r, s, l, min(q) AS q FROM islands WHERE l >= 6 AND l >= 4 * q GROUP BY r, s, l),
best AS (
  SELECT r, count(*) AS n_runs, string_agg(s || ',' || l || ',' || q || chr(10), '' ORDER BY s, q) AS txt FROM runs GROUP BY r
),
top AS (
  SELECT r, s, l, q FROM (
    SELECT x.r, x.s, x.l, x.q, row_number() OVER (PARTITION BY x.r ORDER BY CAST(x.l AS DOUBLE) / x.q DESC, x.s, x.q) AS k FROM runs x
  ) WHERE k = 1
),
gone AS (SELECT DISTINCT r, unnest(generate_series(s + q, s + l - 1)) AS i FROM runs),
drops AS (SELECT r, list(i) AS i FROM gone GROUP BY r),
words AS (SELECT t.r, unnest(t.w) AS w, unnest(generate_series(0, t.n - 1)) AS i FROM t SEMI JOIN drops USING (r)),
kept AS (SELECT r, string_agg(w, ' ' ORDER BY i) AS txt FROM words ANTI JOIN gone USING (r, i) GROUP BY r)
SELECT t.doc_id, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, CAST(s AS BIGINT) AS start, CAST(l AS BIGINT) AS length, CAST(q AS BIGINT) AS period,
       CAST(1000 * l // q AS BIGINT) AS exponent_milli, sha256(coalesce(best.txt, '')) AS runs_sha256,
       sha256(CASE WHEN top.r IS NULL THEN array_to_string(t.w, ' ') ELSE coalesce(kept.txt, '') END) AS collapsed_sha256
FROM t LEFT JOIN best USING (r) LEFT JOIN top USING (r) LEFT JOIN kept USING (r)
"""



def vector_codes_sql(rounds: int = 4, parts: int = 4, entries: int = 256) -> str:
    """Whole-number k-means: one pair of steps per round over (vector, part) rows."""
    near = """
a{i} AS (
  SELECT v, part, x, arg_min(entry, (d, entry)) AS entry, min(d) AS d
  FROM (SELECT p.v, p.part, p.x, c.entry, list_sum(list_transform(list_zip(p.x, c.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d FROM p JOIN c{i} c ON p.part = c.part)
  GROUP BY v, part, x
)"""
    move = """
m{i} AS (
  SELECT part, entry, list((s - ((s % n) + n) % n) // n ORDER BY k) AS x
  FROM (SELECT part, entry, k, CAST(sum(x[k]) AS BIGINT) AS s, count(*) AS n FROM a{i}, generate_series(1, (SELECT max(len(x)) FROM p)) AS g(k) GROUP BY ALL) GROUP BY part, entry
),
c{j} AS (SELECT c.part, c.entry, coalesce(m.x, c.x) AS x FROM c{i} c LEFT JOIN m{i} m ON c.part = m.part AND c.entry = m.entry)"""
    steps = ",".join(near.format(i=i) + "," + move.format(i=i, j=i + 1) for i in range(rounds))
    return f"""
WITH kept AS (
  SELECT row_number() OVER () AS v, vec_id, label, list_transform(embedding, lambda y: CAST(floor(CAST(y AS DOUBLE) * 1024) AS BIGINT)) AS x
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda y: y IS NULL OR NOT isfinite(y))) = 0
),
p AS (SELECT v, vec_id, k AS part, x[k * (len(x) // {parts}) + 1 : (k + 1) * (len(x) // {parts})] AS x FROM kept, generate_series(0, {parts - 1}) AS g(k)),
ranked AS (SELECT v, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept),
c0 AS (SELECT part, entry, x FROM p JOIN ranked USING (v) WHERE entry < {entries}),{steps},{near.format(i=rounds)},
coded AS (SELECT v, string_agg(printf('%02x', CAST(entry AS INTEGER)), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{rounds} GROUP BY v)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry)) FROM c{rounds}) AS codebooks_sha256
FROM kept JOIN coded USING (v)
"""


ORACLES = {"op3_exact_dedup": OP3, "op5_decontamination": OP5, "op6_jaccard_join": OP6, "op11_periodic_runs": OP11, "op13_vector_codes": vector_codes_sql()}
