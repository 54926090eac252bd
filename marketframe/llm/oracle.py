"""DuckDB SQL for the training-data queries that SQL can express."""

from __future__ import annotations

from marketframe.llm import licenses

TOP_K = """
WITH p AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(CAST(x AS DOUBLE) * 256)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM p q JOIN p c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
         vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

NEAR_GROUPS = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                              'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
    ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s
  FROM w),
n AS (SELECT doc_id, CAST(len(s) AS BIGINT) AS n FROM s),
e AS (SELECT doc_id, unnest(s) AS x FROM s),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM e a JOIN e b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS (
  SELECT a, b FROM common JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
  WHERE 100 * c >= 80 * (na.n + nb.n - c)),
reach AS (
  SELECT doc_id AS node, doc_id AS seen FROM n
  UNION SELECT r.node, l.b FROM reach r JOIN link l ON l.a = r.seen)
SELECT n.doc_id, n.n AS n_shingles, min(r.seen) AS component_id, n.doc_id = min(r.seen) AS kept
FROM n JOIN reach r ON r.node = n.doc_id GROUP BY n.doc_id, n.n
"""


MIX = r"""
WITH d AS (
  SELECT doc_id, source,
    CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents),
r AS (
  SELECT *, length(bin(size)) AS cls,
    (CAST(CAST('0x' || substr(md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 13) AS BIGINT) AS DOUBLE)
     + CAST(0.5 AS DOUBLE)) / CAST(4503599627370496 AS DOUBLE) AS u
  FROM d),
st AS (SELECT source, cls, CAST(sum(size) AS BIGINT) AS words FROM r GROUP BY source, cls),
sz AS (
  SELECT source, CAST(sum(words) AS BIGINT) AS source_size,
    row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rk
  FROM st GROUP BY source),
t1 AS (
  SELECT *, CAST([5, 2, 1][rk % 3 + 1] AS DOUBLE) AS w, source_size * 3 AS ceiling,
    CAST(sum(source_size) OVER () AS DOUBLE) AS total FROM sz),
t2 AS (SELECT *, ceiling / w AS per_weight FROM t1),
t3 AS (
  SELECT *,
    sum(w) OVER () - coalesce(sum(w) OVER earlier, 0) AS w_left,
    total - CAST(coalesce(sum(ceiling) OVER earlier, 0) AS DOUBLE) AS rest
  FROM t2 WINDOW earlier AS (ORDER BY per_weight, rk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t4 AS (SELECT *, rest / w_left >= per_weight AS capped FROM t3),
share AS (SELECT arg_min(rest / w_left, (per_weight, rk)) AS share FROM t4 WHERE NOT capped),
goal AS (
  SELECT source, source_size, CASE WHEN capped THEN CAST(ceiling AS DOUBLE) ELSE share * w END AS target
  FROM t4 LEFT JOIN share ON TRUE),
s1 AS (
  SELECT st.source, cls, words, target, CAST(cls + 4 AS DOUBLE) AS g
  FROM st JOIN goal ON st.source IS NOT DISTINCT FROM goal.source),
s2 AS (
  SELECT *, target - 3 * CAST(coalesce(sum(words) OVER (longer ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE) AS rest,
    sum(g * words) OVER (longer ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS mass
  FROM s1 WINDOW longer AS (PARTITION BY source ORDER BY cls DESC)),
s3 AS (SELECT *, coalesce(rest / NULLIF(mass, 0) * g >= 3, TRUE) AS capped FROM s2),
scale AS (SELECT source, arg_max(rest / mass, cls) AS scale FROM s3 WHERE NOT capped GROUP BY source),
s4 AS (
  SELECT s3.*, CASE WHEN capped THEN CAST(3 AS DOUBLE) ELSE greatest(scale * g, CAST(0 AS DOUBLE)) END AS m
  FROM s3 LEFT JOIN scale ON s3.source IS NOT DISTINCT FROM scale.source),
rate AS (
  SELECT source, cls, CAST(floor(m) AS BIGINT) AS whole, m - floor(m) AS p,
    target - CAST(sum(CAST(floor(m) AS BIGINT) * words) OVER (PARTITION BY source) AS DOUBLE) AS open
  FROM s4),
x AS (
  SELECT r.*, whole, open, CASE WHEN p > 0 AND open > 0 AND size > 0 THEN (u / (1 - u)) / (p / (1 - p)) END AS q
  FROM r JOIN rate ON r.source IS NOT DISTINCT FROM rate.source AND r.cls = rate.cls),
y AS (SELECT *, q / (1 + q) AS z FROM x),
c AS (
  SELECT *, z IS NOT NULL AND CAST(coalesce(sum(size) OVER (PARTITION BY source, z IS NULL ORDER BY z, doc_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE) + size / CAST(2 AS DOUBLE) <= open AS more
  FROM y),
off AS (
  SELECT source, CAST(sum(CASE WHEN more THEN size ELSE 0 END) AS DOUBLE) - first(open) AS off_by FROM c GROUP BY source),
f AS (
  SELECT c.source, c.z, c.doc_id, abs(off_by), abs(off_by + CASE WHEN more THEN -size ELSE size END) AS after
  FROM c JOIN off ON c.source IS NOT DISTINCT FROM off.source
  WHERE z IS NOT NULL AND abs(off_by + CASE WHEN more THEN -size ELSE size END) < abs(off_by)),
flip AS (SELECT source, arg_min(row(z, doc_id), row(after, z, doc_id)) AS k FROM f GROUP BY source),
done AS (
  SELECT c.*, whole + CAST(more <> coalesce(k[1] = c.z AND k[2] IS NOT DISTINCT FROM c.doc_id, FALSE) AS BIGINT) AS copies
  FROM c LEFT JOIN flip ON c.source IS NOT DISTINCT FROM flip.source)
SELECT doc_id, size, source_size, target, CAST(size * copies AS BIGINT) AS taken, done.source, copies
FROM done JOIN goal ON done.source IS NOT DISTINCT FROM goal.source
"""


# CRC-32 bit by bit (its reversed polynomial), from a table per byte.
RESAMPLE = r"""
WITH bytes AS MATERIALIZED (
  SELECT list(list_reduce(list_prepend(i, range(8)),
                          lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS tab
  FROM (SELECT unnest(range(256)) AS i)),
d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
dw AS MATERIALIZED (SELECT doc_id, unnest(w) AS word FROM d),
bw AS MATERIALIZED (SELECT unnest(w) AS word FROM b),
code AS MATERIALIZED (
  SELECT word, xor(list_reduce(
      list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(1, length(hex(word)), 2),
                   lambda i: CAST('0x' || substr(hex(word), i, 2) AS BIGINT))),
      lambda c, x: xor(c >> 8, tab[xor(c, x) % 256 + 1])), 4294967295) % 10000 AS bucket
  FROM (SELECT word FROM dw UNION SELECT word FROM bw), bytes),
src AS (SELECT bucket, count(*) AS s FROM dw JOIN code USING (word) GROUP BY bucket),
tgt AS (SELECT bucket, count(*) AS t FROM bw JOIN code USING (word) GROUP BY bucket),
tot AS (SELECT CAST((SELECT count(*) FROM dw) AS DOUBLE) AS big_s, CAST((SELECT count(*) FROM bw) AS DOUBLE) AS big_t),
gain AS MATERIALIZED (
  SELECT src.bucket, CAST(floor(1000 * ln(CAST(coalesce(t, 0) + 1 AS DOUBLE) * (big_s + 10000)
                     / (CAST(s + 1 AS DOUBLE) * (big_t + 10000)))) AS BIGINT) AS g
  FROM src LEFT JOIN tgt ON src.bucket = tgt.bucket, tot),
weight AS (
  SELECT doc_id, count(*) AS n_features, sum(g) AS total
  FROM dw JOIN code USING (word) JOIN gain USING (bucket) GROUP BY doc_id),
scored AS (
  SELECT d.doc_id, coalesce(n_features, 0) AS n_features,
    coalesce(CAST(total - (total % n_features + n_features) % n_features AS BIGINT) // n_features, 0) AS weight,
    CAST('0x' || substr(sha256('2024:' || d.doc_id), 1, 8) AS BIGINT) AS h
  FROM d LEFT JOIN weight ON d.doc_id = weight.doc_id),
s2 AS (
  SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, CAST(weight AS BIGINT) AS weight,
    CAST(weight + CAST(floor(-1000 * ln(-ln((h + CAST(0.5 AS DOUBLE)) / CAST(4294967296 AS DOUBLE)))) AS BIGINT) AS BIGINT) AS score
  FROM scored),
r AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place,
    count(*) OVER (PARTITION BY n_features >= 20) AS able FROM s2)
SELECT doc_id, n_features, weight, score,
  CASE WHEN n_features >= 20 AND place <= able * 10 // 100 THEN CAST(place AS BIGINT) END AS rank
FROM r
"""


def license_sql() -> str:
    """The same votes, diagonals and spans over a table of one row per word."""
    rows = ", ".join("({}, '{}', '{}', '{}')".format(i, t.label, t.kind, t.text.replace("'", "''"))
                     for i, t in enumerate(licenses.TEMPLATES))
    words = ("regexp_extract_all(translate(coalesce(text, ''), '" + licenses.UPPER + "', '" + licenses.LOWER
             + r"'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")
    more = licenses.NOTICE_WORDS - 1
    return f"""
WITH tpl(template, label, kind, text) AS (VALUES {rows}),
d AS (SELECT doc_id, {words} AS w FROM documents),
t AS (SELECT template, label, kind, {words} AS w FROM tpl),
tg AS (
  SELECT template, label, kind, len(w) AS t_len, i AS t_pos, w[i + 1] AS a, w[i + 2] AS b, w[i + 3] AS c
  FROM (SELECT *, unnest(range(len(w))) AS i FROM t) WHERE i + CASE kind WHEN 'notice' THEN 3 ELSE 2 END <= len(w)),
dg AS MATERIALIZED (
  SELECT doc_id, i AS pos, w[i + 1] AS a, w[i + 2] AS b, w[i + 3] AS c
  FROM (SELECT *, unnest(range(len(w))) AS i FROM d)),
diag AS MATERIALIZED (
  SELECT doc_id, template, label, kind, t_len, pos - t_pos AS diagonal, list(t_pos) AS places
  FROM dg JOIN tg ON dg.a = tg.a AND dg.b = tg.b AND (kind <> 'notice' OR dg.c = tg.c) GROUP BY ALL),
numbered AS (
  SELECT *, sum(new) OVER (PARTITION BY doc_id, template ORDER BY diagonal) AS span
  FROM (SELECT *, CASE WHEN diagonal - lag(diagonal) OVER (PARTITION BY doc_id, template ORDER BY diagonal) <= {licenses.SHIFT}
                       THEN 0 ELSE 1 END AS new FROM diag WHERE kind = 'notice')),
covered AS (
  SELECT doc_id, template, label, kind, t_len, span, count(DISTINCT word) AS words
  FROM (SELECT *, unnest(range(p, p + {more + 1})) AS word FROM (SELECT *, unnest(places) AS p FROM numbered)) GROUP BY ALL),
hit AS (
  SELECT doc_id, label, kind, diagonal AS first_word, CAST(1 AS DOUBLE) AS cover
  FROM diag WHERE kind <> 'notice' AND len(places) = t_len - 1
  UNION ALL SELECT doc_id, label, kind, NULL, CAST(words AS DOUBLE) / t_len FROM covered
  WHERE CAST(words AS DOUBLE) / t_len >= CAST({licenses.LEAST_COVER} AS DOUBLE)),
found AS (
  SELECT doc_id, count(*) AS spans, count_if(kind = 'base') AS n_base,
    min(CASE WHEN kind = 'base' THEN first_word END) AS first_word,
    max(CASE WHEN kind = 'base' THEN first_word END) AS last_word,
    string_agg(DISTINCT CASE WHEN kind = 'base' THEN label END, ',' ORDER BY CASE WHEN kind = 'base' THEN label END) AS base_labels,
    string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(cover) AS score
  FROM hit GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base,
  CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, CAST(0 AS DOUBLE)) AS score,
  CAST(coalesce(spans, 0) AS BIGINT) AS spans
FROM d LEFT JOIN found ON d.doc_id = found.doc_id
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_mixing": MIX, "op9_superminhash": NEAR_GROUPS, "op10_topk": TOP_K,
            "op11_resampling": RESAMPLE, "op12_licenses": license_sql()}
