"""DuckDB SQL for the queries that SQL can express over whole tables."""

OP2 = r"""
WITH d AS (
  SELECT doc_id, source, CAST(CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) END AS BIGINT) AS size FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source
), w AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight, 3 * source_size AS cap FROM s
), lv AS (
  SELECT *, (CAST(sum(source_size) OVER () AS DOUBLE) - CAST(coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE))
    / CAST(sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS level
  FROM w WINDOW o AS (ORDER BY CAST(cap AS DOUBLE) / weight, source NULLS LAST)
), t AS (
  SELECT source, source_size, CASE WHEN cap > level * weight
    THEN weight * (SELECT level FROM lv b WHERE b.cap > b.level * b.weight ORDER BY CAST(b.cap AS DOUBLE) / b.weight, b.source NULLS LAST LIMIT 1)
    ELSE CAST(cap AS DOUBLE) END AS target FROM lv
), g AS (
  SELECT d.doc_id, d.size, 'mix' || coalesce('=' || d.source, '') AS k, t.source_size, t.target, floor(sqrt(CAST(d.size AS DOUBLE))) AS grade,
    CAST('0x' || substr(md5(coalesce(CAST(d.doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) % (16 * greatest(1, CAST(ceil(sqrt((SELECT count(*) FROM documents) / 1000000.0)) AS BIGINT))) AS salt, floor(sqrt(CAST(d.size AS DOUBLE))) * floor(sqrt(CAST(d.size AS DOUBLE))) * 50 > t.source_size AS large,
    CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS rate
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), r AS (
  SELECT *, row_number() OVER (PARTITION BY k, large ORDER BY grade, salt, size, doc_id NULLS FIRST) AS nth,
    CAST('0x' || substr(md5(k), 1, 8) AS BIGINT) / CAST(4294967296 AS DOUBLE) AS u FROM g
), f AS (
  SELECT k, CAST(coalesce(sum(CASE WHEN large THEN CAST(floor(nth * rate + u) - floor((nth - 1) * rate + u) AS BIGINT) * size END), 0) AS DOUBLE) AS drawn,
    CAST(coalesce(sum(CASE WHEN large THEN 0 ELSE size END), 0) AS DOUBLE) AS small FROM r GROUP BY k
), e AS (
  SELECT r.*, CASE WHEN large THEN rate WHEN small > 0 THEN greatest(0.0, least(3.0, (target - drawn) / small)) ELSE 0.0 END AS each FROM r JOIN f ON r.k = f.k
)
SELECT doc_id, size, source_size, target, CAST(floor(nth * each + u) - floor((nth - 1) * each + u) AS BIGINT) * size AS taken FROM e
"""

OP6 = """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
), d AS (
  SELECT page_id, CAST(octet_length(payload) AS BIGINT) AS payload_bytes, sha256(payload) AS payload_digest FROM p
), f AS (
  SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first_id FROM d
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN first_id < page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first_id < page_id THEN first_id END AS refers_to FROM f
"""

OP3 = r"""
WITH d AS (
  SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents
), p AS (
  SELECT doc_id, i, w[i] AS word, CASE WHEN i + 12 <= len(w) THEN array_to_string(w[i:i + 12], ' ') END AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d)
), f AS (
  SELECT g, min(doc_id) AS first_doc FROM p WHERE g IS NOT NULL GROUP BY g
), t AS (
  SELECT p.doc_id, p.i, p.word, max(CASE WHEN f.first_doc < p.doc_id THEN 1 ELSE 0 END) OVER (PARTITION BY p.doc_id ORDER BY p.i ROWS BETWEEN 12 PRECEDING AND CURRENT ROW) AS gone FROM p LEFT JOIN f ON p.g = f.g
), k AS (
  SELECT doc_id, CAST(sum(gone) AS BIGINT) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (gone = 0) AS kept FROM t GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN k ON d.doc_id = k.doc_id
"""

OP5 = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
), ok AS (
  SELECT * FROM v WHERE v IS NOT NULL AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0
), e AS (
  SELECT a.vec_id AS u, b.vec_id AS w FROM ok a JOIN ok b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) WHERE list_cosine_similarity(a.v, b.v) >= 0.95
), r AS (
  SELECT vec_id AS id, vec_id AS reached FROM v UNION SELECT r.id, e.w FROM r JOIN e ON e.u = r.reached
), c AS (
  SELECT id, min(reached) AS component_id FROM r GROUP BY id
), n AS (
  SELECT u, count(*) AS n FROM e GROUP BY u
)
SELECT v.vec_id, coalesce(n, 0) AS n_links, component_id, v.vec_id = component_id AS kept FROM v JOIN c ON c.id = v.vec_id LEFT JOIN n ON n.u = v.vec_id
"""

OP7 = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, least(len(w), 1)) + 1)) AS i FROM d)
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), b AS (
  SELECT x.doc_id AS u, y.doc_id AS w, count(*) AS both_n FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL
), e AS (
  SELECT u, w FROM b JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = w WHERE 100 * both_n >= 85 * (x.n + y.n - both_n)
), r AS (
  SELECT doc_id AS id, doc_id AS reached FROM d UNION SELECT r.id, e.w FROM r JOIN e ON e.u = r.reached
), c AS (
  SELECT id, min(reached) AS component_id FROM r GROUP BY id
)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept FROM d JOIN c ON c.id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""

OP10 = """
WITH v AS (
  SELECT vec_id, list_transform(CAST(embedding AS DOUBLE[]), lambda x: CAST(floor(256 * x) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), p AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])) AS BIGINT) AS score FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p) WHERE rank <= 5
"""

OP11 = r"""
WITH d AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents
)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept, sha256(t) AS text_sha256 FROM d WINDOW w AS (PARTITION BY t)
"""

OP12 = r"""
WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT id, lang, source, translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
  FROM (SELECT id, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM d)
), k AS (
  SELECT lang, term, CAST(count(*) AS HUGEINT) AS total FROM w GROUP BY lang, term HAVING count(DISTINCT id) >= 10
), g AS (
  SELECT DISTINCT lang, source FROM d
), c AS (
  SELECT lang, source, term, CAST(count(*) AS HUGEINT) AS n FROM w SEMI JOIN k USING (lang, term) GROUP BY ALL
), x AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, k.total, sum(coalesce(c.n, 0)) OVER (PARTITION BY g.lang, g.source) AS s, sum(k.total) OVER (PARTITION BY g.lang, g.source) AS sl, count(*) OVER (PARTITION BY g.lang, g.source) AS v
  FROM g JOIN k ON g.lang = k.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), p AS (
  SELECT lang, source, term, n, 1 + (1000000000 * (n + 2)) // CAST(s + 2 * v AS HUGEINT) AS p, 1 + (1000000000 * (total + 2)) // CAST(sl + 2 * v AS HUGEINT) AS q FROM x
), e AS (
  SELECT a.lang, a.source, b.source AS item, CAST(sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS BIGINT) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), o AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(e.value, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN e ON e.lang = a.lang AND e.source = a.source AND e.item = b.source
  UNION ALL SELECT lang, source, 'term', term, CAST(((p - q) * (p - q)) // (p + q) AS BIGINT) FROM p WHERE n > 0 AND p > q
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM o
)
SELECT lang, source, part, item, value, rank FROM r WHERE part = 'pair' OR rank <= 10
"""

OP13 = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || CAST(doc_id AS VARCHAR)) AS h FROM documents
), u AS (
  SELECT doc_id, text, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') AS u, [CAST('0x' || h[i:i + 7] AS BIGINT) FOR i IN [1, 9, 17, 25]] AS h FROM t
), c AS (
  SELECT doc_id, text, u, h, CAST(len(u) AS BIGINT) AS n, least(h[1] % (len(u) + 1), h[2] % (len(u) + 1)) AS a, greatest(h[1] % (len(u) + 1), h[2] % (len(u) + 1)) AS b,
    CASE WHEN text = '' OR regexp_matches(text, '<[PSM]>') OR h[3] % 100 >= 90 THEN 'plain' WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM u
), f AS (
  SELECT doc_id, text, n, form, CASE WHEN form <> 'plain' THEN coalesce(array_to_string(u[:a], ''), '') END AS p, CASE WHEN form <> 'plain' THEN coalesce(array_to_string(u[a + 1:b], ''), '') END AS m,
    CASE WHEN form <> 'plain' THEN coalesce(array_to_string(u[b + 1:], ''), '') END AS s FROM c
)
SELECT doc_id, n, form, CAST(length(p) AS BIGINT) AS prefix_chars, CAST(length(m) AS BIGINT) AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(text) AS restored_sha256 FROM f
"""

ORACLE_SQL: dict[str, str] = {
    "op2_mix_sources": OP2,
    "op3_substring_dedup": OP3,
    "op5_embedding_near_dedup": OP5,
    "op6_warc_salvage": OP6,
    "op7_minhash_near_dedup": OP7,
    "op10_pivot_top_k": OP10,
    "op11_exact_dedup": OP11,
    "op12_source_divergence": OP12,
    "op13_fill_in_middle": OP13,
}
