"""The same results in DuckDB SQL, where SQL can express them."""

from __future__ import annotations

import string

_LOWER = f"translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
_WORDS = r"'[^\x20\x09-\x0D]+'"

OP10 = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(coalesce({_LOWER}, ''), {_WORDS}) AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 3 THEN array_to_string(w, ' ')
    ELSE array_to_string(w[i : i + 2], ' ') END AS sh
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 2))) AS i FROM d WHERE len(w) > 0)
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), p AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common
  FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY 1, 2
), l AS (
  SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y
  WHERE 100 * common >= 85 * (a.n + b.n - common)
), r AS (
  SELECT doc_id AS x, doc_id AS y FROM documents
  UNION SELECT r.x, l.y FROM r JOIN l ON l.x = r.y
), c AS (
  SELECT x AS doc_id, min(y) AS component_id FROM r GROUP BY x
)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM c LEFT JOIN n USING (doc_id)
"""

OP1 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    list_sum(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 20 = 0
)
SELECT query_id, (row_number() OVER w)::INTEGER AS rank, vec_id, score FROM s
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 20
"""

OP2 = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), l AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93
), r AS (
  SELECT vec_id AS x, vec_id AS y FROM embeddings
  UNION SELECT r.x, l.y FROM r JOIN l ON l.x = r.y
), c AS (
  SELECT x AS vec_id, min(y) AS component_id FROM r GROUP BY x
), n AS (
  SELECT x AS vec_id, count(*) AS n FROM l GROUP BY x
)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM c LEFT JOIN n USING (vec_id)
"""

_TERMS = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"

OP11 = f"""
WITH b AS (
  SELECT coalesce(item_id::VARCHAR, '') AS item, regexp_extract_all({_LOWER}, {_TERMS}) AS w FROM benchmark WHERE text IS NOT NULL
), v AS (
  SELECT DISTINCT item, n, array_to_string(w[i : i + n - 1], ' ') AS win
  FROM (SELECT item, w, least(10, len(w)) AS n, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS i FROM b WHERE len(w) > 0)
), d AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(coalesce({_LOWER}, ''), {_TERMS}) AS w FROM documents
), g AS (
  SELECT row, n, p, array_to_string(w[p : p + n - 1], ' ') AS win
  FROM (SELECT row, w, n, unnest(generate_series(1, len(w) - n + 1)) AS p FROM d, (SELECT DISTINCT n FROM v) WHERE len(w) >= n)
), m AS (
  SELECT row, p, n, item FROM g JOIN v USING (n, win)
), h AS (
  SELECT row, count(DISTINCT place) AS n_hit
  FROM (SELECT row, unnest(generate_series(p, p + n - 1)) AS place FROM (SELECT DISTINCT row, p, n FROM m)) GROUP BY row
), i AS (
  SELECT row, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM m GROUP BY row
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (row) LEFT JOIN i USING (row)
"""

_STEPS = " UNION ALL ".join(f"SELECT filter_order, {i} AS step FROM orders" for i in range(1, 6))

OP12 = rf"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), {_WORDS}) AS w FROM documents
), m AS (
  SELECT doc_id, part, (len(w) < 50)::INT + 2 * (100 * len(list_distinct(w)) < 65 * len(w))::INT
    + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t))::INT
    + 8 * regexp_matches(t, '[#$%&*|]')::INT + 16 * coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)::INT AS mask
  FROM d
), l AS (
  SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id
), c AS (
  SELECT part, mask, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, count(*) AS n
  FROM m LEFT JOIN l USING (doc_id) GROUP BY ALL
), letters AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x
), orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), s AS (
  SELECT filter_order, step, filter_order[step] AS letter, 1 << (ascii(filter_order[step]) - 65) AS bit,
    list_sum(list_transform(range(1, step), lambda i: 1 << (ascii(filter_order[i]) - 65))) AS before
  FROM ({_STEPS})
), o AS (
  SELECT part, filter_order, step, letter, n, good, toxic, mask = bit AS alone,
    mask & bit <> 0 AS fails, mask & coalesce(before, 0)::INT <> 0 AS gone
  FROM c, s
), a AS (
  SELECT part, filter_order, step, letter,
    sum(CASE WHEN NOT fails AND NOT gone THEN n ELSE 0 END)::BIGINT AS kept,
    sum(CASE WHEN fails AND NOT gone THEN n ELSE 0 END)::BIGINT AS removed,
    sum(CASE WHEN fails AND gone THEN n ELSE 0 END)::BIGINT AS redundant,
    sum(CASE WHEN alone THEN n ELSE 0 END)::BIGINT AS unique_fails,
    sum(CASE WHEN fails AND NOT gone AND good THEN n ELSE 0 END)::BIGINT AS good_lost,
    sum(CASE WHEN fails AND NOT gone AND toxic THEN n ELSE 0 END)::BIGINT AS toxic_lost
  FROM o GROUP BY ALL
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  sum(removed) OVER (PARTITION BY part, letter)::BIGINT AS shapley
FROM a
"""

OP13 = f"""
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(coalesce({_LOWER}, ''), {_TERMS}) AS w FROM documents
), s AS (
  SELECT count(*)::BIGINT AS docs, sum(len(w))::BIGINT AS terms FROM d WHERE len(w) > 0
), p AS (
  SELECT row, term, count(*)::BIGINT AS tf FROM (SELECT row, unnest(w) AS term FROM d) GROUP BY ALL
), f AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS weight
  FROM (SELECT term, count(*)::BIGINT AS df FROM p GROUP BY term), s
), q AS (
  SELECT item, item_id, term, count(*)::BIGINT AS n FROM (
    SELECT row_number() OVER () AS item, item_id, unnest(regexp_extract_all(coalesce({_LOWER}, ''), {_TERMS})) AS term FROM benchmark
  ) GROUP BY ALL
), m AS (
  SELECT row, doc_id, 25 + (75 * len(w) * docs) // terms AS m FROM d, s
), r AS (
  SELECT item, item_id, row, doc_id, sum(n * weight * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM q JOIN f USING (term) JOIN p USING (term) JOIN m USING (row) GROUP BY ALL
)
SELECT item_id, (row_number() OVER o)::INTEGER AS rank, doc_id, score FROM r WHERE score > 0
WINDOW o AS (PARTITION BY item ORDER BY score DESC, doc_id) QUALIFY row_number() OVER o <= 10
"""

ORACLES = {"op1_ball_tree": OP1, "op2_flat_graph": OP2, "op10_hyperminhash": OP10, "op11_decontaminate": OP11, "op12_filter_audit": OP12, "op13_norm_buckets": OP13}
