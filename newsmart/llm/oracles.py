"""DuckDB SQL for the operators that SQL can express, over whole tables."""

from __future__ import annotations

#: Every order step by step from its definition; Shapley as a plain sum over all orders.
OP11 = r"""
WITH texts AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
  FROM documents
),
failed AS (
  SELECT doc_id, part,
         CASE WHEN len(words) < 200 THEN 1 ELSE 0 END
         + CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 2 ELSE 0 END
         + CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]+', '', 'g')) > 2 * length(text) THEN 4 ELSE 0 END
         + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END
         + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY text) THEN 16 ELSE 0 END AS mask
  FROM texts
),
flags AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id
),
tally AS (
  SELECT part, mask, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic
  FROM failed LEFT JOIN flags USING (doc_id) GROUP BY part, mask
),
names(letter, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
orders AS (
  SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order
  FROM names a, names b, names c, names d, names e
  WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND a.bit | b.bit | c.bit | d.bit | e.bit = 31
),
steps AS (
  SELECT o.filter_order, x.bit, instr(o.filter_order, x.letter) AS step,
         coalesce((SELECT sum(y.bit) FROM names y WHERE instr(o.filter_order, y.letter) < instr(o.filter_order, x.letter)), 0)::INTEGER AS before
  FROM orders o, names x
),
counted AS (
  SELECT part, filter_order, step, bit,
         sum(CASE WHEN mask & (before | bit) = 0 THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN mask & before = 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN mask & before <> 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN mask & before = 0 AND mask & bit <> 0 THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN mask & before = 0 AND mask & bit <> 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM tally, steps GROUP BY part, filter_order, step, bit
)
SELECT part, filter_order, step::INTEGER AS step, kept::BIGINT AS kept, removed::BIGINT AS removed,
       redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost,
       toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM counted
"""

#: Every anchor against every row.
OP13 = """
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS vec
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS vec_id, a.label = b.label AS same,
         list_inner_product(a.vec, b.vec)::BIGINT AS score
  FROM rows a JOIN rows b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, (row_number() OVER w)::INTEGER AS rank, n.vec_id AS negative_id, positive_score, n.score AS negative_score
FROM positives JOIN scored n USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * n.score AND 100 * n.score <= 100 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY n.score DESC, n.vec_id)
QUALIFY row_number() OVER w <= 5
"""

_WORDS6 = (
    "regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)

#: Windows of item words joined with those of the documents, as strings.
OP6 = f"""
WITH doc_words AS (SELECT rowid AS r, doc_id, coalesce({_WORDS6}, []) AS words FROM (SELECT *, row_number() OVER () AS rowid FROM documents)),
item_words AS (SELECT item_id, {_WORDS6} AS words FROM benchmark WHERE text IS NOT NULL),
places AS (SELECT item_id, words, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS pos FROM item_words WHERE len(words) > 0),
item_windows AS (SELECT DISTINCT item_id, least(len(words), 10) AS n, array_to_string(words[pos:pos + 9], ' ') AS w FROM places),
sizes AS (SELECT DISTINCT n FROM item_windows),
doc_places AS (SELECT r, words, n, unnest(range(1, len(words) - n + 2)) AS pos FROM doc_words, sizes WHERE len(words) >= n),
found AS (
  SELECT r, pos, n, item_id
  FROM (SELECT r, pos, n, array_to_string(words[pos:pos + n - 1], ' ') AS w FROM doc_places) JOIN item_windows USING (n, w)
),
hits AS (SELECT r, count(DISTINCT word) AS n_hit FROM (SELECT r, unnest(range(pos, pos + n)) AS word FROM (SELECT DISTINCT r, pos, n FROM found)) GROUP BY r),
items AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT r, item_id::VARCHAR AS item FROM found) GROUP BY r
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN hits USING (r) LEFT JOIN items USING (r)
"""
