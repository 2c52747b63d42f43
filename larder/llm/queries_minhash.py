"""Registered query of min-max hashing, and its SQL over exact sets."""

from __future__ import annotations

from larder.llm.minhash import near_duplicates
from larder.sources.tables import read_table


def op10_minhash(spark, sf_dir):
    return near_duplicates(read_table(spark, sf_dir, "documents"))


QUERIES = {"op10_minhash": op10_minhash}

# Exact sets: every pair of documents that shares a shingle, the size of what
# they share, then the smallest id reachable.
ORACLES = {"op10_minhash": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(w) >= 3 THEN list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM w),
n AS (SELECT doc_id, len(s) AS n FROM s),
each AS (SELECT doc_id, unnest(s) AS x FROM s),
links AS (
  SELECT a, b FROM (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM each a JOIN each b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY 1, 2)
  JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * shared >= 85 * (na.n + nb.n - shared)),
reach AS (SELECT doc_id, doc_id AS r FROM n UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.r),
least AS (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id)
SELECT n.doc_id, CAST(n.n AS BIGINT) AS n_shingles, c.component_id, n.doc_id = c.component_id AS kept FROM n JOIN least c USING (doc_id)"""}
