"""Registered query of NN-descent over embeddings, and its SQL over all pairs."""

from __future__ import annotations

from larder.llm.vectors import similar_vectors
from larder.sources.tables import read_table


def op6_embedding_neardup(spark, sf_dir):
    return similar_vectors(read_table(spark, sf_dir, "embeddings"))


QUERIES = {"op6_embedding_neardup": op6_embedding_neardup}
ORACLES = {"op6_embedding_neardup": """
WITH RECURSIVE v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings),
u AS (
  SELECT vec_id, v, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS norm FROM v
  WHERE v IS NOT NULL AND len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b
    ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND a.norm > 0 AND b.norm > 0
  WHERE list_dot_product(a.v, b.v) / (a.norm * b.norm) >= 0.9),
reach AS (SELECT vec_id, vec_id AS r FROM v UNION SELECT r.vec_id, l.b FROM reach r JOIN links l ON l.a = r.r),
least AS (SELECT vec_id, min(r) AS component_id FROM reach GROUP BY vec_id)
SELECT v.vec_id, (SELECT count(*) FROM links l WHERE l.a = v.vec_id) AS n_links, c.component_id, v.vec_id = c.component_id AS kept
FROM v JOIN least c USING (vec_id)"""}
