"""Queries over ``embeddings``: exact and approximate search."""

from __future__ import annotations

from pyspark.sql import functions as F

from formmart.llm.common import read_table
from formmart.llm.registry import register
from formmart.llm.topk import search

_OP3_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
           FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id,
             CAST(list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i])) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
             vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""


@register("op3_topk", _OP3_SQL)
def op3_topk(spark, sf_dir):
    return search(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20, scale=64)


@register("op12_collision_search")
def op12_collision_search(spark, sf_dir):
    from formmart.llm import collision_search

    return collision_search.search(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)
