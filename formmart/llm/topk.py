"""Exact top-k search by integer inner product with MaxScore.

Each component of a vector is floor(scale * x).  A query's terms are its
components.  In a shard of the vectors the contribution of a term has a bound,
from the term's least and largest value there.  Terms are ordered by bound; the
last ones, whose bounds together stay below the score that a result needs, are
non-essential: they alone can't lift a vector into the result.  The postings of
the essential terms are traversed for the whole shard; the non-essential ones
are probed, best bound first, only for vectors that what is left can still
bring to the threshold.  A vector that reaches it exactly stays (ties go to the
smaller id).  The results of the shards are merged by score.

Every query meets every shard, in blocks: a task holds ``shard_rows`` vectors
and ``block_rows`` queries, whatever the size of the table.  Vectors are copied
once for each block of queries, queries once for each shard.

Edge cases: vectors that are null, or hold a null or non-finite value, and rows
without an id take no part; shorter vectors count as padded with zeros; rows
with the query's id are the query's own and no candidates; other repeated rows
are candidates of their own; a query with fewer candidates than k gets all; an
empty table has no result; other columns are not read, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

EXACT = float(1 << 53)  # integers below are exact in double precision
PROBE = 8               # non-essential terms probed between two looks at the threshold


def _matrix(lists: pa.ChunkedArray, dim: int) -> np.ndarray:
    """Rows of a list column as a matrix, padded with zeros."""
    lists = lists.combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy())
    values = lists.flatten().to_numpy(zero_copy_only=False)
    if (sizes == dim).all():
        return values.reshape(len(sizes), dim)
    out = np.zeros((len(sizes), dim), np.int64)
    out[np.arange(dim)[None, :] < sizes[:, None]] = values
    return out


class Shard:
    """Postings by term: the values of one component for all vectors, in the order of their ids."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, vectors = ids[order], vectors[order]
        self.high, self.low = vectors.max(axis=0, initial=0), vectors.min(axis=0, initial=0)
        self.postings = np.ascontiguousarray(vectors.T).astype(np.float64)
        self.seed = np.ascontiguousarray(vectors[:1024]).astype(np.float64)

    def top(self, own: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best vectors, those of the query's own id left out."""
        bound = np.maximum(query * self.high, query * self.low)
        terms = np.argsort(-bound, kind="stable")
        left = np.concatenate([np.cumsum(bound[terms][::-1])[::-1], [0]])  # bound of what follows
        weight = query.astype(np.float64)

        first = self.seed @ weight
        first = first[self.ids[:len(first)] != own]
        need = np.partition(first, -k)[-k] if len(first) >= k else -np.inf

        essential = int(np.searchsorted(-left, -need, side="right")) if need > 0 else len(terms)
        essential = min(essential, len(terms))
        ess = terms[:essential]
        score = weight[ess] @ self.postings[ess]
        alive = np.flatnonzero((score + left[essential] >= need) & (self.ids != own))
        score = score[alive]
        at = essential
        while at < len(terms):
            probed = terms[at:at + PROBE]
            score = score + weight[probed] @ self.postings[np.ix_(probed, alive)]
            at += len(probed)
            if len(score) > k:
                still = score + left[at] >= need
                alive, score = alive[still], score[still]
        best = np.lexsort((alive, -score))[:k]
        return self.ids[alive[best]], score[best]


def usable(vector: Column) -> Column:
    """Neither null nor holding a null or non-finite value."""
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return vector.isNotNull() & F.coalesce(F.forall(vector, fine), F.lit(False))


def search(df: DataFrame, is_query: Column, k: int = 20, scale: int = 64, vec_id: str = "vec_id",
           vector: str = "embedding", shard_rows: int = 1 << 14, block_rows: int = 1 << 12) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of all other rows for each query row."""
    ints = F.transform(F.col(vector), lambda x: F.floor(x.cast("double") * scale).cast("long"))
    rows = (df.select(F.col(vec_id).cast("long").alias("id"), F.col(vector), F.coalesce(is_query, F.lit(False)).alias("asks"))
            .where(F.col("id").isNotNull() & usable(F.col(vector))).select("id", ints.alias("v"), "asks"))
    sizes = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if("asks").alias("q"), F.max(F.size("v")).alias("dim")).first()
    shards, blocks = max(1, -(-sizes.n // shard_rows)), max(1, -(-sizes.q // block_rows))
    dim = sizes.dim or 0
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    of = lambda n: F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")
    candidates = rows.select("id", "v", of(shards).alias("shard"), every(blocks).alias("block"))
    queries = (rows.where("asks").select("id", "v").dropDuplicates()
               .select("id", "v", F.xxhash64("v").alias("key"), of(blocks).alias("block"), every(shards).alias("shard")))

    def best(left: pa.Table, right: pa.Table) -> pa.Table:
        columns = {"query_id": [], "key": [], "vec_id": [], "score": []}
        if len(left) and len(right):
            vectors, asked = _matrix(left["v"], dim), _matrix(right["v"], dim)
            most = (np.abs(vectors).max(axis=0, initial=0).astype(float) * np.abs(asked).max(axis=0, initial=0)).sum()
            if most >= EXACT:
                raise ValueError(f"scores of up to {most:.3g} aren't exact; use a smaller scale")
            shard = Shard(left["id"].to_numpy(), vectors)
            for own, key, query in zip(right["id"].to_numpy(), right["key"].to_numpy(), asked):
                ids, scores = shard.top(own, query, k)
                for name, value in zip(columns, (np.full(len(ids), own), np.full(len(ids), key), ids,
                                                 scores.astype(np.int64))):
                    columns[name].append(value)
        joined = {c: np.concatenate(v) if v else np.array([], np.int64) for c, v in columns.items()}
        return pa.table({c: pa.array(v, pa.int64()) for c, v in joined.items()})

    found = (candidates.groupBy("shard", "block").cogroup(queries.groupBy("shard", "block"))
             .applyInArrow(best, "query_id long, key long, vec_id long, score long"))
    order = Window.partitionBy("query_id", "key").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
