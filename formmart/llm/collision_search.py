"""Approximate nearest neighbours by inner product: collision-counting hashing with virtual rehashing.

*Index.*  Vectors are divided into shards of about ``shard_rows`` whose norms lie
within a quarter octave.  In a shard a vector x is given one more component, so that
all have the shard's greatest norm M; a query q is scaled to M with 0 as its last
component.  The largest inner product is then the least distance.  A shard holds ``m``
arrays, one for each random direction: its vectors' projections, sorted, with the
vectors' places.  Every vector is in all arrays; the index is a written table with
one row a shard.

*Search.*  Around the query's own projections a window of half-width u opens in each
array, and widens from level to level by ``WIDEN``: the same arrays serve every
width.  Each vector counts the windows that it lies in: narrow windows are read
entry by entry, wide ones by comparing all places with the windows' ends.  A vector in at least ``share`` * m windows is verified with its
inner product.  A shard is done when k are verified and a vector at the k-th best's
distance d lies in enough windows but for ``z`` standard deviations: its projections
differ from the query's by d times a standard normal number, so the chance of one
window is erf(u / (d sqrt 2)).  Nearer vectors are missed less often still.  A shard
where this never holds ends with every vector verified, so nothing is capped.

Every query meets every shard, in blocks of ``block_rows`` queries; the k best of all
shards are merged by score.

Edge cases: vectors that are null, zero, or hold a null or non-finite value, and rows
without an id take no part; shorter vectors count as padded with zeros; rows with the
query's id are the query's own and no candidates; other repeated rows are candidates
of their own, dealt to different shards; ties go to the smaller id; a query with fewer
candidates than k gets all; an empty table has no result; other columns are ignored.
"""

from __future__ import annotations

import math
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from formmart.llm.common import written
from formmart.llm.topk import usable

#: Half-width of the first windows as a share of the greatest norm, and the factor from level to level.
FIRST = 0.25
WIDEN = 1.25
#: Queries whose windows are looked up together.
TOGETHER = 256
#: Windows are read entry by entry while they hold less than this part of all, else all places are compared with their ends.
SPARSE = 16

_INDEX = "shard int, rows int, ids binary, vectors binary, keys binary, places binary, norm double"


def directions(m: int, dim: int, seed: int) -> np.ndarray:
    """m random directions of independent standard normal components, one more than a vector has."""
    return np.random.default_rng(seed).standard_normal((m, dim + 1))


def _matrix(lists: pa.ChunkedArray, dim: int) -> np.ndarray:
    lists = lists.combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(sizes), dim))
    out[np.arange(dim)[None, :] < sizes[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


class Shard:
    """Sorted projections of a shard's vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, keys: np.ndarray, places: np.ndarray, norm: float):
        self.ids, self.vectors, self.keys, self.places, self.norm = ids, vectors, keys, places, norm

    @cached_property
    def ranks(self) -> np.ndarray:
        """Each vector's place in each array."""
        m, n = self.places.shape
        out = np.empty((m, n), np.uint16 if n < 1 << 16 else np.uint32)
        np.put_along_axis(out, self.places, np.arange(n, dtype=out.dtype)[None, :], axis=1)
        return out

    @classmethod
    def build(cls, ids: np.ndarray, vectors: np.ndarray, along: np.ndarray) -> Shard:
        order = np.argsort(ids, kind="stable")
        ids, vectors = ids[order], vectors[order]
        norms = _norms(vectors)
        norm = float(norms.max())
        unit = vectors / norm
        last = np.sqrt(np.maximum(0.0, 1.0 - (norms / norm) ** 2))
        projected = along[:, :-1] @ unit.T + along[:, -1:] * last[None, :]
        places = np.argsort(projected, axis=1, kind="stable").astype(np.int32)
        return cls(ids, vectors, np.take_along_axis(projected, places, axis=1).astype(np.float32), places, norm)

    def row(self) -> dict:
        return {"rows": len(self.ids), "ids": self.ids.astype("<i8").tobytes(), "vectors": self.vectors.astype("<f8").tobytes(),
                "keys": self.keys.astype("<f4").tobytes(), "places": self.places.astype("<i4").tobytes(), "norm": self.norm}

    @classmethod
    def read(cls, row: dict, dim: int, m: int) -> Shard:
        n = row["rows"]
        return cls(np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["vectors"], "<f8").reshape(n, dim),
                   np.frombuffer(row["keys"], "<f4").reshape(m, n), np.frombuffer(row["places"], "<i4").reshape(m, n).astype(np.intp), row["norm"])

    def levels(self, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Half-widths, and for each query, level and direction the window's ends."""
        reach = float(max(np.abs(self.keys[:, :1].T - centres).max(), np.abs(self.keys[:, -1:].T - centres).max()))
        steps = 1 + max(0, math.ceil(math.log(max(reach, FIRST) / FIRST, WIDEN)))
        widths = FIRST * WIDEN ** np.arange(steps + 1)
        lo = np.empty((len(centres), len(widths), len(self.keys)), np.int32)
        hi = np.empty_like(lo)
        for i, keys in enumerate(self.keys):
            at = centres[:, i:i + 1]
            lo[:, :, i] = np.searchsorted(keys, (at - widths).astype(np.float32))
            hi[:, :, i] = np.searchsorted(keys, (at + widths).astype(np.float32), side="right")
        return widths, lo, hi

    def counted(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """How many of the windows [left, right) each vector lies in."""
        m, n = self.keys.shape
        if int((right - left).sum()) * SPARSE < m * n:  # narrow windows: read their entries alone
            return np.bincount(np.concatenate([p[a:b] for p, a, b in zip(self.places, left, right)]), minlength=n)
        kind = self.ranks.dtype  # below the window's start wraps round to beyond its end
        inside = self.ranks - left[:, None].astype(kind) < (right - left)[:, None].astype(kind)
        return np.add.reduce(inside.view(np.uint8), axis=0, dtype=np.uint8 if m < 256 else np.int64)

    def nearest(self, own: int, query: np.ndarray, widths, lo, hi, k: int, share: float, z: float,
                level: int = 0) -> tuple[np.ndarray, np.ndarray, int, int]:
        """Ids and scores of the k best found, how many vectors were verified, and the level that sufficed.

        Windows only widen and a level's counts don't depend on the one before, so the first
        level that suffices is looked for from ``level`` downwards or upwards.
        """
        m, n = self.keys.shape
        need = share * m
        other = self.ids != own
        known = np.full(n, np.nan)
        length = float(_norms(query[None, :])[0])
        unit = query / length

        def verified(at: int) -> tuple[np.ndarray, bool]:
            """The vectors that the windows of a level verify, and whether these suffice."""
            done = np.flatnonzero((self.counted(lo[at], hi[at]) >= need) & other)
            fresh = done[np.isnan(known[done])]
            known[fresh] = self.vectors[fresh] @ unit / self.norm  # cosines up to the shard's norms
            if len(done) < k:
                return done, False
            worst = float(np.partition(known[done], -k)[-k])
            distance = math.sqrt(max(0.0, 2 - 2 * worst))
            p = math.erf(widths[at] / (distance * math.sqrt(2))) if distance else 1.0
            return done, m * p - z * math.sqrt(m * p * (1 - p)) >= need

        level = min(level, len(widths) - 1)
        done, enough = verified(level)
        while not enough and level < len(widths) - 1:
            level += 1
            done, enough = verified(level)
            if enough:
                break
        else:
            while enough and level:
                less, enough = verified(level - 1)
                if enough:
                    level, done = level - 1, less
        scores = np.full(n, -np.inf)
        scores[done] = known[done]
        done = np.flatnonzero(scores > -np.inf)
        if len(done) > k:
            worst = np.partition(scores[done], -k)[-k]
            done = done[scores[done] >= worst - 1e-9]
        exact = inner_products(self.vectors[done], query)
        best = np.lexsort((self.ids[done], -exact))[:k]
        return self.ids[done][best], exact[best], int((scores > -np.inf).sum()), level


def _norms(vectors: np.ndarray) -> np.ndarray:
    """Lengths that don't overflow."""
    most = np.abs(vectors).max(axis=1)
    return most * np.sqrt(((vectors / np.where(most > 0, most, 1)[:, None]) ** 2).sum(axis=1))


def inner_products(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Summed component by component, so that equal vectors have equal scores wherever they lie."""
    out = np.zeros(len(vectors))
    for x, y in zip(vectors.T, query):
        out += x * y
    return out


def _prepared(df: DataFrame, vec_id: str, vector: str, is_query: Column) -> DataFrame:
    v = F.transform(F.col(vector), lambda x: x.cast("double"))
    rows = (df.select(F.col(vec_id).cast("long").alias("id"), v.alias("v"), F.coalesce(is_query, F.lit(False)).alias("asks"))
            .where(F.col("id").isNotNull() & usable(F.col("v"))))
    most = F.aggregate("v", F.lit(0.0), lambda a, x: F.greatest(a, F.abs(x)))
    rows = rows.withColumn("most", most).where("most > 0")
    length = F.col("most") * F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + (x / F.col("most")) * (x / F.col("most"))))
    return rows.withColumn("band", F.floor(F.log2(length) * 4).cast("int")).drop("most")


def build_index(rows: DataFrame, dim: int, m: int, shard_rows: int, seed: int) -> DataFrame:
    """One row for each shard of the prepared rows."""
    # one row for each quarter octave of a double's range, at most 8,400
    sizes = rows.groupBy("band").agg(F.count(F.lit(1)).alias("n")).orderBy("band").collect()
    first, bands = 0, []
    for band, n in sizes:
        shards = -(-n // shard_rows)
        bands.append((band, first, shards))
        first += shards
    bands = rows.sparkSession.createDataFrame(bands, "band int, first int, shards int")
    # the row's place takes part, so that repeated rows are dealt to different shards
    dealt = rows.withColumn("place", F.monotonically_increasing_id()).join(F.broadcast(bands), "band").select(
        "id", "v", (F.col("first") + F.pmod(F.xxhash64("id", "place"), F.col("shards"))).cast("int").alias("shard"))
    along = directions(m, dim, seed)

    def build(table: pa.Table) -> pa.Table:
        shard = Shard.build(table["id"].to_numpy(), _matrix(table["v"], dim), along)
        kinds = [("shard", pa.int32()), ("rows", pa.int32()), *((c, pa.binary()) for c in ("ids", "vectors", "keys", "places")),
                 ("norm", pa.float64())]
        return pa.Table.from_pylist([{"shard": table["shard"][0].as_py(), **shard.row()}], schema=pa.schema(kinds))

    return dealt.groupBy("shard").applyInArrow(build, _INDEX)


def search(df: DataFrame, is_query: Column, k: int = 20, vec_id: str = "vec_id", vector: str = "embedding", m: int = 64,
           share: float = 0.7, z: float = 1.25, shard_rows: int = 1 << 14, block_rows: int = 1 << 11, seed: int = 11,
           with_verified: bool = False) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of all other rows for each query row.

    ``with_verified`` adds ``verified``, the number of vectors of the row's shard that were verified.
    """
    rows = written(_prepared(df, vec_id, vector, is_query), "collision_rows")
    sizes = rows.agg(F.max(F.size("v")).alias("dim"), F.count_if("asks").alias("q")).first()
    dim, blocks = sizes.dim or 0, max(1, -(-sizes.q // block_rows))
    index = written(build_index(rows, dim, m, shard_rows, seed), "collision_index")
    shards = max(1, index.count())
    along = directions(m, dim, seed)
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    queries = (rows.where("asks").select("id", "v").dropDuplicates()
               .select("id", "v", F.xxhash64("v").alias("key"), F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("block"),
                       every(shards).alias("shard")))

    def nearest(left: pa.Table, right: pa.Table) -> pa.Table:
        out = {"query_id": [], "key": [], "vec_id": [], "score": [], "verified": []}
        if len(left) and len(right):
            shard = Shard.read(left.to_pylist()[0], dim, m)
            asked, own, keys = _matrix(right["v"], dim), right["id"].to_numpy(), right["key"].to_numpy()
            centres = (along[:, :-1] @ (asked / _norms(asked)[:, None]).T).T
            level = 0
            for at in range(0, len(asked), TOGETHER):
                some = slice(at, at + TOGETHER)
                widths, lo, hi = shard.levels(centres[some])
                for i, key, query, a, b in zip(own[some], keys[some], asked[some], lo, hi):
                    # where the query before it ended, this one begins
                    ids, scores, verified, level = shard.nearest(i, query, widths, a, b, k, share, z, level)
                    for name, value in zip(out, (np.full(len(ids), i), np.full(len(ids), key), ids, scores,
                                                 np.full(len(ids), verified))):
                        out[name].append(value)
        kinds = {c: pa.float64() if c == "score" else pa.int64() for c in out}
        return pa.table({c: pa.array(np.concatenate(v) if v else [], kinds[c]) for c, v in out.items()})

    found = (index.withColumn("block", every(blocks)).groupBy("shard", "block").cogroup(queries.groupBy("shard", "block"))
             .applyInArrow(nearest, "query_id long, key long, vec_id long, score double, verified long"))
    order = Window.partitionBy("query_id", "key").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score", *(["verified"] if with_verified else []))
