import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from formmart.llm.topk import Shard, search

NAN, INF = float("nan"), float("inf")


def brute(rows, k, scale, modulus):
    ok = [(i, [math.floor(x * scale) for x in v]) for i, v in rows
          if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in {(i, tuple(v)) for i, v in ok if i % modulus == 0}:
        scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in ok if i != q)[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored)]
    return sorted(out)


@pytest.mark.parametrize("shard_rows,block_rows", [(1 << 14, 1 << 12), (40, 3), (1, 1)])
def test_against_brute_force(spark, shard_rows, block_rows):
    rng = np.random.default_rng(1)
    rows = [(int(i), rng.normal(0, 0.2, 9).tolist()) for i in range(110)]
    rows += [(200 + i, rows[7][1]) for i in range(30)]  # ties
    rows += [(300, None), (301, [0.5, None]), (302, [NAN, 1.0]), (303, [INF]), (320, [-INF]), (None, [1.0]), (304, []),
             (340, [0.5, -0.25]), (20, rows[3][1]), (20, rows[20][1]), (5, rows[5][1])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, score int")
    f32 = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    got = search(df, F.col("vec_id") % 20 == 0, k=7, shard_rows=shard_rows, block_rows=block_rows)
    assert sorted(map(tuple, got.collect())) == brute(f32, 7, 64, 20)


def test_few_and_no_candidates(spark):
    schema = "vec_id long, embedding array<float>"
    assert search(spark.createDataFrame([], schema), F.col("vec_id") % 20 == 0).count() == 0
    assert search(spark.createDataFrame([(20, [1.0])], schema), F.col("vec_id") % 20 == 0).count() == 0
    got = search(spark.createDataFrame([(20, [1.0]), (1, [-1.0])], schema), F.col("vec_id") % 20 == 0).collect()
    assert [tuple(r) for r in got] == [(20, 1, 1, -4096)]


def test_scores_that_arent_exact_are_refused(spark):
    df = spark.createDataFrame([(20, [1e9]), (1, [1e9])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="smaller scale"):
        search(df, F.col("vec_id") % 20 == 0).collect()


def test_terms_are_skipped():
    """With a selective query the probed terms are read for few vectors, with the same result."""
    rng = np.random.default_rng(2)
    vectors = rng.integers(-2, 3, (3000, 24))
    vectors[:, 0] = rng.integers(0, 1000, 3000)
    shard = Shard(np.arange(3000), vectors)
    query = np.array([50] + [1] * 23)
    ids, scores = shard.top(-1, query, 5)
    exact = vectors @ query
    want = np.lexsort((np.arange(3000), -exact))[:5]
    assert (ids == want).all() and (scores == exact[want]).all()
