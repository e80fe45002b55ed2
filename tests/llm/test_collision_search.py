import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from formmart.llm import collision_search as S

NAN, INF = float("nan"), float("inf")


def brute(rows, k, modulus=20):
    def fine(v):
        return v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)

    def product(a, b):
        total = 0.0
        for x, y in zip(a, b):
            total += x * y
        return total

    ok = [(i, v) for i, v in rows if i is not None and fine(v)]
    return {(q, a): sorted((-product(a, b), i) for i, b in ok if i != q)[:k]
            for q, a in {(i, tuple(v)) for i, v in ok if i % modulus == 0}}


def asked(spark, rows, k=20, kind="double", **options):
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], f"vec_id long, embedding array<{kind}>, shard int, score int")
    return S.search(df, F.col("vec_id") % 20 == 0, k=k, **options)


def compare(got, want, k):
    """Recall against brute force; order, scores and ranks of what was found."""
    by_query = {}
    for r in got.collect():
        by_query.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert set(by_query) == {q for q, _ in want}
    hits = total = 0
    for (q, _), best in want.items():
        found = sorted(by_query[q])
        assert [r for r, _, _ in found] == list(range(1, len(best) + 1))
        assert [(-s, i) for _, i, s in found] == sorted((-s, i) for _, i, s in found)
        floor = -best[-1][0]
        hits += sum(s >= floor for _, _, s in found)
        total += len(best)
        scores = dict((i, -s) for s, i in best)
        assert all(s == scores[i] for _, i, s in found if i in scores)
    return hits / total


def vectors(seed, n, dim=24, groups=30):
    rng = np.random.default_rng(seed)
    centre = rng.normal(0, 1, (groups, dim))
    return (centre[rng.integers(0, groups, n)] + rng.normal(0, 0.8, (n, dim)))


@pytest.mark.parametrize("norms,shard_rows,block_rows", [(0.0, 1 << 13, 1 << 11), (0.0, 300, 7), (1.5, 500, 64)])
def test_recall(spark, norms, shard_rows, block_rows):
    rng = np.random.default_rng(3)
    data = vectors(1, 2000) * np.exp(norms * rng.normal(0, 1, (2000, 1)))
    rows = [(i, v.tolist()) for i, v in enumerate(data)]
    got = asked(spark, rows, shard_rows=shard_rows, block_rows=block_rows, with_verified=True)
    assert compare(got, brute(rows, 20), 20) >= 0.95


def test_windows_leave_most_vectors_out(spark):
    rows = [(i, v.tolist()) for i, v in enumerate(vectors(2, 3000, dim=16, groups=100) * 5)]
    got = asked(spark, rows, k=5, with_verified=True)
    assert got.agg(F.avg("verified")).first()[0] < 1200
    assert compare(got, brute(rows, 5), 5) >= 0.95


def test_given_embeddings(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    got = S.search(df, F.col("vec_id") % 20 == 0)
    assert compare(got, brute(rows, 20), 20) >= 0.95


def test_odd_rows_ties_and_a_hot_vector(spark):
    rng = np.random.default_rng(5)
    rows = [(int(i), rng.normal(0, 1, 6).tolist()) for i in range(90)]
    rows += [(500 + i, rows[7][1]) for i in range(60)] + [(41, rows[8][1])] * 50                    # copies, a repeated row
    rows += [(300, None), (301, [0.5, None]), (302, [NAN, 1.0]), (303, [INF]), (320, [-INF]), (None, [1.0]), (304, []),
             (340, [0.5, -0.25]), (360, [0.0, 0.0]), (380, []), (305, [0.0]), (400, [1e-300, 1e-290]), (306, [1e150])]
    got = asked(spark, rows, k=9, shard_rows=40, block_rows=2)
    assert compare(got, brute(rows, 9), 9) >= 0.95


def test_few_and_no_candidates(spark):
    assert asked(spark, []).count() == 0
    assert asked(spark, [(20, [1.0])]).count() == 0
    assert [tuple(r) for r in asked(spark, [(20, [1.0]), (1, [-0.5])]).collect()] == [(20, 1, 1, -0.5)]


def test_every_vector_is_in_every_array():
    data = vectors(4, 500)
    shard = S.Shard.build(np.arange(500), data, S.directions(16, 24, 1))
    assert (np.sort(shard.places, axis=1) == np.arange(500)).all() and (np.diff(shard.keys, axis=1) >= 0).all()


def level_by_level(shard, own, query, widths, lo, hi, k, share, z):
    """Windows opened one level after the other from the narrowest, over all entries."""
    unit = query / np.sqrt((query ** 2).sum())
    m = len(shard.keys)
    for width, left, right in zip(widths, lo, hi):
        counts = np.zeros(len(shard.ids), int)
        for places, a, b in zip(shard.places, left, right):
            counts[places[a:b]] += 1
        done = np.flatnonzero((counts >= share * m) & (shard.ids != own))
        if len(done) >= k:
            d = math.sqrt(max(0.0, 2 - 2 * float(np.sort(shard.vectors[done] @ unit / shard.norm)[-k])))
            p = math.erf(width / (d * math.sqrt(2))) if d else 1.0
            if m * p - z * math.sqrt(m * p * (1 - p)) >= share * m:
                break
    exact = S.inner_products(shard.vectors[done], query)
    best = np.lexsort((shard.ids[done], -exact))[:k]
    return shard.ids[done][best], exact[best], len(done)


@pytest.mark.parametrize("sparse", [0, 16, 1 << 30])
def test_few_levels_are_counted_and_the_first_that_suffices_is_taken(monkeypatch, sparse):
    """A query's CPU is a few counts of its shard, not one for each level from the narrowest on."""
    monkeypatch.setattr(S, "SPARSE", sparse)
    data, along = vectors(6, 1500), S.directions(64, 24, 1)
    shard = S.Shard.build(np.arange(1500), data, along)
    asked = data[:60]
    centres = (along[:, :-1] @ (asked / np.sqrt((asked ** 2).sum(axis=1))[:, None]).T).T
    widths, lo, hi = shard.levels(centres)
    calls, count = [], S.Shard.counted
    monkeypatch.setattr(S.Shard, "counted", lambda *a: calls.append(1) or count(*a))
    level = 0
    for i in range(60):
        ids, scores, verified, level = shard.nearest(i, asked[i], widths, lo[i], hi[i], 20, 0.7, 1.25, level)
        want = level_by_level(shard, i, asked[i], widths, lo[i], hi[i], 20, 0.7, 1.25)
        assert ids.tolist() == want[0].tolist() and scores.tolist() == want[1].tolist() and verified == want[2]
    assert len(calls) <= 4 * 60
