"""Order statistics need a few passes over the rows, whatever their number of ties."""

import numpy as np

from formmart.operators import quantiles as Q


def test_keys_keep_the_order():
    values = [-np.inf, -1e300, -1.0, -5e-324, 0.0, 5e-324, 1.0, 1e300, np.inf]
    keys = [Q._key(v) for v in values]
    assert keys == sorted(keys) and [Q._double(k) for k in keys] == values


def test_few_passes_over_the_rows(spark, monkeypatch):
    passes = []
    for name in ("_by_histogram", "_in_passes"):
        run = getattr(Q, name)
        monkeypatch.setattr(Q, name, lambda *a, run=run: passes.append(1) or run(*a))
    rng = np.random.default_rng(3)
    x = {"means": rng.integers(0, 251, 30_000) / 5, "spread": rng.normal(0, 1, 30_000), "few": rng.choice([0.1, 0.2, 0.3], 30_000)}
    df = spark.createDataFrame([tuple(map(float, r)) for r in zip(*x.values())], ", ".join(f"{c} double" for c in x))
    assert Q.exact_medians(df, list(x)) == {c: float(np.median(v)) for c, v in x.items()}
    assert len(passes) <= 2 + Q.HISTOGRAMS
