"""Property test: rolling form equals a brute-force recomputation on random series."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from formmart.operators.form import days_since_previous, prev_mean, with_rolling

D0 = dt.date(2020, 1, 1)

events = st.lists(
    st.tuples(st.integers(0, 3),                      # entity
              st.integers(0, 40),                     # day offset (ties on purpose)
              st.one_of(st.none(), st.integers(0, 50).map(float))),  # value, sometimes null
    min_size=1, max_size=60)


def brute(rows, n):
    out = {}
    by_entity = {}
    for gid, e, d, v in rows:
        by_entity.setdefault(e, []).append((d, gid, v))
    for e, lst in by_entity.items():
        lst.sort(key=lambda t: (t[0], t[1]))
        for i, (d, gid, v) in enumerate(lst):
            prev = [x[2] for x in lst[max(0, i - n):i] if x[2] is not None]
            mean = sum(prev) / len(prev) if prev else None
            rest = (d - lst[i - 1][0]) if i > 0 else None
            out[gid] = (mean, rest)
    return out


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(events, st.sampled_from([6, 7, 1 << 20]), st.integers(1, 5))
def test_rolling_matches_brute_force(spark, rows, chunk_rows, n):
    data = [(f"g{i:03d}", e, D0 + dt.timedelta(days=d), v) for i, (e, d, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "game_id string, team_id long, game_date date, x double")
    out = with_rolling(df, "team_id", "game_date", ["game_id"],
                       {"m": prev_mean("x", n), "rest": days_since_previous("game_date")},
                       n=n, chunk_rows=chunk_rows)
    got = {r.game_id: (r.m, r.rest) for r in out.collect()}
    want = brute([(f"g{i:03d}", e, d, v) for i, (e, d, v) in enumerate(rows)], n)
    assert set(got) == set(want)
    for k in want:
        gm, gr = got[k]
        wm, wr = want[k]
        assert gr == wr
        assert (gm is None and wm is None) or abs(gm - wm) < 1e-9
