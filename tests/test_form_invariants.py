"""Rolling form: frame semantics, chunking exactness, leakage and pairing invariants."""

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from formmart.operators import features as V
from formmart.operators.form import rolling_form

D0 = dt.date(2020, 1, 1)


def _games(spark, n=7, team=1, pts=None):
    pts = pts or [float(10 * (i + 1)) for i in range(n)]
    rows = [(f"g{i:02d}", 2019, D0 + dt.timedelta(days=2 * i), team, 2, True, "W" if i % 2 == 0 else "L",
             pts[i], 0.5, 0.3, 0.8, 1.0, 2.0, 3.0) for i in range(n)]
    return spark.createDataFrame(rows, "game_id string, season long, game_date date, team_id long, "
                                       "opponent_team_id long, is_home boolean, wl string, pts double, "
                                       "fg_pct double, fg3_pct double, ft_pct double, reb double, ast double, "
                                       "tov double")


def test_frame_excludes_current_game(spark):
    rows = V.team_form(_games(spark)).orderBy("game_date").collect()
    assert rows[0].pts_avg_l5 is None and rows[0].rest_days is None
    assert rows[1].pts_avg_l5 == 10.0 and rows[1].rest_days == 2
    assert rows[6].pts_avg_l5 == sum([20.0, 30.0, 40.0, 50.0, 60.0]) / 5
    assert rows[6].winrate_l5 == 2 / 5  # games 2..6 (indices 1..5): L W L W L


def test_later_or_current_changes_do_not_leak(spark):
    base = {r.game_id: r.pts_avg_l5 for r in V.team_form(_games(spark)).collect()}
    changed_pts = [10.0, 20.0, 30.0, 999.0, 50.0, 60.0, 70.0]
    changed = {r.game_id: r.pts_avg_l5 for r in V.team_form(_games(spark, pts=changed_pts)).collect()}
    for gid in ("g00", "g01", "g02", "g03"):  # rows at or before the change are identical
        assert base[gid] == changed[gid]
    assert base["g04"] != changed["g04"]


def test_chunked_window_equals_plain_window(spark, sf_dir):
    from formmart.plans.fixture_mart import mart_for
    games = V.v_games(mart_for(spark, sf_dir).tables.games)
    metrics = [("pts", "pts_avg_l5"), ("fg_pct", "fg_pct_avg_l5")]
    from formmart.operators.form import largest_entity
    assert largest_entity(games, ["team_id"]) > 7  # so chunk_rows=7 takes the chunked plan
    chunked = rolling_form(games, "team_id", metrics, n=5, chunk_rows=7)
    default = rolling_form(games, "team_id", metrics, n=5)  # fits: plain window plan
    w = Window.partitionBy("team_id").orderBy("game_date", "game_id")
    plain = games.select("*", *[F.avg(s).over(w.rowsBetween(-5, -1)).alias(o) for s, o in metrics])
    a = {(r.game_id, r.team_id): (r.pts_avg_l5, r.fg_pct_avg_l5) for r in chunked.collect()}
    b = {(r.game_id, r.team_id): (r.pts_avg_l5, r.fg_pct_avg_l5) for r in plain.collect()}
    c = {(r.game_id, r.team_id): (r.pts_avg_l5, r.fg_pct_avg_l5) for r in default.collect()}
    assert a == b == c


def test_opponent_features_mirror_and_wins_balance(spark, sf_dir):
    from formmart.plans.fixture_mart import mart_for
    m = mart_for(spark, sf_dir)
    ds = m.training_dataset()
    a = ds.alias("a")
    b = ds.alias("b")
    j = a.join(b, (F.col("a.game_id") == F.col("b.game_id")) & (F.col("a.opponent_team_id") == F.col("b.team_id")))
    bad = j.where(~F.col("a.opp_pts_avg_l5").eqNullSafe(F.col("b.pts_avg_l5"))
                  | ~F.col("a.opp_rest_days").eqNullSafe(F.col("b.rest_days"))
                  | (F.col("a.y_win") + F.col("b.y_win") != 1)).count()
    assert bad == 0
    g = m.v_games()
    counts = {r.wl: r["count"] for r in g.groupBy("wl").count().collect()}
    assert counts["W"] == counts["L"]


def test_star_top3_and_nulls(spark):
    rows = []
    # team-game A: 5 formed players, B: 2 formed, C: 0 formed (all null form)
    for pid, form in enumerate([30.0, 10.0, 20.0, 40.0, 5.0]):
        rows.append(("A", 1, pid, form, 30.0, 1.0))
    for pid, form in enumerate([7.0, None, 3.0]):
        rows.append(("B", 1, 10 + pid, form, 20.0, None))
    rows.append(("C", 1, 20, None, None, None))
    pf = spark.createDataFrame(rows, "game_id string, team_id long, player_id long, pts_avg_l5 double, "
                                     "min_avg_l5 double, pm_avg_l5 double").withColumn(
        "opponent_team_id", F.lit(2).cast("long")).withColumn("game_date", F.lit(D0))
    out = {r.game_id: r for r in V.team_star_features(pf).collect()}
    assert out["A"].star_pts_avg_l5_sum == 90.0
    assert out["B"].star_pts_avg_l5_sum == 10.0 and out["B"].star_pm_avg_l5_avg is None
    assert out["C"].star_pts_avg_l5_sum is None
    assert len(out) == 3


def test_leakage_violations_zero(spark, sf_dir):
    import __spark_entry__ as E
    rows = E.queries()["leakage_violations"](spark, sf_dir).collect()
    assert rows and all(r.violations == 0 for r in rows)


def test_mart_with_forced_chunking_equals_default(spark, sf_dir):
    from formmart.plans.fixture_mart import mart_for
    from formmart.plans.mart import Mart
    default = mart_for(spark, sf_dir)
    forced = Mart(spark, default.tables, chunk_rows=16)  # largest team and player exceed 16: chunked plan
    a, b = forced.training_dataset_enriched(), default.training_dataset_enriched()
    assert a.count() == b.count()
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_null_dates_never_dropped(spark):
    rows = [(f"g{i}", 1, None if i in (2, 5) else D0 + dt.timedelta(days=i), float(i)) for i in range(10)]
    df = spark.createDataFrame(rows, "game_id string, team_id long, game_date date, pts double")
    plain = rolling_form(df, "team_id", [("pts", "m")], n=3).collect()
    assert len(plain) == 10  # the plain window keeps them (nulls sort first)
    chunked = rolling_form(df, "team_id", [("pts", "m")], n=3, chunk_rows=4).collect()
    assert sorted(map(repr, chunked)) == sorted(map(repr, plain))  # and so does the chunked plan


def _two_join_reference(base, stars):
    own = stars.select(F.col("game_id").alias("g1"), F.col("team_id").alias("t1"), "star_pts_avg_l5_sum",
                       "star_min_avg_l5_avg", "star_pm_avg_l5_avg")
    opp = stars.select(F.col("game_id").alias("g2"), F.col("team_id").alias("t2"),
                       *[F.col(c).alias("opp_" + c) for c in ("star_pts_avg_l5_sum", "star_min_avg_l5_avg",
                                                             "star_pm_avg_l5_avg")])
    return (base.join(own, (base.game_id == own.g1) & (base.team_id == own.t1), "left")
                .join(opp, (base.game_id == opp.g2) & (base.opponent_team_id == opp.t2), "left")
                .drop("g1", "t1", "g2", "t2"))


def test_enrich_matches_two_joins(spark):
    base = spark.createDataFrame([("a", 1, 2), ("a", 2, 1), ("b", 3, 4), ("b", 4, 3), ("c", 5, 6)],
                                 "game_id string, team_id long, opponent_team_id long")
    cols = "game_id string, team_id long, star_pts_avg_l5_sum double, star_min_avg_l5_avg double, " \
           "star_pm_avg_l5_avg double"
    two_sided = spark.createDataFrame([("a", 1, 10.0, 1.0, None), ("a", 2, 20.0, 2.0, 0.5), ("b", 4, 40.0, 4.0, 4.5)],
                                      cols)  # game b has one side, game c none
    three_teams = two_sided.unionByName(spark.createDataFrame([("a", 9, 90.0, 9.0, 9.5)], cols))
    for stars in (two_sided, three_teams):
        got = V.enrich(base, stars)
        want = _two_join_reference(base, stars).select(*got.columns)
        assert got.count() == want.count()
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_one_entity_one_day_is_split(spark):
    """All events on one day of one entity (or of none) lie in several ranges, computed with one exchange of the rows."""
    from pyspark.sql import functions as F
    from formmart.operators import form as FO
    rows = [(None if e == 0 else e, dt.date(2020, 1, 1) if e < 2 else None, f"g{(i * 37) % 90:03d}", float(i)) for e in (0, 1, 2) for i in range(90)]
    df = spark.createDataFrame(rows, "team_id int, game_date date, game_id string, pts double")
    feats = {"m": FO.prev_mean("pts", 5), "p": FO.prev_value("pts", 3), "d": FO.days_since_previous()}
    was = spark.conf.get("spark.sql.shuffle.partitions")
    for parts in ("23", "3"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        try:
            out = FO.with_rolling(df, "team_id", "game_date", ["game_id"], feats, n=5, chunk_rows=6)
            want = FO.with_rolling(df, "team_id", "game_date", ["game_id"], feats, n=5)
            assert out.columns == want.columns
            assert sorted(map(tuple, out.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
            stored = out._jdf.queryExecution().analyzed().toString()
            plan = out._jdf.queryExecution().executedPlan().toString()
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", was)
        # what is shuffled after the ranges are written is keyed by range alone, for at most n rows of each
        assert "fm_form_ranges" in stored
        assert "hashpartitioning(team_id" not in plan.replace("_fm_part", "")
