"""Registered queries: profiling, leakage check, split, imputation medians,
metrics on a fixed score, calibration, matchup probability and comparison."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from formmart import schemas as S
from formmart.functions.labels import quantize, quantize_sql
from formmart.operators import compare as CMP
from formmart.operators import metrics as M
from formmart.operators import profile as PR
from formmart.operators.quantiles import exact_medians
from formmart.operators.split import time_split
from formmart.plans.fixture_mart import mart_for
from formmart.plans.mart import materialize
from formmart.plans.oracle_sql import with_views
from formmart.plans.q_analytics import _ENR
from formmart.plans.registry import register
from formmart.session import scratch_path

DS = "v_training_dataset_enriched"
NUMERIC = [c for c in _ENR if c not in ("game_id", "game_date", "is_home")]
FEATURES = [c for c in _ENR if c not in S.NON_FEATURES]


def r9(expr: str) -> str:
    return quantize_sql(expr)


def R9(c):
    return quantize(c)


def _ds(spark, sf_dir):
    return mart_for(spark, sf_dir).dataset()


@register("profile_coverage", with_views(
    f'SELECT count(*) AS "rows", min(game_date) AS start_date, max(game_date) AS end_date, '
    f"count(DISTINCT team_id) AS num_teams, count(DISTINCT game_id) AS num_games FROM {DS}"))
def q_profile_coverage(spark, sf_dir):
    return PR.coverage(_ds(spark, sf_dir))


@register("profile_coverage_sketch", with_views(
    f'SELECT CAST(year(game_date) AS INTEGER) AS year, count(*) AS "rows", min(game_date) AS start_date, max(game_date) AS end_date, '
    f"count(DISTINCT team_id) AS exact_teams, count(DISTINCT game_id) AS exact_games, true AS teams_within, true AS games_within "
    f"FROM {DS} GROUP BY 1"))
def q_profile_coverage_sketch(spark, sf_dir):
    """Coverage by year from the stored sketches of days, held against the exact counts (five standard errors)."""
    ds = _ds(spark, sf_dir)
    year = F.year("day").alias("year")
    guess = PR.coverage_estimate(materialize(PR.coverage_sketches(ds), "coverage_sketches"), year)
    dated = ds.select(F.year("game_date").alias("year"), "team_id", "game_id")
    exact = [dated.select("year", c).distinct().groupBy("year").agg(F.count(c).alias(n))
             for c, n in (("team_id", "exact_teams"), ("game_id", "exact_games"))]
    near = lambda a, b: F.abs(F.col(a) - F.col(b)) <= 5 * PR.SKETCH_ERROR * F.col(b)
    return guess.join(exact[0], "year").join(exact[1], "year").select(
        "year", "rows", "start_date", "end_date", "exact_teams", "exact_games",
        near("num_teams", "exact_teams").alias("teams_within"), near("num_games", "exact_games").alias("games_within"))


@register("profile_target", with_views(
    f"SELECT y_win, count(*) AS count, {r9('count(*) / sum(count(*)) OVER ()')} AS share FROM {DS} GROUP BY y_win"))
def q_profile_target(spark, sf_dir):
    return PR.target_distribution(_ds(spark, sf_dir)).withColumn("share", R9("share"))


@register("profile_missing", with_views(
    "SELECT column_name, " + r9("missing_pct") + " AS missing_pct FROM (" + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, avg(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) * CAST(100 AS DOUBLE) "
        f"AS missing_pct FROM {DS}" for c in _ENR) + ") ORDER BY missing_pct DESC, column_name LIMIT 25"))
def q_profile_missing(spark, sf_dir):
    return PR.missing_share(_ds(spark, sf_dir)).withColumn("missing_pct", R9("missing_pct"))


@register("baseline_accuracy", with_views(
    f"SELECT {r9('avg(CASE WHEN CAST(winrate_l5 > opp_winrate_l5 AS INTEGER) = y_win THEN 1 ELSE 0 END)')} "
    f"AS baseline_accuracy FROM {DS}"))
def q_baseline_accuracy(spark, sf_dir):
    return PR.baseline_accuracy(_ds(spark, sf_dir)).withColumn("baseline_accuracy", R9("baseline_accuracy"))


def _corr_sql(c: str) -> str:
    x = f"CASE WHEN {c} IS NOT NULL AND y_win IS NOT NULL THEN CAST({c} AS DOUBLE) END"
    y = f"CASE WHEN {c} IS NOT NULL AND y_win IS NOT NULL THEN CAST(y_win AS DOUBLE) END"
    return (f"SELECT '{c}' AS column_name, covar_pop({x}, {y}) / nullif(stddev_pop({x}) * stddev_pop({y}), 0) "
            f"AS corr_with_y_win FROM {DS}")


@register("profile_corr", with_views(
    f"SELECT column_name, {r9('corr_with_y_win')} AS corr_with_y_win FROM ("
    + " UNION ALL ".join(_corr_sql(c) for c in NUMERIC)
    + ") ORDER BY corr_with_y_win DESC NULLS LAST, column_name LIMIT 20"))
def q_profile_corr(spark, sf_dir):
    return PR.correlations(_ds(spark, sf_dir)).withColumn("corr_with_y_win", R9("corr_with_y_win"))


def _hist_sql(col: str, bins: int = 30) -> str:
    return (f", v AS (SELECT CAST({col} AS DOUBLE) AS x FROM {DS} WHERE {col} IS NOT NULL), "
            "mm AS (SELECT CASE WHEN min(x) = max(x) THEN min(x) - 0.5 ELSE min(x) END AS lo, "
            "CASE WHEN min(x) = max(x) THEN max(x) + 0.5 ELSE max(x) END AS hi FROM v), "
            f"c AS (SELECT CAST(least(floor((x - lo) / (hi - lo) * CAST({bins} AS DOUBLE)), {bins - 1}) AS INTEGER) "
            "AS bin, count(*) AS cnt FROM v, mm GROUP BY 1) "
            f"SELECT r.bin, lo + CAST(r.bin AS DOUBLE) * (hi - lo) / CAST({bins} AS DOUBLE) AS bin_start, "
            f"lo + CAST(r.bin + 1 AS DOUBLE) * (hi - lo) / CAST({bins} AS DOUBLE) AS bin_end, "
            f"coalesce(c.cnt, 0) AS count FROM (SELECT CAST(range AS INTEGER) AS bin FROM range({bins})) r "
            "CROSS JOIN mm LEFT JOIN c ON c.bin = r.bin")


@register("profile_hist_winrate", with_views(_hist_sql("winrate_l5")))
def q_profile_hist_winrate(spark, sf_dir):
    return PR.histogram(_ds(spark, sf_dir), "winrate_l5")


@register("profile_hist_rest", with_views(_hist_sql("rest_days")))
def q_profile_hist_rest(spark, sf_dir):
    return PR.histogram(_ds(spark, sf_dir), "rest_days")


_LEAK = list(S.TEAM_FORM_METRICS) + [("y_win", "winrate_l5")]


@register("leakage_violations", with_views(
    ", r AS (SELECT *, row_number() OVER (PARTITION BY team_id ORDER BY game_date, game_id) AS rn FROM v_team_form), "
    "m AS (SELECT a.team_id, a.rn, " + ", ".join(f"avg(b.{s}) AS m_{s}" for s, _ in _LEAK)
    + " FROM r a LEFT JOIN r b ON b.team_id = a.team_id AND b.rn BETWEEN a.rn - 5 AND a.rn - 1 GROUP BY 1, 2), "
    "j AS (SELECT * FROM r JOIN m USING (team_id, rn)) " + " UNION ALL ".join(
        f"SELECT '{o}' AS feature, count(*) AS rows_checked, CAST(sum(CASE WHEN ({o} IS NULL AND m_{s} IS NULL) "
        f"OR abs({o} - m_{s}) <= 1e-9 THEN 0 ELSE 1 END) AS BIGINT) AS violations FROM j" for s, o in _LEAK)))
def q_leakage_violations(spark, sf_dir):
    return PR.leakage_violations(mart_for(spark, sf_dir).team_form(), _LEAK)


SPLIT_CTE = (f", rk AS (SELECT *, row_number() OVER (ORDER BY game_date, game_id, team_id) - 1 AS r, "
             f"count(*) OVER () AS n FROM {DS}), "
             "sp AS (SELECT *, CASE WHEN r >= n - round_even(n * 0.2, 0) THEN 'test' "
             "WHEN r >= n - round_even(n * 0.2, 0) - round_even(n * 0.1, 0) THEN 'val' ELSE 'train' END AS split "
             "FROM rk)")


def _split(spark, sf_dir):
    """The split of the mart's dataset; its cut keys are computed once per mart."""
    m = mart_for(spark, sf_dir)
    return m.memo("time_split", lambda: time_split(m.dataset()))


@register("time_split", with_views(SPLIT_CTE + " SELECT game_id, team_id, game_date, y_win, split FROM sp"))
def q_time_split(spark, sf_dir):
    return _split(spark, sf_dir).select("game_id", "team_id", "game_date", "y_win", "split")


@register("split_counts", with_views(SPLIT_CTE + ' SELECT split, count(*) AS "rows" FROM sp GROUP BY split'))
def q_split_counts(spark, sf_dir):
    return _split(spark, sf_dir).groupBy("split").agg(F.count(F.lit(1)).alias("rows"))


def _train_medians(spark, sf_dir):
    """Train rows and their exact feature medians (computed once per mart)."""
    m = mart_for(spark, sf_dir)
    train = _split(spark, sf_dir).where(F.col("split") == "train")
    train = train.withColumn("is_home", F.col("is_home").cast("double"))
    return train, m.memo("train_medians", lambda: exact_medians(train, FEATURES))


_MEDIANS_SQL = with_views(
    SPLIT_CTE + " SELECT feature, " + r9("median") + " AS median FROM (" + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, median(CAST({c} AS DOUBLE)) AS median FROM sp WHERE split = 'train'"
        for c in FEATURES) + ")")


@register("ml_impute_medians", _MEDIANS_SQL)
def q_ml_impute_medians(spark, sf_dir):
    _, med = _train_medians(spark, sf_dir)
    return spark.createDataFrame([(c, med[c]) for c in FEATURES], "feature string, median double").withColumn(
        "median", R9("median"))


@register("ml_impute_medians_large", _MEDIANS_SQL)
def q_ml_impute_medians_large(spark, sf_dir):
    """The same medians with brackets narrowed to a 4,096th of a column before they are collected."""
    train, _ = _train_medians(spark, sf_dir)
    med = exact_medians(train, FEATURES, buckets=1 << 12)
    return spark.createDataFrame([(c, med[c]) for c in FEATURES], "feature string, median double").withColumn(
        "median", R9("median"))


@register("ml_imputed", with_views(
    SPLIT_CTE + ", med AS (SELECT " + ", ".join(f"median(CAST({c} AS DOUBLE)) AS m_{c}" for c in FEATURES)
    + " FROM sp WHERE split = 'train') SELECT game_id, team_id, " + ", ".join(
        f"{r9(f'coalesce(CAST({c} AS DOUBLE), m_{c})')} AS {c}" for c in FEATURES)
    + " FROM sp, med WHERE split = 'train'"))
def q_ml_imputed(spark, sf_dir):
    from formmart.plans.learn import impute
    train, med = _train_medians(spark, sf_dir)
    out = impute(train, med)
    return out.select("game_id", "team_id", *[R9(c).alias(c) for c in FEATURES])


@register("ml_imputed_splits", with_views(
    SPLIT_CTE + ", med AS (SELECT " + ", ".join(f"median(CAST({c} AS DOUBLE)) AS m_{c}" for c in FEATURES)
    + " FROM sp WHERE split = 'train') SELECT game_id, team_id, split, " + ", ".join(
        f"{r9(f'coalesce(CAST({c} AS DOUBLE), m_{c})')} AS {c}" for c in FEATURES)
    + " FROM sp, med"))
def q_ml_imputed_splits(spark, sf_dir):
    """The rows of every split, imputed with the medians of train."""
    from formmart.plans.learn import impute
    _, med = _train_medians(spark, sf_dir)
    out = impute(_split(spark, sf_dir).withColumn("is_home", F.col("is_home").cast("double")), med)
    return out.select("game_id", "team_id", "split", *[R9(c).alias(c) for c in FEATURES])


SCORE_CTE = f", sc AS (SELECT *, y_win AS y, (winrate_l5 + 1 - opp_winrate_l5) / 2 AS p FROM {DS})"


def _scored(spark, sf_dir):
    """A deterministic stand-in probability: the two sides' recent win rates."""
    ds = _ds(spark, sf_dir)
    return ds.withColumn("y", F.col("y_win")).withColumn(
        "p", (F.col("winrate_l5") + 1 - F.col("opp_winrate_l5")) / 2)


@register("metric_accuracy", with_views(
    SCORE_CTE + f" SELECT {r9('avg(CASE WHEN CAST(p >= 0.5 AS INTEGER) = y THEN 1 ELSE 0 END)')} AS accuracy FROM sc"))
def q_metric_accuracy(spark, sf_dir):
    return M.accuracy(_scored(spark, sf_dir)).withColumn("accuracy", R9("accuracy"))


@register("metric_logloss", with_views(
    SCORE_CTE + ", c AS (SELECT y, least(greatest(p, 2.220446049250313e-16), 1 - 2.220446049250313e-16) AS q FROM sc) "
    f"SELECT {r9('-avg(CAST(y AS DOUBLE) * ln(q) + (1 - CAST(y AS DOUBLE)) * ln(1 - q))')} AS log_loss FROM c"))
def q_metric_logloss(spark, sf_dir):
    return M.log_loss(_scored(spark, sf_dir)).withColumn("log_loss", R9("log_loss"))


@register("metric_auc", with_views(
    SCORE_CTE + ", rk AS (SELECT y, (2 * rank() OVER (ORDER BY p) + count(*) OVER (PARTITION BY p) - 1) "
    "/ CAST(2 AS DOUBLE) AS ar FROM sc) SELECT CASE WHEN sum(y) > 0 AND sum(1 - y) > 0 THEN "
    + r9("(sum(CASE WHEN y = 1 THEN ar ELSE 0 END) - sum(y) * (sum(y) + 1) / CAST(2 AS DOUBLE)) "
         "/ (CAST(sum(y) AS DOUBLE) * sum(1 - y))") + " END AS roc_auc FROM rk"))
def q_metric_auc(spark, sf_dir):
    return M.roc_auc(_scored(spark, sf_dir)).withColumn("roc_auc", R9("roc_auc"))


@register("calibration", with_views(
    SCORE_CTE + ", e AS (SELECT quantile_cont(p, [" + ", ".join(str(i / 10) for i in range(1, 10)) + "]) AS q FROM sc) "
    "SELECT CAST(" + " + ".join(f"CAST(p > q[{i}] AS INTEGER)" for i in range(1, 10)) + " AS INTEGER) AS bin, "
    + r9("avg(p)") + " AS mean_predicted, " + r9("avg(CAST(y AS DOUBLE))") + " AS fraction_positive, "
    'count(*) AS "rows" FROM sc, e GROUP BY 1'))
def q_calibration(spark, sf_dir):
    c = M.calibration(_scored(spark, sf_dir))
    return c.select(F.col("bin").cast("int").alias("bin"), R9("mean_predicted").alias("mean_predicted"),
                    R9("fraction_positive").alias("fraction_positive"), "rows")


@register("matchup_probability", with_views(
    SCORE_CTE + ", pr AS (SELECT a.game_id, a.team_id, a.opponent_team_id, a.p AS pa, b.p AS pb, "
    "CASE WHEN a.p + b.p > 0 THEN a.p / (a.p + b.p) ELSE a.p END AS pn "
    "FROM sc a JOIN sc b ON a.game_id = b.game_id AND a.opponent_team_id = b.team_id), "
    "pq AS (SELECT *, CAST(floor(pn * CAST(10000 AS DOUBLE) + 0.5) AS BIGINT) AS q FROM pr) "
    f"SELECT game_id, team_id, opponent_team_id, {r9('pa')} AS p_team, {r9('pb')} AS p_opponent, "
    f"{r9('pn')} AS p_norm, concat(CAST(q // 100 AS VARCHAR), '.', lpad(CAST(q % 100 AS VARCHAR), 2, '0'), '%') "
    "AS p_norm_text FROM pq"))
def q_matchup_probability(spark, sf_dir):
    out = M.matchup_probability(_scored(spark, sf_dir))
    return out.select("game_id", "team_id", "opponent_team_id",
                      *[R9(c).alias(c) for c in ("p_team", "p_opponent", "p_norm")], "p_norm_text")


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


GLOSSARY_SQL = "gl AS (SELECT * FROM (VALUES " + ", ".join(
    f"({_q(k)}, {_q(v)})" for k, v in sorted(S.GLOSSARY.items())) + ") t(indicator, explanation))"
_IND = list(S.COMPARE_DEFAULTS) + list(S.STAR_FEATURES)


@register("matchup_compare", with_views(
    ", " + GLOSSARY_SQL + ", lng AS (" + " UNION ALL ".join(
        f"SELECT game_id, team_id, opponent_team_id, '{c}' AS indicator, {i} AS ordinal, "
        f"CAST({c} AS DOUBLE) AS team_value, CAST(opp_{c} AS DOUBLE) AS opponent_value FROM {DS}"
        for i, c in enumerate(_IND)) + ") "
    "SELECT game_id, team_id, opponent_team_id, l.indicator, coalesce(gl.explanation, '') AS explanation, "
    + r9("team_value") + " AS team_value, " + r9("opponent_value") + " AS opponent_value, "
    + r9("team_value - opponent_value") + " AS difference, CAST(row_number() OVER (PARTITION BY game_id, team_id "
    "ORDER BY abs(" + quantize_sql("team_value - opponent_value") + ") DESC NULLS LAST, ordinal) AS INTEGER) "
    "AS position "
    "FROM lng l LEFT JOIN gl ON gl.indicator = l.indicator"))
def q_matchup_compare(spark, sf_dir):
    out = CMP.matchup_compare(_ds(spark, sf_dir), CMP.glossary_frame(spark))
    return out.select("game_id", "team_id", "opponent_team_id", "indicator", "explanation",
                      *[R9(c).alias(c) for c in ("team_value", "opponent_value", "difference")], "position")


@register("src_glossary", with_views(
    ", " + GLOSSARY_SQL + ", nn AS (" + " UNION ALL ".join(
        f"SELECT '{c}' AS indicator, count({c}) AS non_null_rows FROM {DS}" for c in sorted(S.GLOSSARY))
    + ") SELECT gl.indicator, gl.explanation, nn.non_null_rows FROM gl JOIN nn USING (indicator)"))
def q_src_glossary(spark, sf_dir):
    """Glossary JSON file (written from the fixed values) joined with each indicator's coverage."""
    path = scratch_path(spark, "glossary")
    # written through Spark, so it lands on whatever file system the shared folder is on
    (spark.createDataFrame([(json.dumps(S.GLOSSARY, ensure_ascii=False),)], "value string")
          .coalesce(1).write.mode("overwrite").text(path))
    gl = CMP.read_glossary(spark, path)
    ds = _ds(spark, sf_dir)
    cols = [c for c in sorted(S.GLOSSARY) if c in ds.columns]
    nn = ds.agg(*[F.count(c).alias(c) for c in cols]).unpivot([], cols, "indicator", "non_null_rows")
    return gl.join(nn, "indicator")
