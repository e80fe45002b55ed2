"""Adapter from the driver's TPC-H-like parquet tables to competition logs.

A *team* is a supplier, a *game* an order and a *player* a part.  The two sides
of a game are the smallest and the largest supplier on the order; orders with a
single supplier are not games.  A side's box score aggregates its lineitems.
Players (parts) are assigned to the home side when the part key is even, else
to the away side.

Everything here is lazy DataFrame code over the whole input tables; the
standard tables are materialized once per application (see
``formmart.plans.mart``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from formmart.operators.joins import hot_keys, salted_join
from formmart.session import input_bytes


def driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fixture_teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = driver_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    n = driver_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = driver_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    # nation and region are fixed-size dimensions (25 and 5 rows): broadcast.
    return (s.join(F.broadcast(n), s.s_nationkey == n.n_nationkey)
             .join(F.broadcast(r), n.n_regionkey == r.r_regionkey)
             .select(F.col("s_suppkey").cast("bigint").alias("team_id"),
                     F.col("s_name").alias("full_name"),
                     F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("abbreviation"),
                     F.col("n_name").alias("city"),
                     F.col("r_name").alias("state"),
                     F.lit(None).cast("int").alias("year_founded")))


#: Bytes of lineitem files for each partition of its rows by order: small enough for the aggregates of a task to stay in memory.
ORDER_BYTES = 8 << 20


def _by_order(li: DataFrame, sf_dir: str, *keys: str) -> DataFrame:
    """The lineitems dealt by ``keys`` (the order first), unless one order is too large for a task."""
    spark = li.sparkSession
    if hot_keys(li, "l_orderkey") is not None:
        return li
    n = input_bytes(spark, [f"{sf_dir.rstrip('/')}/lineitem.parquet"]) // ORDER_BYTES
    return li.repartition(max(n, int(spark.conf.get("spark.sql.shuffle.partitions"))), *keys)


def fixture_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Team-game rows with a bigint ``game_id`` (the order key).

    One lineitem-sized exchange, by order (see :func:`_by_order`): the box score
    per (order, supplier), an order's sides (smallest and largest supplier) and
    the opponent's points then need no other; only the orders come to them.  With
    a hot order the box score is aggregated map-side before its exchange instead,
    so no task ever receives all lineitems of such an order.
    """
    li = _by_order(driver_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_suppkey", "l_linenumber", "l_quantity", "l_discount", "l_tax"), sf_dir, "l_orderkey")
    box = li.groupBy("l_orderkey", "l_suppkey").agg(
        F.sum("l_quantity").alias("pts"),
        F.sum("l_linenumber").cast("double").alias("reb"),
        F.count(F.lit(1)).cast("double").alias("ast"),
        F.max("l_linenumber").cast("double").alias("tov"),
        F.max("l_discount").alias("fg_pct"),
        F.min("l_discount").alias("fg3_pct"),
        F.max("l_tax").alias("ft_pct"),
    )
    order = Window.partitionBy("l_orderkey")
    sides = (box.withColumn("home_id", F.min("l_suppkey").over(order)).withColumn("away_id", F.max("l_suppkey").over(order))
                .where((F.col("home_id") < F.col("away_id")) & F.col("l_suppkey").isin(F.col("home_id"), F.col("away_id")))
                .withColumn("is_home", F.col("l_suppkey") == F.col("home_id"))
                .withColumn("opponent_team_id", F.when(F.col("is_home"), F.col("away_id")).otherwise(F.col("home_id"))))
    orders = driver_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    d = F.col("o_orderdate")
    rows = (sides.join(orders, sides.l_orderkey == orders.o_orderkey)
                 .withColumn("season", (F.year(d) - F.when(F.month(d) < 10, 1).otherwise(0)).cast("bigint"))
                 .withColumn("game_date", F.to_date(d)))
    game = Window.partitionBy("l_orderkey")
    # each sum covers exactly one row of the pair, so the value is copied exactly
    home_pts = F.sum(F.when(F.col("is_home"), F.col("pts"))).over(game)
    away_pts = F.sum(F.when(~F.col("is_home"), F.col("pts"))).over(game)
    opp_pts = F.when(F.col("is_home"), away_pts).otherwise(home_pts)
    win = (F.col("pts") > opp_pts) | ((F.col("pts") == opp_pts) & F.col("is_home"))
    return rows.select(
        F.col("l_orderkey").alias("game_id"), "season", "game_date",
        F.col("l_suppkey").alias("team_id"), "opponent_team_id", "is_home",
        F.when(win, "W").otherwise("L").alias("wl"),
        "pts", "fg_pct", "fg3_pct", "ft_pct", "reb", "ast", "tov")


def fixture_player_games(spark: SparkSession, sf_dir: str, games: DataFrame) -> DataFrame:
    """Player-game rows; ``games`` is the (materialized) bigint-keyed game table.

    The join on (order, side) salts hot orders explicitly (see
    :func:`formmart.operators.joins.salted_join`): the one game row of a hot
    key is replicated per salt, the hot key's lineitems spread over the salts.
    Without hot orders the lineitems move once, by (order, side), and are
    aggregated where they were joined.
    """
    li = (driver_table(spark, sf_dir, "lineitem")
          .select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_discount", "l_tax")
          .withColumn("is_home", F.col("l_partkey") % 2 == 0))
    li = _by_order(li, sf_dir, "l_orderkey", "is_home")
    g = games.select(F.col("game_id").alias("l_orderkey"), "is_home", "season", "game_date",
                     "team_id", "opponent_team_id", "wl")
    joined = salted_join(li, g, ["l_orderkey", "is_home"])
    return (joined.groupBy(F.col("l_partkey").alias("player_id"), F.col("l_orderkey").alias("game_id"), "season", "game_date",
                           "team_id", "opponent_team_id", "is_home", "wl")
            .agg(F.sum("l_quantity").alias("minutes"),
                 F.sum("l_quantity").alias("pts"),
                 F.count(F.lit(1)).cast("double").alias("reb"),
                 F.max("l_linenumber").cast("double").alias("ast"),
                 F.min("l_linenumber").cast("double").alias("tov"),
                 (F.sum("l_linenumber") - 3).cast("double").alias("plus_minus"),
                 F.max("l_discount").alias("fg_pct"),
                 F.min("l_discount").alias("fg3_pct"),
                 F.max("l_tax").alias("ft_pct"),
                 F.lit(0.0).alias("stl"),
                 F.lit(0.0).alias("blk"),
                 F.sum("l_linenumber").cast("double").alias("pf")))


def fixture_players(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = driver_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size")
    blank = F.instr(F.col("p_name"), " ")
    return p.select(
        F.col("p_partkey").cast("bigint").alias("player_id"),
        F.col("p_name").alias("full_name"),
        F.substring_index(F.col("p_name"), " ", 1).alias("first_name"),
        F.when(blank > 0, F.expr("substr(p_name, instr(p_name, ' ') + 1)")).alias("last_name"),
        (F.col("p_size") > 25).alias("is_active"),
    )


# Portable SQL of the same adapter (valid in DuckDB); the oracle queries start
# with it.  Standard tables carry a string game_id.
ORACLE_PREFIX = """
teams AS (SELECT CAST(s_suppkey AS BIGINT) AS team_id, s_name AS full_name,
          concat('S', CAST(s_suppkey AS VARCHAR)) AS abbreviation,
          n_name AS city, r_name AS state, CAST(NULL AS INTEGER) AS year_founded
          FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
sides AS (SELECT l_orderkey AS game_id, min(l_suppkey) AS home_id, max(l_suppkey) AS away_id
          FROM lineitem GROUP BY l_orderkey HAVING min(l_suppkey) < max(l_suppkey)),
box AS (SELECT l_orderkey AS game_id, l_suppkey AS team_id, sum(l_quantity) AS pts,
        CAST(sum(l_linenumber) AS DOUBLE) AS reb, CAST(count(*) AS DOUBLE) AS ast,
        CAST(max(l_linenumber) AS DOUBLE) AS tov,
        max(l_discount) AS fg_pct, min(l_discount) AS fg3_pct, max(l_tax) AS ft_pct
        FROM lineitem GROUP BY l_orderkey, l_suppkey),
s AS (SELECT game_id, home_id AS team_id, away_id AS opponent_team_id, TRUE AS is_home FROM sides
      UNION ALL SELECT game_id, away_id, home_id, FALSE FROM sides),
games_raw AS (SELECT s.game_id,
          CAST(year(o_orderdate) - CASE WHEN month(o_orderdate) < 10 THEN 1 ELSE 0 END AS BIGINT) AS season,
          CAST(o_orderdate AS DATE) AS game_date, s.team_id, s.opponent_team_id, s.is_home,
          CASE WHEN a.pts > b.pts OR (a.pts = b.pts AND s.is_home) THEN 'W' ELSE 'L' END AS wl,
          a.pts, a.fg_pct, a.fg3_pct, a.ft_pct, a.reb, a.ast, a.tov
          FROM s JOIN box a ON s.game_id = a.game_id AND s.team_id = a.team_id
                 JOIN box b ON s.game_id = b.game_id AND s.opponent_team_id = b.team_id
                 JOIN orders ON o_orderkey = s.game_id),
games AS (SELECT CAST(game_id AS VARCHAR) AS game_id, season, game_date, team_id, opponent_team_id, is_home, wl,
          pts, fg_pct, fg3_pct, ft_pct, reb, ast, tov FROM games_raw),
player_games AS (SELECT l_partkey AS player_id, CAST(l_orderkey AS VARCHAR) AS game_id, g.season, g.game_date,
                 g.team_id, g.opponent_team_id, g.is_home, g.wl,
                 sum(l_quantity) AS minutes, sum(l_quantity) AS pts, CAST(count(*) AS DOUBLE) AS reb,
                 CAST(max(l_linenumber) AS DOUBLE) AS ast, CAST(min(l_linenumber) AS DOUBLE) AS tov,
                 CAST(sum(l_linenumber) - 3 AS DOUBLE) AS plus_minus,
                 max(l_discount) AS fg_pct, min(l_discount) AS fg3_pct, max(l_tax) AS ft_pct,
                 CAST(0 AS DOUBLE) AS stl, CAST(0 AS DOUBLE) AS blk, CAST(sum(l_linenumber) AS DOUBLE) AS pf
                 FROM lineitem JOIN games_raw g ON g.game_id = l_orderkey AND g.is_home = (l_partkey % 2 = 0)
                 GROUP BY l_partkey, l_orderkey, g.season, g.game_date, g.team_id, g.opponent_team_id, g.is_home, g.wl),
players AS (SELECT CAST(p_partkey AS BIGINT) AS player_id, p_name AS full_name,
            split_part(p_name, ' ', 1) AS first_name,
            CASE WHEN strpos(p_name, ' ') > 0 THEN substr(p_name, strpos(p_name, ' ') + 1) END AS last_name,
            p_size > 25 AS is_active FROM part)
"""
