"""Golden tables for the column-expression parsers."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from formmart.functions import parse as P


def _one(spark, col_fn, values, schema="x string"):
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [r[0] for r in df.select(col_fn(F.col("x"))).collect()]


def test_matchup(spark):
    vals = ["MEM vs. OKC", "ORL @ BOS", "a VS b", "X", None, "A - B", "  lal   vs   gsw ", "A @@ B"]
    df = spark.createDataFrame([(v,) for v in vals], "x string")
    got = [tuple(r) for r in df.select(P.parse_matchup("x").alias("m")).select("m.*").collect()]
    assert got == [("MEM", "OKC", True), ("ORL", "BOS", False), ("A", "B", True), (None, None, None),
                   (None, None, None), (None, None, None), ("LAL", "GSW", True), (None, None, None)]


def test_minutes(spark):
    got = _one(spark, P.parse_minutes, ["34:30", "12", "12.5", "x:10", "1:2:3", None, " 7:06 "])
    assert got[0] == pytest.approx(34.5)
    assert got[1:3] == [12.0, 12.5]
    assert got[3:6] == [None, None, None]
    assert got[6] == pytest.approx(7.1)


def test_dates_and_season(spark):
    got = _one(spark, P.parse_date, ["2020-10-27", "Oct 27, 2020", "OCT 01, 2020", "09/30/2020", "garbage", "", None])
    assert got == [dt.date(2020, 10, 27), dt.date(2020, 10, 27), dt.date(2020, 10, 1), dt.date(2020, 9, 30),
                   None, None, None]
    df = spark.createDataFrame([(dt.date(2020, 9, 30),), (dt.date(2020, 10, 1),)], "d date")
    assert [r[0] for r in df.select(P.season_start("d")).collect()] == [2019, 2020]


def test_numeric_and_bool(spark):
    assert _one(spark, P.to_numeric, [" 12 ", "1e2", "n/a", "NaN", "", None]) == [12.0, 100.0, None, None, None, None]
    assert _one(spark, P.to_long, ["2019", "2019.0", "2019.5", "x"]) == [2019, 2019, None, None]
    assert _one(spark, P.parse_bool, ["True", "false", "1", "0", "home", None]) == [True, False, True, False, None, None]
    assert _one(spark, P.clean_id, ["0022000001", "007", "0", " 12 ", "G01"]) == ["22000001", "7", "0", "12", "G01"]


def test_strict_id_raises(spark):
    df = spark.createDataFrame([("12",), ("abc",)], "x string")
    with pytest.raises(Exception):
        df.select(P.strict_long("x")).collect()


def test_percent_text(spark):
    from formmart.functions.labels import percent_text, ratio_round
    df = spark.createDataFrame([(0.532,), (0.125,), (0.00005,), (1.0,), (0.0,)], "p double")
    assert [r[0] for r in df.select(percent_text("p")).collect()] == ["53.20%", "12.50%", "0.01%", "100.00%",
                                                                      "0.00%"]
    r = spark.createDataFrame([(1, 8), (27, 200), (2, 3), (0, 5)], "n long, d long")
    assert [x[0] for x in r.select(ratio_round("n", "d", 3)).collect()] == [0.125, 0.135, 0.667, 0.0]


def test_more_date_forms(spark):
    import datetime as dt
    from formmart.functions.parse import parse_date
    day = dt.date(2020, 10, 27)
    good = ["2020-10-27", "2020-10-27 00:00", "2020-10-27T00:00:00.000", "2020-10-27 00:00:00.000", "2020-10-27T00:00:00Z",
            "October 27, 2020", "27 Oct 2020", "Oct 27, 2020", "10/27/2020", "20201027", "\t2020-10-27 "]
    bad = ["2020-13-27", "27th of May", "", "x", None]
    df = spark.createDataFrame([(x,) for x in good + bad], "d string")
    assert [r[0] for r in df.select(parse_date("d")).collect()] == [day] * len(good) + [None] * len(bad)


def test_white_space_of_any_kind_and_ids(spark):
    from formmart.functions.parse import clean_id, clean_wl, parse_matchup
    df = spark.createDataFrame([("\tMEM vs. OKC\n", "w\t", "001B"), ("ORL @ BOS", " L ", " 007 ")],
                               "m string, wl string, id string")
    rows = df.select(parse_matchup("m").alias("m"), clean_wl("wl").alias("wl"), clean_id("id").alias("id")).collect()
    assert [(r.m.team, r.m.opponent, r.m.is_home, r.wl, r.id) for r in rows] == [
        ("MEM", "OKC", True, "W", "001B"), ("ORL", "BOS", False, "L", "7")]


def test_order_of_large_differences(spark):
    """Differences beyond the quantum keep their order."""
    from formmart.functions.labels import quantize
    df = spark.createDataFrame([(1e10,), (5e10,), (-9.3e9,), (0.1234567894,), (None,)], "x double")
    assert [r[0] for r in df.select(quantize("x")).collect()] == [1e10, 5e10, -9.3e9, 0.123456789, None]
