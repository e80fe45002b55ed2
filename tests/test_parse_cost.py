"""Raw text is parsed once: no parser repeats the reading of a value in its branches."""

from pyspark.sql import functions as F

from formmart.functions import parse as P
from formmart.operators import standardize as STD


def _times(column, what):
    return str(column).count(what)


def test_numbers_are_read_once(spark):
    assert _times(P.to_numeric("c", clean=True), "try_cast") + _times(P.to_numeric("c", clean=True), "CAST") <= 2
    assert len(str(P.strict_long("c", clean=True))) < 2 * len(str(P.to_long("c", clean=True))) + 120
    assert len(str(P.parse_minutes("c", clean=True))) < 3500


def test_minutes_of_all_spellings(spark):
    want = {"12:30": 12.5, " 12 : 30 ": 12.5, "\u00a07:15\u2003": 7.25, "7\u00a0:\u00a030": 7.5, "33.5": 33.5, "x:10": None, "1:2:3": None,
            "": None, ":": None, "5:": None, "NaN:5": None, "NaN": None, "-1:30": -0.5, "1e1:0": 10.0, None: None}
    df = spark.createDataFrame([(k,) for k in want], "t string")
    assert {r.t: r.m for r in df.select("t", P.parse_minutes("t").alias("m")).collect()} == want


def test_strip_and_blanks(spark):
    texts = ["a", "~", "!", "\x7f", "\x7fa", "a\x7f", " a", "a\u3000", "\u00e9", "\u00a0", "", " ", "\x1fa", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    plain = F.btrim("t", F.lit(P.WHITE_SPACE))
    for r in df.select(P.strip("t").alias("s"), plain.alias("w"), P.blank_to_null("t").alias("b")).collect():
        assert r.s == r.w and r.b == (r.w or None)


def test_wide_parsers_are_compiled_in_a_plain_session(spark):
    key = "spark.sql.codegen.hugeMethodLimit"
    stated = spark.conf.get(key)
    spark.conf.unset(key)
    try:
        STD.standardize_teams(spark.createDataFrame([("1",)], "id string"))
        assert spark.conf.get(key) == "8000"
    finally:
        spark.conf.set(key, stated)
