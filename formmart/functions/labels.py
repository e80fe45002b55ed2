"""Numeric helpers and display labels as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio_round(num, den, digits: int = 3) -> Column:
    """num/den rounded half-up to ``digits`` decimals, exactly (integer arithmetic).

    Avoids double rounding of the binary quotient, so every engine agrees.
    """
    scale = 10 ** digits
    n, d = _c(num).cast("bigint"), _c(den).cast("bigint")
    a, b = F.lit(2 * scale) * n + d, F.lit(2) * d
    q = ((a - F.pmod(a, b)) / b).cast("bigint")  # floor(a / b) in exact integer arithmetic
    return q / F.lit(float(scale))


def quantize(c, digits: int = 9) -> Column:
    """x rounded half-up to ``digits`` decimals in plain double arithmetic:
    floor(x·10^d + 0.5) / 10^d.  Cheap (no decimal conversion) and evaluated
    identically by any IEEE engine, so it is also the canonical form results
    are compared in.  Values too large for the rounding to change a double stay as they are."""
    scale = float(10 ** digits)
    x = _c(c).cast("double")
    return F.when(F.abs(x) < 9e18 / scale, F.floor(x * scale + 0.5).cast("double") / scale).otherwise(x)


def quantize_sql(expr: str, digits: int = 9) -> str:
    """SQL text of :func:`quantize` (``+ 0.0`` folds a negative zero)."""
    return f"(floor(({expr}) * 1e{digits} + 0.5) / 1e{digits} + 0.0)"


def team_label(name="full_name", abbr="abbreviation") -> Column:
    """'Full Name (ABBR)'."""
    return F.concat(F.coalesce(_c(name).cast("string"), F.lit("None")), F.lit(" ("),
                    F.coalesce(_c(abbr).cast("string"), F.lit("None")), F.lit(")"))


def game_label(date="game_date", is_home="is_home", wl="wl", game_id="game_id") -> Column:
    """'yyyy-MM-dd — Home|Away — Result: W — game_id=…'."""
    loc = F.when(_c(is_home), F.lit("Home")).otherwise(F.lit("Away"))
    res = F.coalesce(F.upper(F.trim(_c(wl))), F.lit("NONE"))
    return F.concat(F.date_format(_c(date), "yyyy-MM-dd"), F.lit(" — "), loc, F.lit(" — Result: "), res,
                    F.lit(" — game_id="), _c(game_id).cast("string"))


def matchup_title(a_name, a_abbr, b_name, b_abbr, is_home) -> Column:
    """'A (AA) vs B (BB)' for a home game, 'A (AA) @ B (BB)' otherwise."""
    sep = F.when(_c(is_home), F.lit(" vs ")).otherwise(F.lit(" @ "))
    return F.concat(team_label(a_name, a_abbr), sep, team_label(b_name, b_abbr))


def percent_text(p) -> Column:
    """Probability as a percentage with two decimals ('53.20%').

    Hundredths of a percent are rounded half-up from p·10000 in integer form,
    so the text does not depend on a formatter's tie rule.
    """
    q = F.floor(_c(p) * 10000.0 + 0.5).cast("bigint")
    return F.concat((q / 100).cast("bigint").cast("string"), F.lit("."),
                    F.lpad(F.pmod(q, F.lit(100)).cast("string"), 2, "0"), F.lit("%"))
