"""Tolerant parsers for raw text columns, written as native column expressions.

All of them return null for text they cannot read, except :func:`strict_long`,
which fails the job on a bad identifier, as the standardization contract asks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from formmart.schemas import DATE_FORMATS


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


#: The characters with Unicode's White_Space property.
WHITE_SPACE = "".join(map(chr, (*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))


def strip(c) -> Column:
    """Without white space at either end, of any Unicode kind (tabs, no-break spaces)."""
    t = _c(c)
    return F.when(_bare(t), t).otherwise(F.btrim(t, F.lit(WHITE_SPACE)))


def _bare(t: Column) -> Column:
    """Most text begins and ends with a printed ASCII character (bytes from ! to ~): there is nothing to strip."""
    end = F.substring(t, -1, 1)
    return (t >= "!") & (t < "\x7f") & (end >= "!") & (end < "\x7f")


def blank_to_null(c) -> Column:
    t = _c(c)
    stripped = F.btrim(t, F.lit(WHITE_SPACE))
    return F.when(_bare(t), t).when(stripped != "", stripped)


def _text(c, clean: bool) -> Column:
    """Stripped text, blanks null; ``clean`` text already is."""
    return _c(c) if clean else blank_to_null(c)


def to_numeric(c, clean: bool = False) -> Column:
    """Number or null; NaN becomes null so it cannot poison averages."""
    return F.nanvl(_text(c, clean).try_cast("double"), F.lit(None).cast("double"))


def to_long(c, clean: bool = False) -> Column:
    """Tolerant integer: plain integer text directly; otherwise through double, so
    '2019.0' reads as 2019 and fractions give null."""
    x = to_numeric(c, clean)
    return F.coalesce(_text(c, clean).try_cast("bigint"), F.when(x == F.floor(x), x.cast("bigint")))


def strict_long(c, what: str = "id", clean: bool = False) -> Column:
    """Integer identifier; a non-integer value fails the job (nulls pass through)."""
    x = to_long(c, clean)
    bad = F.raise_error(F.concat(F.lit(f"invalid {what}: "), _c(c).cast("string"))).cast("bigint")
    return F.when(_c(c).isNotNull(), F.coalesce(x, bad))


def parse_date(c, formats: Sequence[tuple[str, str]] = DATE_FORMATS, clean: bool = False) -> Column:
    """First (format, shape) whose shape matches and whose format parses wins, then Spark's
    own reading of timestamps (ISO forms with fractions or a zone).

    Month names match case-insensitively.  The shape check keeps formats from
    being attempted on text they cannot read; text that starts with four digits
    and a dash tries the ISO forms alone.
    """
    t = _text(c, clean)
    iso = t.rlike(r"^\d{4}-")
    plain = F.when(t.rlike(r"^\d{4}-\d{2}-\d{2}$"), t.try_cast("date"))
    tried = lambda of: [F.when(t.rlike(shape), F.try_to_timestamp(t, F.lit(fmt))).cast("date")
                        for fmt, shape in formats if fmt.startswith("yyyy-") == of]
    return F.coalesce(plain, F.when(iso, F.coalesce(*tried(True), F.try_to_timestamp(t).cast("date")))
                      .otherwise(F.coalesce(*tried(False))))


def season_start(d) -> Column:
    """Season start year: seasons start in October."""
    d = _c(d)
    return (F.year(d) - F.when(F.month(d) < 10, 1).otherwise(0)).cast("bigint")


def parse_matchup(c, clean: bool = False) -> Column:
    """'AAA vs. BBB' → (AAA, BBB, home); 'AAA @ BBB' → (AAA, BBB, away); else nulls.

    Whitespace-split; at least three tokens; a middle token containing 'vs'
    (any case) means home, exactly '@' means away.  Abbreviations upper-cased.
    """
    parts = F.split(_c(c) if clean else strip(c), r"(?U)\s+")
    ok = _c(c).isNotNull() & (F.size(parts) >= 3)
    mid = F.get(parts, 1)
    home = F.when(ok & F.lower(mid).contains("vs"), F.lit(True)).when(ok & (mid == "@"), F.lit(False))
    valid = home.isNotNull()
    return F.struct(
        F.when(valid, F.upper(F.get(parts, 0))).alias("team"),
        F.when(valid, F.upper(F.get(parts, 2))).alias("opponent"),
        home.alias("is_home"),
    )


def parse_minutes(c, clean: bool = False) -> Column:
    """Minutes played from a number or 'MM:SS' (split at the first colon)."""
    t = _c(c) if clean else strip(_c(c).cast("string"))
    has_colon = F.instr(t, ":") > 0
    mm = F.substring_index(t, ":", 1)
    ss = t.substr(F.instr(t, ":") + 1, F.lit(1 << 30))
    # numbers without white space inside are read as they are, the rest part by part
    plain = F.nanvl(mm.try_cast("double") + ss.try_cast("double") / 60.0, F.lit(None).cast("double"))
    mins = F.coalesce(plain, to_numeric(mm) + to_numeric(ss) / 60.0)
    return F.when(has_colon, mins).otherwise(to_numeric(t, clean=True))


def parse_bool(c, clean: bool = False) -> Column:
    """true/false, t/f, yes/no, y/n, 1/0 (any case); anything else null."""
    t = F.lower(_text(c, clean))
    n = to_numeric(t, clean=True)
    return F.coalesce(t.try_cast("boolean"), F.when(n == 1, True).when(n == 0, False))


def clean_wl(c, clean: bool = False) -> Column:
    """Upper-cased, trimmed result letter; null stays null."""
    return F.upper(_c(c) if clean else strip(c))


def clean_id(c, clean: bool = False) -> Column:
    """Identifier text without surrounding blanks; of all-digit ids also without leading zeros ('007' → '7')."""
    t = _text(c, clean)
    return F.when(t.startswith("0"), F.regexp_replace(t, r"^0+(?=\d+$)", "")).otherwise(t)
