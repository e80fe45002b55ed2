"""Leakage-safe rolling features at entity-event grain.

Each feature of row *r* is computed over the previous ``n`` rows of the same
entity (frame ``ROWS BETWEEN n PRECEDING AND 1 PRECEDING``), so the current
event never feeds its own feature.  Rows are totally ordered by the date and
then by tie-break columns (the source orders by date only, which leaves
same-day events in arbitrary order).

Skew: a plain ``Window.partitionBy(entity)`` puts every event of an entity in
one task.  The plan is chosen from a checked size, like a broadcast: one small
aggregate gives the largest entity's event count.  When it fits in
``chunk_rows``, the plain window (one exchange) is used.  Otherwise the events
are range-partitioned by (entity, date, ties), also one exchange, so neither an
entity nor an (entity, day) is one task; the last ``n`` rows before each range
are carried over its border as read-only rows, and the window runs inside the
ranges.  This is exact for any frame reaching at most ``n`` rows back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from formmart.session import shuffles_deleted
from formmart.sources.tables import bucketed_table

DEFAULT_CHUNK_ROWS = 1 << 20

_RANK, _HALO = "_fm_rank", "_fm_halo"
_PART, _PLACE, _NTH, _OWN = "_fm_part", "_fm_place", "_fm_nth", "_fm_own"


def _cols(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def entity_rank(df: DataFrame, entity, date_col: str, tie_cols: Sequence[str],
                rank_col: str = _RANK) -> DataFrame:
    """Append the exact 0-based position of each row within its entity.

    Order is (date_col, *tie_cols).  No task ever sorts a whole entity: day
    counts are aggregated map-side, offsets come from a window over the (small)
    per-day table, and row numbers are taken within (entity, day).
    """
    keys = _cols(entity)
    per_day = df.groupBy(*keys, date_col).agg(F.count(F.lit(1)).alias("_fm_n"))
    before = Window.partitionBy(*keys).orderBy(date_col).rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_day.select(*keys, date_col,
                             F.coalesce(F.sum("_fm_n").over(before), F.lit(0)).alias("_fm_off"))
    within = Window.partitionBy(*keys, date_col).orderBy(*tie_cols)
    # null-safe, so that rows without an entity or a date are ranked as in a plain window
    there = offsets.select(*[F.col(c).alias(f"_fm_k{i}") for i, c in enumerate([*keys, date_col])], "_fm_off")
    same = None
    for i, c in enumerate([*keys, date_col]):
        term = F.col(c).eqNullSafe(F.col(f"_fm_k{i}"))
        same = term if same is None else same & term
    return (df.join(there, same).drop(*[f"_fm_k{i}" for i in range(len(keys) + 1)])
              .withColumn(rank_col, F.col("_fm_off") + F.row_number().over(within) - 1)
              .drop("_fm_off"))


def rank_rows(df: DataFrame, entity, date_col: str, tie_cols: Sequence[str], rank_col: str = _RANK,
              chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """0-based position within the entity: a plain row number when the largest
    entity fits in ``chunk_rows``, else the two-level :func:`entity_rank`."""
    keys = _cols(entity)
    if largest_entity(df, keys) <= chunk_rows:
        w = Window.partitionBy(*keys).orderBy(date_col, *tie_cols)
        return df.withColumn(rank_col, F.row_number().over(w) - 1)
    return entity_rank(df, keys, date_col, tie_cols, rank_col)


def largest_entity(df: DataFrame, keys: Sequence[str]) -> int:
    """Event count of the biggest entity (map-side partial counts, tiny result)."""
    with shuffles_deleted(df.sparkSession):
        n = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_fm_n")).agg(F.max("_fm_n")).first()[0]
    return int(n or 0)


def with_rolling(df: DataFrame, entity, date_col: str, tie_cols: Sequence[str],
                 features: dict[str, Column], n: int = 5,
                 chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """Add window features computed per entity over a (date, ties) order.

    ``features`` maps output name → a function of the ordered window that
    returns the feature column (see :func:`prev_mean`, :func:`prev_value`,
    :func:`days_since_previous`).  The same functions are bound to the plain
    or the chunked window.  No feature may look back more than ``n`` rows.
    """
    if chunk_rows <= n:
        raise ValueError("chunk_rows must exceed the look-back n")
    keys = _cols(entity)
    if largest_entity(df, keys) <= chunk_rows:
        w = Window.partitionBy(*keys).orderBy(date_col, *tie_cols)
        return df.select("*", *[f(w).alias(name) for name, f in features.items()])
    return _by_ranges(df, keys, [date_col, *tie_cols], features, n)


def _by_ranges(df: DataFrame, keys: list[str], order: list[str], features: dict[str, Column], n: int) -> DataFrame:
    """Window features over ranges of (entity, order), one exchange of the rows.

    The ranges are written once, bucketed by their number, so every later step
    reads them as they lie.  ``halo`` has for each range the last ``n`` rows of
    its first entity before it: a range's tail is sent to the ``n`` ranges after
    it (each has at least one row, so no row of interest is farther), and those
    of the right entity and the last n of them are kept.  The halo joins its
    range's first row and is opened there, ahead of it.
    """
    spark = df.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = (df.repartitionByRange(ranges, *keys, *order).sortWithinPartitions(*keys, *order)
              .withColumn(_PART, F.spark_partition_id())
              .withColumn(_PLACE, F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))))
    rows = bucketed_table(placed, "form_ranges", _PART, ranges, sort=False)

    firsts = rows.where(F.col(_PLACE) == 0).select(_PART, *[F.col(k).alias(f"_fm_f{i}") for i, k in enumerate(keys)])
    numbered = firsts.withColumn(_NTH, F.row_number().over(Window.orderBy(_PART)))  # a row a range
    ends = Window.partitionBy(_PART).orderBy(F.desc(_PLACE))
    tails = (rows.withColumn("_fm_back", F.row_number().over(ends)).where(F.col("_fm_back") <= n).drop("_fm_back")
             .join(numbered.select(_PART, _NTH), _PART))
    sent = tails.select(F.struct(*df.columns).alias("_fm_row"), F.col(_NTH).alias("_fm_from"), _PLACE,
                        F.explode(F.sequence(F.col(_NTH) + 1, F.col(_NTH) + n)).alias(_NTH))
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col("_fm_row").getField(k).eqNullSafe(F.col(f"_fm_f{i}"))
    arrived = sent.join(numbered, _NTH).where(same)
    nearest = Window.partitionBy(_PART).orderBy(F.desc("_fm_from"), F.desc(_PLACE))
    halo = (arrived.withColumn("_fm_back", F.row_number().over(nearest)).where(F.col("_fm_back") <= n)
            .groupBy(_PART).agg(F.collect_list("_fm_row").alias(_HALO)))

    own = F.array(F.struct(F.struct(*df.columns).alias("row"), F.lit(True).alias("own")))
    before = F.transform(_HALO, lambda r: F.struct(r.alias("row"), F.lit(False).alias("own")))
    opened = F.when((F.col(_PLACE) == 0) & F.col(_HALO).isNotNull(), F.concat(before, own)).otherwise(own)
    spread = rows.join(halo, _PART, "left").select(_PART, F.explode(opened).alias("_fm_x"))
    spread = spread.select(_PART, "_fm_x.own", *[F.col("_fm_x.row").getField(c).alias(c) for c in df.columns]).withColumnRenamed("own", _OWN)
    w = Window.partitionBy(_PART, *keys).orderBy(*order)
    out = spread.select("*", *[f(w).alias(name) for name, f in features.items()])
    return out.where(_OWN).drop(_PART, _OWN)


# Feature builders: each returns a function of the ordered window.

def prev_mean(c: Column | str, n: int = 5):
    """Mean of the previous ``n`` rows (nulls skipped; null when none)."""
    c = F.col(c) if isinstance(c, str) else c
    return lambda w: F.avg(c).over(w.rowsBetween(-n, -1))


def prev_value(c: Column | str, offset: int = 1):
    """Value ``offset`` rows back (LAG)."""
    c = F.col(c) if isinstance(c, str) else c
    return lambda w: F.lag(c, offset).over(w)


def days_since_previous(date_col: str = "game_date"):
    """Day difference to the entity's previous event; null for the first."""
    return lambda w: F.datediff(F.col(date_col), F.lag(F.col(date_col), 1).over(w)).cast("bigint")


def rolling_form(df: DataFrame, entity, metrics: Sequence[tuple[str, str]], n: int = 5,
                 date_col: str = "game_date", tie_cols: Sequence[str] = ("game_id",),
                 extra: dict | None = None, chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """Rolling means of ``metrics`` ((source, output) pairs) over the previous n rows."""
    feats = dict(extra or {})
    for src, name in metrics:
        feats[name] = prev_mean(src, n)
    return with_rolling(df, entity, date_col, tie_cols, feats, n=n, chunk_rows=chunk_rows)
