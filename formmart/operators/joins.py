"""Size-checked broadcast for dimension joins.

Without column statistics Spark estimates a join's size as the product of its
inputs, so a small dimension built from joins (teams = supplier ⋈ nation ⋈
region) looks huge and the fact side gets shuffled; AQE only switches to a
broadcast after that shuffle has been written.  Here the dimension is measured
once (a count, cached per plan) and broadcast only when its estimated size
fits under the session's broadcast threshold; otherwise the join stays a
shuffle join.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from formmart.session import shuffles_deleted

_ROWS: dict[tuple, int] = {}
_LOCK = threading.Lock()

_WIDTH = {T.StringType: 32, T.LongType: 8, T.DoubleType: 8, T.IntegerType: 4, T.DateType: 4,
          T.BooleanType: 1, T.TimestampType: 8, T.TimestampNTZType: 8, T.ShortType: 2, T.FloatType: 4}


def _row_width(df: DataFrame) -> int:
    return 16 + sum(_WIDTH.get(type(f.dataType), 16) for f in df.schema.fields)


def _threshold(df: DataFrame) -> int:
    raw = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760")
    raw = raw.strip().lower()
    mult = {"b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20, "g": 1 << 30, "gb": 1 << 30}
    for suffix in ("kb", "mb", "gb", "k", "m", "g", "b"):
        if raw.endswith(suffix):
            return int(float(raw[: -len(suffix)]) * mult[suffix])
    return int(raw)


def measured_rows(df: DataFrame) -> int:
    key = (df.sparkSession.sparkContext.applicationId, df.semanticHash())
    with _LOCK:
        if key in _ROWS:
            return _ROWS[key]
    with shuffles_deleted(df.sparkSession):
        n = df.count()
    with _LOCK:
        _ROWS[key] = n
    return n


def small_side(df: DataFrame) -> DataFrame:
    """``F.broadcast(df)`` when its measured size fits the broadcast threshold, else ``df``."""
    limit = _threshold(df)
    if limit < 0:
        return df
    return F.broadcast(df) if measured_rows(df) * _row_width(df) <= limit else df


def hot_keys(df: DataFrame, keys, max_rows: int = 1 << 20) -> DataFrame | None:
    """(keys, _fm_salts) of the keys with more than ``max_rows`` rows, a task's fair load at any size.

    ``_fm_salts`` is how many tasks such a key is dealt to.  Returns None when there
    are none (the common case, one small job).
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_fm_rows"))
    with shuffles_deleted(df.sparkSession):
        most = per_key.agg(F.max("_fm_rows")).first()[0] or 0
    if most <= max_rows:
        return None
    return per_key.where(F.col("_fm_rows") > max_rows).select(
        *keys, F.ceil(F.col("_fm_rows") / max_rows).cast("int").alias("_fm_salts"))


SALTED = ("inner", "left", "left_semi", "left_anti")


def salted_join(big: DataFrame, small: DataFrame, keys, how: str = "inner", max_rows: int = 1 << 20) -> DataFrame:
    """Equi-join on ``keys`` that splits the hot keys of ``big`` across tasks.

    Rows of a hot key are dealt to its salts by a hash of the whole row, which a
    task that runs again repeats; the matching ``small`` rows are copied once for
    each salt.  Other keys are joined as usual.  Joins that keep unmatched rows
    of ``small`` would repeat them for each salt and are refused.
    """
    if how not in SALTED:
        raise ValueError(f"a salted join is one of {', '.join(SALTED)}")
    keys = [keys] if isinstance(keys, str) else list(keys)
    hot = hot_keys(big, keys, max_rows)
    if hot is None:
        return big.join(small, keys, how)
    hot = small_side(hot)
    salts = F.coalesce(F.col("_fm_salts"), F.lit(1))
    b = (big.join(hot, keys, "left")
         .withColumn("_fm_salt", F.pmod(F.xxhash64(*big.columns), salts).cast("int")).drop("_fm_salts"))
    s = small.join(hot, keys, "left").withColumn("_fm_salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("_fm_salts")
    return b.join(s, [*keys, "_fm_salt"], how).drop("_fm_salt")
