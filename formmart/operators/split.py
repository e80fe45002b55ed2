"""Time-ordered train/validation/test split with exact row counts.

The newest ``round(n·test_size)`` rows are test, the ``round(n·val_size)``
before them validation, the rest train (counts rounded half-to-even).  Order
is (date, *tie columns), a total order; nulls come first, so rows without a
date count as the oldest.

The order is found on two levels.  A histogram by day (map-side combined, one
row a day) tells in which days the two cuts fall; only the rows of such days
are ranked, and not even those where a cut falls between two days.  A day's
rows are range-split by their own key (sampled bounds keep a crowded day from
landing in one task), each part counts its rows, and the row at the cut is
looked up.  The split itself is a plain projection that compares each row's
day, and inside a cut day its key, with the cuts; no key of another day is
sorted, shuffled or written.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def split_counts(n: int, test_size: float = 0.2, val_size: float = 0.1) -> tuple[int, int, int]:
    n_test = int(round(n * test_size))
    n_val = int(round(n * val_size))
    n_train = max(n - n_test - n_val, 0)
    return n_train, n - n_train - n_test, n_test


def keys_at_ranks(df: DataFrame, order: Sequence[str], ranks: Sequence[int],
                  partitions: int | None = None) -> dict[int, tuple]:
    """Key tuples of the rows at the given 0-based ranks of the (unique) order."""
    ranks = sorted({r for r in ranks})
    if not ranks:
        return {}
    spark = df.sparkSession
    p = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Sampled range bounds must not change between the count pass and the
    # lookup pass: checkpoint the sorted key columns once (reliable storage
    # under spark.checkpoint.dir, so a lost executor cannot reshuffle them).
    from formmart.session import work_dir
    work_dir(spark)
    ranged = (df.select(*order).repartitionByRange(p, *order).sortWithinPartitions(*order)
                .checkpoint(eager=True))
    tagged = ranged.withColumn("_pid", F.spark_partition_id())
    sizes = sorted((r["_pid"], r["count"]) for r in tagged.groupBy("_pid").count().collect())
    targets, start = [], 0
    for pid, cnt in sizes:
        for r in ranks:
            if start <= r < start + cnt:
                targets.append((pid, r - start, r))
        start += cnt
    mid = F.monotonically_increasing_id()
    picked = (ranged.withColumn("_mid", mid)
                    .where(F.col("_mid").isin([(pid << 33) + loc for pid, loc, _ in targets]))
                    .collect())
    by_mid = {row["_mid"]: tuple(row[c] for c in order) for row in picked}
    return {r: by_mid[(pid << 33) + loc] for pid, loc, r in targets}


def _before(cols: Sequence[Column], key: Sequence) -> Column:
    """Rows whose columns come before ``key`` in ascending order, nulls first."""
    cond = F.lit(False)
    for c, v in reversed(list(zip(cols, key))):
        if v is None:
            cond = c.isNull() & cond
        else:
            cond = c.isNull() | (c < F.lit(v)) | ((c == F.lit(v)) & cond)
    return cond


def day_histogram(df: DataFrame, day: Column) -> list[tuple]:
    """(day, rows) in order, null first; one row for each calendar day that occurs."""
    rows = df.groupBy(day.alias("day")).agg(F.count(F.lit(1)).alias("n")).collect()
    return sorted(((r.day, r.n) for r in rows), key=lambda x: (x[0] is not None, x[0]) if x[0] else (False,))


def cut_days(days: Sequence[tuple], ranks) -> dict[int, tuple]:
    """For each 0-based rank that occurs its day, and its rank inside that day."""
    cuts, start = {}, 0
    for d, n in days:
        cuts.update({r: (d, r - start) for r in ranks if start <= r < start + n})
        start += n
    return cuts


def time_split(df: DataFrame, date_col: str = "game_date", test_size: float = 0.2, val_size: float = 0.1,
               tie_cols: Sequence[str] = ("game_id", "team_id"), split_col: str = "split") -> DataFrame:
    """``df`` with ``split_col``; rows that repeat a whole key (date and ties) stay on one side of a cut."""
    order = [date_col, *tie_cols]
    day = F.to_date(F.col(date_col))
    days = day_histogram(df, day)
    n_train, n_val, _ = split_counts(sum(n for _, n in days), test_size, val_size)
    starts = {"val": n_train, "test": n_train + n_val}
    cuts = cut_days(days, starts.values())
    inside = {r: at for r, at in cuts.items() if at[1]}
    keys = {}
    for cut_day in {d for d, _ in inside.values()}:
        rows = df.where(day.eqNullSafe(F.lit(cut_day).cast("date")))
        wanted = {at: r for r, (d, at) in inside.items() if d == cut_day}
        keys.update({wanted[at]: key for at, key in keys_at_ranks(rows, order, list(wanted)).items()})

    def older(rank: int) -> Column:
        """Rows before the one at ``rank``."""
        if rank not in cuts:
            return F.lit(True)
        cut_day, _ = cuts[rank]
        earlier = _before([day], [cut_day])
        if rank not in keys:
            return earlier
        same = day.eqNullSafe(F.lit(cut_day).cast("date"))
        return earlier | (same & _before([F.col(c) for c in order], keys[rank]))

    label = F.when(older(starts["val"]), F.lit("train")).when(older(starts["test"]), F.lit("val")).otherwise(F.lit("test"))
    return df.withColumn(split_col, label)
