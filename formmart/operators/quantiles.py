"""Exact order statistics by narrowing brackets over wide rows.

A wanted rank of a column is held in a bracket, a closed range of values that
contains it, with the number of values below and inside.  One pass over the
rows works for all brackets of all columns at once, without exploding them:

* first histograms, a few passes: each task counts the values of a bracket in
  ``BINS`` bins of equal width (of the doubles' order, so any range narrows by
  that factor), with the least and the greatest value of each; the bin that
  holds the rank is the new bracket.  What they leave open goes on by sketches;
* a mergeable sketch (``percentile_approx``) of each bracket's values proposes
  a pivot at the wanted rank and a narrower range around it;
* the next pass counts, for each proposal, the values below the range, in it
  below the pivot, equal to the pivot, and in it above the pivot.  The counts
  are exact, so they tell which of these parts holds the rank, whatever the
  sketch's error; the same pass sketches the proposed range for the next one.

A bracket is done when its rank falls on the pivot or when at most
``BRACKET_VALUES`` values are inside: these are then collected, for all such
brackets in one pass, together with the least value above each bracket, which
the next rank may need.  Every pass drops at least the
pivot, and a sketch of relative error e leaves a few e of the values, so the
passes grow with the logarithm of the rows.  Nothing but aggregates (a
histogram's bins, a sketch) leaves a partition: there is no exchange of (column, value) pairs and no task that
holds a column.  Quantiles interpolate linearly between neighbouring order
statistics, like ``numpy.percentile`` and SQL ``quantile_cont``.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Values of a bracket that are collected instead of being narrowed again.
BRACKET_VALUES = 1 << 11
#: Sketch accuracy (ranks are off by at most n / SKETCH) and how far around a rank the next range reaches.
SKETCH = 1000
MARGIN = 3.0 / SKETCH
#: Parts of a range whose place in the order isn't known yet.
GRID = 100
#: Bins of a bracket's histogram (a power of two), and passes that make them before sketches go on.
BINS = 1 << 11
HISTOGRAMS = 4
#: Aggregates in one pass, so that a pass's expressions stay of a size that compiles.
PASS_AGGREGATES = 400


@dataclass(eq=False)
class Bracket:
    """``rank`` of a column lies in [lo, hi]; with ``pair`` the rank after it is wanted too."""
    col: str
    rank: int
    pair: bool
    inside: int                     # values in [lo, hi]
    below: int = 0                  # values under lo
    lo: float = -math.inf
    hi: float = math.inf
    ask: tuple[float, float, float] | None = None    # proposed lo, pivot, hi


def _value(col: str) -> Column:
    x = F.col(f"`{col}`").cast("double")
    return F.when(~F.isnan(x), x + F.lit(0.0))  # adding 0 makes -0.0 the equal 0.0


def _within(x: Column, lo: float, hi: float) -> Column:
    cond = x.isNotNull()
    if lo != -math.inf:
        cond = cond & (x >= F.lit(lo))
    if hi != math.inf:
        cond = cond & (x <= F.lit(hi))
    return cond


def _in_passes(df: DataFrame, exprs: list[Column]) -> list:
    """Values of aggregates, in as few passes as ``PASS_AGGREGATES`` allows."""
    out = []
    for at in range(0, len(exprs), PASS_AGGREGATES):
        part = exprs[at:at + PASS_AGGREGATES]
        out += list(df.agg(*[e.alias(f"a{i}") for i, e in enumerate(part)]).first())
    return out


def _sketch(col: str, lo: float, hi: float, probs: Sequence[float]) -> Column:
    x = _value(col)
    return F.percentile_approx(F.when(_within(x, lo, hi), x), F.array(*[F.lit(p) for p in probs]), F.lit(SKETCH))


def _known(b: Bracket) -> Column:
    """The value at the bracket's rank, and those a margin around it."""
    at = (b.rank - b.below) / max(1, b.inside - 1)
    return _sketch(b.col, b.lo, b.hi, (max(0.0, at - MARGIN), at, min(1.0, at + MARGIN)))


def _counted(b: Bracket) -> list[Column]:
    """Counts of the proposal's parts, and a grid of the values in it."""
    x = _value(b.col)
    lo, pivot, hi = b.ask
    return [F.count_if(_within(x, b.lo, b.hi) & (x < lo)), F.count_if((x >= lo) & (x < pivot)), F.count_if(x == pivot),
            F.count_if((x > pivot) & (x <= hi)), _sketch(b.col, lo, hi, [i / GRID for i in range(GRID + 1)])]


def _settle(b: Bracket, under: int, low: int, equal: int, high: int, grid: Sequence[float] | None) -> None:
    """Move the bracket into the part of its proposal that holds the rank, and propose again where the grid reaches."""
    (lo, pivot, hi), b.ask = b.ask, None
    after = b.below + b.inside
    a, c, d, e = (b.below + n for n in (under, under + low, under + low + equal, under + low + equal + high))
    if b.rank < a:
        b.hi, b.inside = math.nextafter(lo, -math.inf), under
        return
    if b.rank >= e:
        b.lo, b.below, b.inside = math.nextafter(hi, math.inf), e, after - e
        return
    if b.rank < c:
        b.lo, b.hi, b.below, b.inside = lo, math.nextafter(pivot, -math.inf), a, low
    elif b.rank < d:
        b.lo, b.hi, b.below, b.inside = pivot, pivot, c, equal
        return
    else:
        b.lo, b.hi, b.below, b.inside = math.nextafter(pivot, math.inf), hi, d, high
    if grid:
        at = GRID * (b.rank - a) / max(1, e - a - 1)
        near = (grid[max(0, math.floor(at) - 2)], grid[round(at)], grid[min(GRID, math.ceil(at) + 2)])
        near = tuple(min(max(v, b.lo), b.hi) for v in near)
        # a pivot must be a value of the bracket
        b.ask = near if near[1] in grid else None


def _key(x: float) -> int:
    """The place of a double in the order of all doubles, a signed 64-bit integer."""
    bits = struct.unpack("<q", struct.pack("<d", x))[0]
    return bits if bits >= 0 else bits ^ ((1 << 63) - 1)


def _double(key: int) -> float:
    return struct.unpack("<d", struct.pack("<q", key if key >= 0 else key ^ ((1 << 63) - 1)))[0]


def _by_histogram(wide: DataFrame, brackets: list[Bracket]) -> None:
    """Move each bracket to the bin, between its least and greatest value, that holds the rank."""
    cols = list(dict.fromkeys(b.col for b in brackets))
    jobs = []
    for i, b in enumerate(brackets):
        lo, hi = _key(b.lo), _key(b.hi)
        jobs.append((i, cols.index(b.col), b.rank - b.below, lo, hi, max(0, (hi - lo).bit_length() - BINS.bit_length() + 1)))
    bins = BINS

    def counted(batches):
        seen = {job[0]: (np.zeros(bins, np.int64), np.full(bins, np.iinfo(np.int64).max), np.full(bins, np.iinfo(np.int64).min)) for job in jobs}
        for batch in batches:
            keys = []
            for column in batch.columns:
                x = column.to_numpy(zero_copy_only=False).astype(np.float64)
                bits = x[~np.isnan(x)].view(np.int64)
                keys.append(np.sort(np.where(bits >= 0, bits, bits ^ np.int64((1 << 63) - 1))))
            for i, c, _, lo, hi, shift in jobs:
                k = keys[c][np.searchsorted(keys[c], lo):np.searchsorted(keys[c], hi, side="right")]
                if len(k):
                    # differences of up to 64 bits, without sign
                    at = ((k.view(np.uint64) - np.int64(lo).view(np.uint64)) >> np.uint64(shift)).astype(np.int64)
                    first = np.flatnonzero(np.diff(at, prepend=-1))
                    last = np.append(first[1:], len(at)) - 1
                    n, least, most = seen[i]
                    n[at[first]] += last - first + 1
                    least[at[first]] = np.minimum(least[at[first]], k[first])
                    most[at[first]] = np.maximum(most[at[first]], k[last])
        for i, _, rank, *_ in jobs:
            n, least, most = seen[i]
            there = np.flatnonzero(n)
            yield pa.RecordBatch.from_pydict({
                "bracket": pa.array(np.full(len(there), i), pa.int64()), "rank": pa.array(np.full(len(there), rank), pa.int64()),
                "bin": pa.array(there, pa.int64()), "n": pa.array(n[there]), "least": pa.array(least[there]), "most": pa.array(most[there])})

    rows = wide.select(*[_value(c).alias(f"c{i}") for i, c in enumerate(cols)]).mapInArrow(
        counted, "bracket long, rank long, bin long, n long, least long, most long")
    hist = rows.groupBy("bracket", "rank", "bin").agg(F.sum("n").alias("n"), F.min("least").alias("least"), F.max("most").alias("most"))
    before = Window.partitionBy("bracket").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)  # at most BINS rows
    placed = hist.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    for r in placed.where((F.col("rank") >= F.col("before")) & (F.col("rank") < F.col("before") + F.col("n"))).collect():
        b = brackets[r.bracket]
        b.lo, b.hi, b.below, b.inside = _double(r.least), _double(r.most), b.below + r.before, r.n


def order_statistics(df: DataFrame, cols: Sequence[str], ranks: dict[str, set[int]] | None = None,
                     probs: Sequence[float] = (), buckets: int | None = None) -> tuple[dict, dict]:
    """Return ({col: n_non_null}, {(col, rank): value}) for the requested 0-based ranks.

    If ``ranks`` is None, the ranks needed for ``probs`` (linear interpolation)
    are requested.  Null and NaN values are left out; columns without a value
    have no entry.  With ``buckets``, brackets are collected once they hold a
    column's share of 1 / buckets.
    """
    cols = list(dict.fromkeys(cols))
    wide = df.select(*[F.col(f"`{c}`") for c in cols])
    counts = {c: n for c, n in zip(cols, _in_passes(wide, [F.count(_value(c)) for c in cols])) if n}
    if ranks is None:
        ranks = {c: {r for p in probs for r in _neighbours(n, p)} for c, n in counts.items()}
    open_: list[Bracket] = []
    for c, wanted in ranks.items():
        for r in sorted(wanted) if c in counts else []:
            if not 0 <= r < counts[c]:
                raise ValueError(f"no rank {r} among {counts[c]} values")
            if open_ and open_[-1].col == c and open_[-1].rank == r - 1 and not open_[-1].pair:
                open_[-1].pair = True
            else:
                open_.append(Bracket(c, r, False, counts[c]))
    limit = {c: max(1, n // buckets) if buckets else BRACKET_VALUES for c, n in counts.items()}
    done: list[Bracket] = []
    histograms = HISTOGRAMS
    while open_:
        done += [b for b in open_ if b.lo == b.hi or b.inside <= limit[b.col]]
        open_ = [b for b in open_ if b.lo != b.hi and b.inside > limit[b.col]]
        if open_ and histograms:
            histograms -= 1
            _by_histogram(wide, open_)
            continue
        asked = [b for b in open_ if b.ask]
        rest = [b for b in open_ if not b.ask]
        got = iter(_in_passes(wide, [e for b in asked for e in _counted(b)] + [_known(b) for b in rest]))
        for b in asked:
            _settle(b, *[next(got) for _ in range(5)])
        for b in rest:
            b.ask = tuple(next(got))
    return counts, _read(wide, done)


def _read(wide: DataFrame, brackets: list[Bracket]) -> dict[tuple[str, int], float]:
    """Values of the ranks in small brackets: those inside, and the next greater value for a pair."""
    exprs = []
    for b in brackets:
        x = _value(b.col)
        if b.lo != b.hi:
            exprs.append(F.sort_array(F.collect_list(F.when(_within(x, b.lo, b.hi), x))))
        if b.pair:
            exprs.append(F.min(F.when(x > b.hi, x)))
    got = iter(_in_passes(wide, exprs))
    values = {}
    for b in brackets:
        inside = [b.lo] if b.lo == b.hi else next(got)
        at = 0 if b.lo == b.hi else b.rank - b.below
        values[(b.col, b.rank)] = inside[at]
        if b.pair:
            above = next(got)
            more = b.rank + 1 < b.below + b.inside
            values[(b.col, b.rank + 1)] = (inside[at] if b.lo == b.hi else inside[at + 1]) if more else above
    return values


def _neighbours(n: int, p: float) -> tuple[int, int]:
    at = int(math.floor((n - 1) * p))
    return at, min(at + 1, n - 1)


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                    buckets: int | None = None) -> dict[str, list[float | None]]:
    """Linear-interpolation quantiles of each column (None for an all-null column)."""
    counts, vals = order_statistics(df, cols, probs=probs, buckets=buckets)
    out = {}
    for c in cols:
        n = counts.get(c, 0)
        if n == 0:
            out[c] = [None] * len(probs)
            continue
        res = []
        for p in probs:
            lo, hi = _neighbours(n, p)
            a, b = vals[(c, lo)], vals[(c, hi)]
            t = (n - 1) * p - lo
            res.append(a if t == 0 or a == b else a + (b - a) * t)
        out[c] = res
    return out


def exact_medians(df: DataFrame, cols: Sequence[str], buckets: int | None = None) -> dict[str, float | None]:
    """Median of each column over its non-null values (midpoint for an even count)."""
    counts, vals = order_statistics(df, cols, probs=(0.5,), buckets=buckets)
    out = {}
    for c in cols:
        n = counts.get(c, 0)
        if n == 0:
            out[c] = None
            continue
        lo, hi = (n - 1) // 2, n // 2
        out[c] = vals[(c, lo)] if lo == hi else (vals[(c, lo)] + vals[(c, hi)]) / 2.0
    return out
