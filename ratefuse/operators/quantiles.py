"""Exact quantiles of whole columns, found in rounds of counting.

A quantile lies between two values of known rank.  Each rank starts in the bracket between the
minimum and the maximum of its column; a round counts the rows of every open bracket by bin,
and the running sums say which bin holds the rank.  The smallest and the largest value of that
bin are the next bracket, so brackets are always tight, and a rank is settled when they are
equal.  Nothing is sorted and nothing is estimated: a task sends one row per bracket and bin,
and the driver sees at most that many.

Bins are of equal width on a scale that changes from round to round: one that is logarithmic
for large values, the plain one, and one on which all magnitudes are equally wide.  So values
of very different magnitude are parted in a few rounds, too.  Scales only have to be monotone:
rounding of their arithmetic moves a value into a neighbouring bin at most, never out of order.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import cycle
from math import ceil, floor, inf, log, log1p

from pyspark.sql import Column, DataFrame, functions as F

from ratefuse.operators.stored import stored

BINS = 1024
LARGEST, TINY = 1.7976931348623157e308, 2.2250738585072014e-308


@dataclass(frozen=True)
class Bracket:
    """Values of one column from low to high; ``below`` rows of the column are smaller."""

    column: int
    low: float
    high: float
    below: int


def _plain(value: Column | float) -> Column | float:
    """Half of a value, so that differences stay finite; infinities count as the largest value."""
    if isinstance(value, Column):
        return F.least(F.greatest(value, F.lit(-LARGEST)), F.lit(LARGEST)) / 2
    return min(max(value, -LARGEST), LARGEST) / 2


def _logarithmic(value: Column | float) -> Column | float:
    if isinstance(value, Column):
        return F.signum(value) * F.log1p(F.abs(_plain(value)))
    return (value > 0) * log1p(abs(_plain(value))) - (value < 0) * log1p(abs(_plain(value)))


def _magnitude(value: Column | float) -> Column | float:
    if isinstance(value, Column):
        size = F.ln(F.greatest(F.abs(_plain(value)), F.lit(TINY))) - log(TINY)
        return F.signum(value) * size
    size = log(max(abs(_plain(value)), TINY)) - log(TINY)
    return (value > 0) * size - (value < 0) * size


def _bin(value: Column, bracket: Bracket, scale, bins: int) -> Column:
    """Number of the bin of a value, null outside the bracket."""
    low, high = scale(bracket.low), scale(bracket.high)
    if high > low:
        place = F.floor((scale(value) - low) / (high - low) * bins).cast("int")
        place = F.greatest(F.least(place, F.lit(bins - 1)), F.lit(0))
    else:  # the scale cannot tell them apart: the lowest value, and all others
        place = F.when(value > bracket.low, 1).otherwise(0)
    return F.when(value.between(bracket.low, bracket.high), place)


def _counted(values: DataFrame, brackets: list[Bracket], scale, bins: int) -> list[list[tuple]]:
    """Per bracket its filled bins in order: (rows, smallest value, largest value)."""
    pairs = [
        F.struct(
            F.lit(k).alias("k"), _bin(F.col(f"v{b.column}"), b, scale, bins).alias("bin"),
            F.col(f"v{b.column}").alias("v"),
        )
        for k, b in enumerate(brackets)
    ]
    rows = (
        values.select(F.inline(F.array(*pairs))).filter("bin IS NOT NULL").groupBy("k", "bin")
        .agg(F.count(F.lit(1)).alias("rows"), F.min("v").alias("low"), F.max("v").alias("high"))
        .collect()  # at most brackets * bins rows
    )
    out: list[list[tuple]] = [[] for _ in brackets]
    for r in sorted(rows, key=lambda r: (r["k"], r["bin"])):
        out[r["k"]].append((r["rows"], r["low"], r["high"]))
    return out


def order_statistics(
    values: DataFrame, ranks: dict[int, set[int]], ends: dict[int, tuple[float, float]], bins: int
) -> dict[tuple[int, int], float]:
    """The value of each rank (from 0) of the columns ``v0``, ``v1``, … with these ends."""
    found: dict[tuple[int, int], float] = {}
    open_ranks = {(i, r): Bracket(i, *ends[i], 0) for i, own in ranks.items() for r in own}
    for scale in cycle((_logarithmic, _plain, _magnitude, _plain)):
        for key, b in list(open_ranks.items()):
            if b.low == b.high:
                found[key] = b.low
                del open_ranks[key]
        if not open_ranks:
            return found
        brackets = sorted(set(open_ranks.values()), key=lambda b: (b.column, b.below))
        filled = dict(zip(brackets, _counted(values, brackets, scale, bins)))
        for key, b in open_ranks.items():
            below = b.below
            for rows, low, high in filled[b]:
                if key[1] < below + rows:
                    open_ranks[key] = Bracket(b.column, low, high, below)
                    break
                below += rows
    return found


def quantile_values(
    df: DataFrame, columns: list[str], probs: list[float], bins: int = BINS
) -> dict[tuple[str, float], tuple[int, float | None]]:
    """(rows with a value, quantile) of each column and probability, linear interpolation.

    Nulls and NaN are no values; a column without values has no quantile (None).  The columns
    are stored first, as each round reads them again.
    """
    plain = [F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in columns]
    values = stored(df.select(*[v.alias(f"v{i}") for i, v in enumerate(plain)]), "quantiles")
    one = values.agg(
        *[f(f"v{i}").alias(f"{n}{i}") for i in range(len(columns))
          for n, f in (("n", F.count), ("min", F.min), ("max", F.max))]
    ).first()
    sizes = {i: one[f"n{i}"] for i in range(len(columns))}
    ends = {i: (one[f"min{i}"], one[f"max{i}"]) for i, n in sizes.items() if n}
    place = {(i, p): p * (sizes[i] - 1) for i in ends for p in probs}
    ranks: dict[int, set[int]] = {i: set() for i in ends}
    for (i, _), at in place.items():
        ranks[i] |= {floor(at), ceil(at)}
    known = order_statistics(values, ranks, ends, bins)
    out = {}
    for i, c in enumerate(columns):
        for p in probs:
            value = None
            if i in ends:
                at = place[i, p]
                low, high = known[i, floor(at)], known[i, ceil(at)]
                value = low if low in (high, -inf, inf) else low + (high - low) * (at - floor(at))
            out[c, p] = (sizes[i], value)
    return out


def quantile_table(
    df: DataFrame, columns: list[str], probs: list[float], bins: int = BINS
) -> DataFrame:
    """(name, prob, n, value) for every column and probability; value is null without values."""
    rows = [
        (c, float(p), n, value)
        for (c, p), (n, value) in quantile_values(df, columns, probs, bins).items()
    ]
    return df.sparkSession.createDataFrame(rows, "name string, prob double, n long, value double")
