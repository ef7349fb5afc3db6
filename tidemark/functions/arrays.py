"""Robust statistics of a series held as an array of doubles, oldest value first.

Everything is an expression, so a series is measured where its row is: no shuffle, no Python. Missing values, null
or NaN, keep their place, which is their time, and are ignored by what is measured; nothing but missing
values gives null.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

EPS = 1e-9
MAD_TO_SD = 1.4826


def bound(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is computed once: within a lambda, or where it is named twice, Spark would compute it each time."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def at(values: Column, i: int) -> Column:
    """The i-th value from the front (0, 1 ...) or the back (-1, -2 ...); null beyond the ends."""
    return F.try_element_at(values, F.lit(i + 1 if i >= 0 else i))


def last_n(values: Column, n: int) -> Column:
    """The last n values, or all of fewer."""
    return F.slice(values, F.greatest(F.size(values) - n + 1, F.lit(1)), n)


def without_last(values: Column, n: int = 1) -> Column:
    return F.slice(values, 1, F.greatest(F.size(values) - n, F.lit(0)))


def known(values: Column) -> Column:
    """The values that are not missing."""
    return F.filter(values, lambda x: x.isNotNull() & ~F.isnan(x))


def total(values: Column) -> Column:
    return F.aggregate(known(values), F.lit(0.0), lambda a, x: a + x)


def mean(values: Column) -> Column:
    return F.try_divide(total(values), F.size(known(values)))


def median(values: Column) -> Column:
    """Mean of the two middle values; null where none is known."""

    def middle(ordered: Column) -> Column:
        n = F.size(ordered)
        low = F.greatest(F.floor((n + 1) / 2), F.lit(1)).cast("int")
        high = (F.floor(n / 2) + 1).cast("int")
        return (F.try_element_at(ordered, low) + F.try_element_at(ordered, high)) / 2

    return bound(F.sort_array(known(values)), middle)


def diffs(values: Column) -> Column:
    """First differences."""
    n = F.greatest(F.size(values) - 1, F.lit(0))
    return F.zip_with(F.slice(values, 2, n), F.slice(values, 1, n), lambda b, a: b - a)


def changes(values: Column) -> Column:
    """Relative change from each value to the next; null after a zero."""
    n = F.greatest(F.size(values) - 1, F.lit(0))
    return F.zip_with(F.slice(values, 2, n), F.slice(values, 1, n), lambda b, a: F.try_divide(b - a, a))


def deviations(values: Column, centre: Column) -> Column:
    return F.transform(values, lambda x: F.abs(x - centre))


def mad(values: Column, scaled: bool = True) -> Column:
    """Median absolute deviation, by default scaled to a standard deviation."""
    raw = bound(values, lambda v: bound(median(v), lambda centre: median(deviations(v, centre))))
    return raw * MAD_TO_SD if scaled else raw


def sd(values: Column) -> Column:
    """Standard deviation of a population, by the running mean of Welford: the last bits are those of DuckDB's stddev_pop, which thresholds can turn on."""
    none = F.struct(F.lit(0.0).alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("squares"))

    def add(s: Column, x: Column) -> Column:
        step = lambda mean: F.struct((s["n"] + 1).alias("n"), mean.alias("mean"), (s["squares"] + (x - mean) * (x - s["mean"])).alias("squares"))
        return bound(s["mean"] + (x - s["mean"]) / (s["n"] + 1), step)

    return F.aggregate(known(values), none, add, lambda s: F.sqrt(F.try_divide(s["squares"], s["n"])))


def robust_scale(values: Column, eps: float = EPS, guard_sd: bool = True) -> Column:
    """Scaled MAD, else the standard deviation, else 0; 0 below three known values."""

    def scale(v: Column) -> Column:
        fallback = bound(sd(v), lambda x: F.when(x > eps, x).otherwise(0.0)) if guard_sd else sd(v)
        return F.when(F.size(v) < 3, 0.0).otherwise(bound(mad(v), lambda spread: F.when(spread > eps, spread).otherwise(fallback)))

    return bound(known(values), scale)


def theil_sen(values: Column) -> Column:
    """Median of the slopes of all pairs of known values, by their places; null below two."""
    placed = F.filter(F.transform(values, lambda x, i: F.struct(x.alias("x"), i.alias("i"))), lambda p: p["x"].isNotNull() & ~F.isnan(p["x"]))

    def slopes(p: Column) -> Column:
        after = lambda a, k: F.transform(F.slice(p, k + 2, F.size(p)), lambda b: (b["x"] - a["x"]) / (b["i"] - a["i"]))
        return F.flatten(F.transform(p, after))

    return median(bound(placed, slopes))


def residuals(values: Column, slope: Column) -> Column:
    """Values less slope times their place."""
    return F.transform(values, lambda x, i: x - slope * i)


def intercept(values: Column, slope: Column) -> Column:
    return median(residuals(values, slope))


def ranks(values: Column) -> Column:
    """Rank of each value, ties sharing their mean rank."""

    def rank(x: Column) -> Column:
        less = F.size(F.filter(values, lambda y: y < x))
        equal = F.size(F.filter(values, lambda y: y == x))
        return less + (equal + 1) / 2

    return F.transform(values, rank)


def spearman_time(values: Column) -> Column:
    """Rank correlation with time; 0 for a constant series, and where a value is missing, as ranks then say nothing of time."""

    def correlation(ranked: Column) -> Column:
        n = F.size(ranked)
        centred = F.transform(ranked, lambda r: r - (n + 1) / 2)
        both = total(F.transform(centred, lambda r, i: r * (i - (n - 1) / 2)))
        of_ranks = total(F.transform(centred, lambda r: r * r))
        of_time = total(F.transform(centred, lambda r, i: (i - (n - 1) / 2) * (i - (n - 1) / 2)))
        return F.when(of_ranks * of_time > 0, both / (F.sqrt(of_ranks) * F.sqrt(of_time))).otherwise(0.0)

    return F.when(F.size(known(values)) == F.size(values), bound(ranks(values), correlation)).otherwise(0.0)


def dominance(values: Column) -> Column:
    """Share of differences that have the sign of their median."""

    def share(steps: Column) -> Column:
        agreeing = lambda sign: F.size(F.filter(steps, lambda d: F.signum(d) == sign))
        return bound(F.signum(median(steps)), agreeing) / F.size(steps)

    return bound(diffs(values), share)


def trailing_run(years: Column) -> Column:
    """Length of the run of consecutive ascending years at the end of the array."""
    n = F.size(years)
    breaks = F.filter(F.sequence(F.lit(2), F.greatest(n, F.lit(2))), lambda i: F.try_element_at(years, i) - F.try_element_at(years, i - 1) != 1)
    return F.when(n == 0, 0).otherwise(n - F.coalesce(F.array_max(breaks), F.lit(1)) + 1)
