"""Cleaning, scoring and vector expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from obsflow.schema import MISSING_PRESSURE, MISSING_TEXT


def as_column(column):
    """A column by name, or as it is."""
    return F.col(column) if isinstance(column, str) else column


def number(column):
    """The text as a double, null where it is no number."""
    return as_column(column).try_cast("double")


def replace_missing(column, replacement, marker=MISSING_TEXT):
    """Replace the missing-value text; everything else, null included, is kept."""
    c = as_column(column)
    return F.when(c == F.lit(marker), F.lit(replacement)).otherwise(c)


def replace_missing_pressure(column="mslp", replacement="0", marker=MISSING_PRESSURE):
    """Replace a text that reads as the missing-pressure number, however written (-1, -1.0)."""
    c = as_column(column)
    return F.when(number(c) == F.lit(float(marker)), F.lit(replacement)).otherwise(c)


def encode(column, codes):
    """Swap known labels for their code; unknown labels stay as they are."""
    c = as_column(column)
    branches = F
    for label, code in codes.items():
        branches = branches.when(c == F.lit(label), F.lit(str(code)))
    return branches.otherwise(c)


def steady_round(column, digits, guard=12):
    """Round half away from zero, blind to the noise of summation order.

    Sums of doubles depend in their last bits on how rows met in tasks, so a
    value on a tie could fall either way between two runs. Moving every value
    outwards by ``10 ** -guard`` first decides ties the same way each time. All
    of it is double arithmetic, many times faster than decimal rounding.
    """
    unit = F.lit(float(10**digits))
    moved = column * unit + F.signum(column) * F.lit(10.0 ** (digits - guard))
    return F.rint(moved) / unit + F.lit(0.0)


def z_score(value, mean, deviation):
    """Distance from the mean in deviations; null where the deviation is zero or missing."""
    return (value - mean) / F.nullif(deviation, F.lit(0.0))


def is_finite(column):
    """True for a number that is neither null, NaN nor infinite."""
    return column.isNotNull() & ~F.isnan(column) & (F.abs(column) < F.lit(float("inf")))


def outside(column, threshold):
    """Strictly further from zero than the threshold."""
    return (column > F.lit(float(threshold))) | (column < F.lit(-float(threshold)))


def anomaly_label(z, threshold=2.0):
    """1.0 where the score lies outside the threshold, else 0.0."""
    return F.when(outside(z, threshold), F.lit(1.0)).otherwise(F.lit(0.0))


def squared_distance(columns, point):
    """Squared Euclidean distance between columns and a constant point."""
    squares = [F.pow(c - F.lit(float(p)), F.lit(2.0)) for c, p in zip(columns, point)]
    return reduce(lambda a, b: a + b, squares)


def nearest(columns, centres):
    """Index and distance of the nearest constant point; the lowest index wins a tie.

    Structs order by their first field, so the least of (distance, index) is both at once.
    """
    candidates = [
        F.struct(squared_distance(columns, centre).alias("squared"), F.lit(i).alias("cluster"))
        for i, centre in enumerate(centres)
    ]
    best = F.array_min(F.array(*candidates))
    return F.struct(best["cluster"].alias("cluster"), F.sqrt(best["squared"]).alias("distance"))


def dot(columns, weights):
    """Dot product of columns with constant weights."""
    return reduce(lambda a, b: a + b, [c * F.lit(float(w)) for c, w in zip(columns, weights)])


def array_distance(left, right):
    """Euclidean distance between two array columns."""
    squares = F.zip_with(left, right, lambda a, b: (a - b) * (a - b))
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda total, square: total + square))


def hash_share(columns, seed):
    """A number in [0, 1) fixed by the key alone, so a split never depends on partitioning."""
    text = F.concat_ws("|", *columns, F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
