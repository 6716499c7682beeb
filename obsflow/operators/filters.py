"""Row filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from obsflow.functions.scalar import is_finite, outside
from obsflow.functions.time import QUARTER_HOUR, on_grid

# The hours a day runs from and to.
DAY_FROM, DAY_TO = 8, 19


def day_rows(df, ts="valid"):
    """Rows from 08:00 until before 19:00."""
    return df.where((F.hour(ts) >= DAY_FROM) & (F.hour(ts) < DAY_TO))


def night_rows(df, ts="valid"):
    """Rows from 19:00 until before 08:00."""
    return df.where((F.hour(ts) >= DAY_TO) | (F.hour(ts) < DAY_FROM))


def recent(df, ts="valid", days=7, reference=None):
    """Rows no older than some days before a moment, by default the latest one in a batch.

    The latest moment is a scalar subquery. A stream has no latest row, so it
    must be given the reference.
    """
    if reference is None:
        if df.isStreaming:
            raise ValueError("a stream needs an explicit reference time")
        reference = df.agg(F.max(ts).alias("latest")).scalar()
    elif isinstance(reference, str):
        reference = F.lit(reference).cast(df.schema[ts].dataType)
    return df.where(F.col(ts) >= reference - F.expr(f"INTERVAL {int(days)} DAYS"))


def aligned(df, ts="valid", seconds=QUARTER_HOUR):
    """Rows on whole quarter hours, or another grid."""
    return df.where(on_grid(ts, seconds))


def finite_only(df, column="z_score"):
    """Drop null, NaN and infinite scores."""
    return df.where(is_finite(F.col(column)))


def beyond(df, threshold, column="z_score"):
    """Finite scores strictly outside the threshold."""
    return df.where(is_finite(F.col(column)) & outside(F.col(column), threshold))
