"""Time and rounding expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lapse.schema import SECS_IN_DAY


def _epoch_ntz() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def epoch_seconds(col) -> Column:
    """Epoch seconds (floored) of a 'yyyy-MM-dd HH:mm:ss[.f]' UTC string or a
    TIMESTAMP_NTZ column; independent of the session time zone."""
    c = _c(col)
    return F.timestamp_diff("SECOND", _epoch_ntz(), F.to_timestamp_ntz(c))


def round_half_away(col) -> Column:
    """Cast to integer rounding half away from zero (the warehouse's CAST)."""
    c = _c(col)
    return F.when(c >= 0, F.floor(c + F.lit(0.5))).otherwise(F.ceil(c - F.lit(0.5))).cast("bigint")


def slot_start(ts, first_start: int, width: int, splits: int) -> Column:
    """Start (epoch) of the slot holding ``ts``.

    Days start at ``first_start`` + n * 86400; each day holds ``splits`` slots
    of ``width`` seconds, the last one stretched to the end of the day.  The
    arithmetic is defined for every timestamp, so events before or after the
    window fall into well-defined virtual slots.
    """
    t = _c(ts)
    rem = F.pmod(t - F.lit(first_start), F.lit(SECS_IN_DAY))
    j = F.least(F.floor(rem / F.lit(width)).cast("bigint"), F.lit(splits - 1))
    return (t - rem + j * F.lit(width)).cast("bigint")
