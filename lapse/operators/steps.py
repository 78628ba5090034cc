"""Re-window and inter-step features (I5 re-window, I6 iat + running sums).

Per-user window functions would put all of one user's history into one
task.  Here every row is first placed in its time slot (a bounded
piece of one user's history), the ordered window runs per (user, slot), and
the carry-over from earlier slots (previous timestamp, running totals) comes
from a small per-user window over slot totals, joined back on
(user, slot).  The row side keeps its (user, slot) partitioning through the
join, and the slot aggregation that usually follows needs no new shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lapse.conf import Settings
from lapse.functions.timefn import slot_start
from lapse.schema import SECS_COLS, SECS_IN_DAY, SUM_COLS, TOP_TYPES

# deterministic order inside equal timestamps (the original leaves it open)
ROW_ORDER = ["timestampp", "secs_played", "play_context_decrypted"]


def rewindow(df: DataFrame, s: Settings) -> DataFrame:
    """Cut a smaller dataset out of the base one: D - total days <= ts <= D,
    both ends closed (I5).  ``aligned=True`` keeps the slot grid instead:
    one pre-day for carry-over, then whole slot days."""
    w = s.windows
    lo, hi = w.rewindow_bounds
    if s.aligned:
        return df.where((F.col("timestampp") >= lo) & (F.col("timestampp") < w.last_end))
    return df.where(F.col("timestampp").between(lo, hi))


def secs_by_type(name: str) -> F.Column:
    """Played seconds counted toward one of the 12 played-seconds columns."""
    if name == "secs_played":
        return F.col("secs_played")
    t = next(t for t in TOP_TYPES if f"secs_played_{t.lower()}" == name)
    return F.when(F.col("top_type") == F.lit(t), F.col("secs_played")).otherwise(F.lit(0))


def with_slot(df: DataFrame, s: Settings, col: str = "slot") -> DataFrame:
    w = s.windows
    return df.withColumn(col, slot_start("timestampp", w.first_start, w.width, w.timesplits))


def add_step_features(df: DataFrame, s: Settings, iat: bool = True, sums: bool = True) -> DataFrame:
    """Add ``iat`` (ts minus previous ts of the user, first one against
    D - total days - 1 min) and the 12 running sums of played seconds
    (rows unbounded preceding .. current row) to parsed streams (F1, F2).
    Also adds ``slot`` (the row's slot start), used downstream.
    """
    w = s.windows
    x = with_slot(df, s)
    row_w = Window.partitionBy("user_id", "slot").orderBy(*ROW_ORDER)
    run_w = row_w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cols = {}
    if iat:
        cols["_prev_ts"] = F.lag("timestampp", 1).over(row_w)
    if sums:
        for c in SECS_COLS:
            cols[f"_cum_{c}"] = F.sum(secs_by_type(c)).over(run_w)
    rows = x.withColumns(cols)

    # per (user, slot) totals -> carry-over from earlier slots of the user
    aggs = [F.max("timestampp").alias("_max_ts")]
    if sums:
        aggs += [F.sum(secs_by_type(c)).alias(f"_tot_{c}") for c in SECS_COLS]
    per_slot = rows.groupBy("user_id", "slot").agg(*aggs)
    user_w = Window.partitionBy("user_id").orderBy("slot")
    before = user_w.rowsBetween(Window.unboundedPreceding, -1)
    carry_cols = [F.col("user_id"), F.col("slot")]
    if iat:
        carry_cols.append(F.lag("_max_ts", 1).over(user_w).alias("_prev_slot_ts"))
    if sums:
        carry_cols += [F.sum(f"_tot_{c}").over(before).alias(f"_base_{c}") for c in SECS_COLS]
    carry = per_slot.select(*carry_cols)

    out = rows.join(carry, ["user_id", "slot"], "inner")
    new = {}
    if iat:
        new["iat"] = F.col("timestampp") - F.coalesce(F.col("_prev_ts"), F.col("_prev_slot_ts"),
                                                     F.lit(w.iat_start).cast("bigint"))
    if sums:
        for c, sc in zip(SECS_COLS, SUM_COLS):
            new[sc] = F.coalesce(F.col(f"_base_{c}"), F.lit(0)) + F.col(f"_cum_{c}")
    out = out.withColumns(new)
    drop = [c for c in out.columns if c.startswith("_")]
    return out.drop(*drop)


def add_iat(df: DataFrame, s: Settings) -> DataFrame:
    return add_step_features(df, s, iat=True, sums=False)


def add_running_sums(df: DataFrame, s: Settings) -> DataFrame:
    return add_step_features(df, s, iat=False, sums=True)


def in_window(df: DataFrame, s: Settings, col: str = "timestampp") -> DataFrame:
    """Rows whose timestamp lies in the dataset's slot grid."""
    w = s.windows
    return df.where((F.col(col) >= w.first_start) & (F.col(col) < w.last_end))


__all__ = ["rewindow", "add_step_features", "add_iat", "add_running_sums", "with_slot",
           "secs_by_type", "in_window", "ROW_ORDER", "SECS_IN_DAY"]
