"""Churn labels, the training cut and zero fill."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapse.conf import Settings
from lapse.schema import ANY_COLS, COUNT_COLS, MEAN_STD_COLS, SUM_COLS


def label_churn(users: DataFrame, slots: DataFrame, s: Settings) -> DataFrame:
    """``churn = 0`` for users with a slot in the prediction window whose mean
    played seconds is positive, else 1 (E2).  The semi and anti joins of the
    original become one left join against the distinct retained ids."""
    retained = (slots.where((F.col("time") >= F.lit(s.windows.pred_start)) & (F.col("secs_played") > 0))
                .select("user_id").distinct().withColumn("_retained", F.lit(True)))
    return (users.join(retained, "user_id", "left")
            .withColumn("churn", F.when(F.col("_retained"), F.lit(0)).otherwise(F.lit(1)))
            .drop("_retained"))


def training_slots(slots: DataFrame, s: Settings) -> DataFrame:
    """Drop the prediction slots: ``time <= max(training slots)``."""
    return slots.where(F.col("time") <= F.lit(s.windows.max_training_slot))


def zero_row_values() -> dict[str, F.Column]:
    """Values of a filled slot."""
    vals: dict[str, F.Column] = {}
    for m in MEAN_STD_COLS:
        vals[m] = F.lit(0.0)
        vals[f"{m}_std"] = F.lit(0.0)
    vals["unique_top_types"] = F.lit(0).cast("bigint")
    vals["skip_ratio"] = F.lit(0.0)
    for c in SUM_COLS:
        vals[c] = F.lit(0).cast("bigint")
    for c in COUNT_COLS:
        vals[c] = F.lit(0).cast("bigint")
    vals["top_type"] = F.lit("Unknown")
    vals["platform"] = F.lit("Unknown")
    vals["client_type"] = F.lit("Unknown")
    vals["latitude"] = F.lit(None).cast("double")
    vals["longitude"] = F.lit(None).cast("double")
    return vals


def slot_grid(users: DataFrame, s: Settings) -> DataFrame:
    """Every user x every training slot, generated per user row (no join)."""
    slots = F.array(*[F.lit(t).cast("bigint") for t in s.windows.training_slots()])
    return users.select("user_id", F.explode(slots).alias("time"))


def zero_fill(slots: DataFrame, labels: DataFrame, s: Settings) -> DataFrame:
    """Every labelled user gets a row for every training slot; missing slots
    are zero rows with ``backfill = true`` (I10).  ``slots`` must already be
    cut to the training slots.  One left join of the grid against the real
    rows replaces the anti join + union per slot."""
    grid = slot_grid(labels.select("user_id").distinct(), s)
    real = slots.withColumn("_real", F.lit(True))
    j = grid.join(real, ["user_id", "time"], "left")
    zeros = zero_row_values()
    filled = F.col("_real").isNull()
    cols = [F.col("user_id"), F.col("time")]
    for c in [c for m in MEAN_STD_COLS for c in (m, f"{m}_std")] + ["unique_top_types", "skip_ratio"] \
            + SUM_COLS + COUNT_COLS + ANY_COLS:
        cols.append(F.when(filled, zeros[c]).otherwise(F.col(c)).alias(c))
    cols.append(filled.alias("backfill"))
    return j.select(*cols)
