"""Slot features (I7: E1 a-g, D3) and the top-combination rank.

The original attaches every distinct (top_type, platform, client_type,
latitude, longitude) combination of a user in a slot to each of the user's
rows in that slot (a many-to-many join without a rank filter), so each row
appears k times.  Means, maxima, ratios and distinct counts do not change;
counts are multiplied by k and the sample standard deviation becomes
std_pop * sqrt(kn / (kn - 1)).  That closed form is computed here without
the join (``fanout="reference"``); ``fanout="none"`` gives plain per-slot
statistics (k = 1).

Plan (one scan and one shuffle of the stream rows):

* rows are hash-partitioned on (user, slot) and sorted by time inside each
  slot; the only per-row window is the in-slot predecessor for ``iat``;
* over the rows of a slot, already together, a window counts the distinct
  combinations and finds the any-value texts; one hash aggregation per
  (user, slot) on that partitioning gives the statistics;
* carry-over between slots of a user (the previous timestamp for the
  first ``iat`` of a slot, running totals of played seconds) comes from a
  per-user window over slot rows, not over stream rows.

Slot ``iat`` statistics are merged from the in-slot differences and the
first difference with the pairwise (Chan et al.) update, which is stable.
The maximum running sum in a slot equals the user's running total at the
end of the slot, because played seconds are never negative.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from lapse.conf import Settings
from lapse.operators.steps import secs_by_type, with_slot
from lapse.schema import (ANY_COLS, COUNT_COLS, MEAN_STD_COLS, MISSING_COORD, SECS_COLS, SUM_COLS,
                          TOP_TYPES)

COMBO_COLS = ["top_type", "platform", "client_type", "latitude", "longitude"]
TEXT_COLS = ["top_type", "platform", "client_type"]


def _coord(c: str) -> F.Column:
    return F.when(F.col(c) != F.lit(MISSING_COORD), F.col(c))


def _any_values(w: WindowSpec) -> dict[str, F.Column]:
    """The number of distinct combinations of a slot and the smallest value of
    its text columns, on every row.  As grouping keys they leave the
    aggregation buffers of fixed width, which hash aggregation asks for."""
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    combo = F.struct(*TEXT_COLS, *[F.col(c) + F.lit(0.0) for c in ("latitude", "longitude")])  # no negative zeros
    return {"_k": F.size(F.collect_set(combo).over(whole)),
            **{f"_any_{c}": F.min(c).over(whole) for c in TEXT_COLS}}


def _combo_aggs() -> list[F.Column]:
    """Number of distinct combinations and the any-values (smallest value of
    each column, for reproducible output)."""
    return [F.count_distinct(F.struct(*COMBO_COLS)).alias("_k"), F.min("top_type").alias("top_type"),
            F.min("platform").alias("platform"), F.min("client_type").alias("client_type"),
            F.min(_coord("latitude")).alias("latitude"), F.min(_coord("longitude")).alias("longitude")]


def slot_features(parsed: DataFrame, s: Settings) -> DataFrame:
    """Parsed streams -> one row per (user, slot) with the 52 model features,
    the 5 any-value columns, ``time`` (slot start) and ``backfill = false``.

    Every stream row counts toward the running totals and the predecessor of
    ``iat``; only slots on the dataset's grid are returned.
    """
    w = s.windows
    x = with_slot(parsed, s)
    # no statistic tells contexts apart, so they need not travel to break ties
    row_w = Window.partitionBy("user_id", "slot").orderBy("timestampp", "secs_played")
    y = x.withColumns({"_d": F.col("timestampp") - F.lag("timestampp", 1).over(row_w), **_any_values(row_w)})
    aggs = [F.count(F.lit(1)).alias("_n"), F.min("timestampp").alias("_first_ts"),
            F.max("timestampp").alias("_last_ts"), F.count("_d").alias("_dn"),
            F.avg("_d").alias("_dmean"), F.var_pop("_d").alias("_dvar"),
            F.avg(F.col("skipped").cast("int")).alias("skip_ratio")]
    for c in SECS_COLS:
        v = secs_by_type(c)
        aggs += [F.avg(v).alias(c), F.var_pop(v).alias(f"_var_{c}"), F.sum(v).alias(f"_tot_{c}")]
    for t in TOP_TYPES:
        aggs.append(F.sum(F.when(F.col("top_type") == F.lit(t), 1).otherwise(0)).alias(f"_n_{t.lower()}"))
    aggs += [F.min(_coord(c)).alias(c) for c in ("latitude", "longitude")]
    g = y.groupBy("user_id", "slot", "_k", *[F.col(f"_any_{c}").alias(f"_min_{c}") for c in TEXT_COLS]).agg(*aggs)
    g = g.withColumnsRenamed({f"_min_{c}": c for c in TEXT_COLS})

    # carry-over across the slots of a user (rows here are slots, not plays)
    user_w = Window.partitionBy("user_id").orderBy("slot")
    upto = user_w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carry = {"_prev_ts": F.lag("_last_ts", 1).over(user_w)}
    for c, sc in zip(SECS_COLS, SUM_COLS):
        carry[sc] = F.sum(f"_tot_{c}").over(upto)
    g = g.withColumns(carry)
    g = g.where((F.col("slot") >= F.lit(w.first_start)) & (F.col("slot") < F.lit(w.last_end)))

    n = F.col("_n").cast("double")
    dn = F.col("_dn").cast("double")
    first_iat = F.col("_first_ts") - F.coalesce(F.col("_prev_ts"), F.lit(w.iat_start).cast("bigint"))
    dmean = F.coalesce(F.col("_dmean"), F.lit(0.0))
    delta = first_iat - dmean
    iat_mean = (dmean * dn + first_iat) / n
    iat_m2 = F.coalesce(F.col("_dvar"), F.lit(0.0)) * dn + delta * delta * dn / n
    g = g.withColumns({"iat": iat_mean, "_var_iat": iat_m2 / n})

    k = F.col("_k") if s.fanout == "reference" else F.lit(1)
    kn = (F.col("_n") * k).cast("double")
    out = {}
    for m in MEAN_STD_COLS:
        var = F.greatest(F.col(f"_var_{m}"), F.lit(0.0))
        out[f"{m}_std"] = F.when(kn > 1, F.sqrt(var * kn / (kn - 1))).otherwise(F.lit(0.0))
    out["unique_top_types"] = sum((F.col(f"_n_{t.lower()}") > 0).cast("bigint") for t in TOP_TYPES)
    out["total_streams"] = (F.col("_n") * k).cast("bigint")
    for t in TOP_TYPES:
        out[f"total_streams_{t.lower()}"] = (F.col(f"_n_{t.lower()}") * k).cast("bigint")
    g = g.withColumns(out)
    cols = (["user_id", F.col("slot").alias("time")]
            + [c for m in MEAN_STD_COLS for c in (m, f"{m}_std")]
            + ["unique_top_types", "skip_ratio"] + SUM_COLS + COUNT_COLS + ANY_COLS
            + [F.lit(False).alias("backfill")])
    return g.select(*cols)


def slot_features_from_steps(steps: DataFrame, s: Settings) -> DataFrame:
    """Slot features by plain aggregation of per-row ``iat`` and running sums
    (the original's two-step form; used to cross-check :func:`slot_features`)."""
    w = s.windows
    x = steps.where((F.col("timestampp") >= w.first_start) & (F.col("timestampp") < w.last_end))
    aggs = [F.count(F.lit(1)).alias("_n"), F.avg(F.col("skipped").cast("int")).alias("skip_ratio")]
    for m in MEAN_STD_COLS:
        v = F.col("iat") if m == "iat" else secs_by_type(m)
        aggs += [F.avg(v).alias(m), F.var_pop(v).alias(f"_var_{m}")]
    for t in TOP_TYPES:
        aggs.append(F.sum(F.when(F.col("top_type") == F.lit(t), 1).otherwise(0)).alias(f"_n_{t.lower()}"))
    aggs += [F.max(c).alias(c) for c in SUM_COLS]
    g = x.groupBy("user_id", "slot").agg(*aggs, *_combo_aggs())
    k = F.col("_k") if s.fanout == "reference" else F.lit(1)
    kn = (F.col("_n") * k).cast("double")
    out = {f"{m}_std": F.when(kn > 1, F.sqrt(F.col(f"_var_{m}") * kn / (kn - 1))).otherwise(F.lit(0.0))
           for m in MEAN_STD_COLS}
    out["unique_top_types"] = sum((F.col(f"_n_{t.lower()}") > 0).cast("bigint") for t in TOP_TYPES)
    out["total_streams"] = (F.col("_n") * k).cast("bigint")
    for t in TOP_TYPES:
        out[f"total_streams_{t.lower()}"] = (F.col(f"_n_{t.lower()}") * k).cast("bigint")
    g = g.withColumns(out)
    cols = (["user_id", F.col("slot").alias("time")]
            + [c for m in MEAN_STD_COLS for c in (m, f"{m}_std")]
            + ["unique_top_types", "skip_ratio"] + SUM_COLS + COUNT_COLS + ANY_COLS
            + [F.lit(False).alias("backfill")])
    return g.select(*cols)


def top_combination(parsed: DataFrame, s: Settings) -> DataFrame:
    """Per (user, slot): the (top_type, platform, client_type, latitude,
    longitude) combinations ranked by frequency, keeping rank 1 (F3; ties
    share the rank).  Coordinates equal to 999.9 come out as NULL."""
    w = s.windows
    x = with_slot(parsed, s).where((F.col("slot") >= w.first_start) & (F.col("slot") < w.last_end))
    combos = x.select("user_id", "slot", "top_type", "platform", "client_type",
                      _coord("latitude").alias("latitude"), _coord("longitude").alias("longitude"))
    g = combos.groupBy("user_id", "slot", *COMBO_COLS).agg(F.count(F.lit(1)).alias("plays"))
    rw = Window.partitionBy("user_id", "slot").orderBy(F.col("plays").desc())
    return (g.withColumn("rank", F.rank().over(rw)).where(F.col("rank") == 1)
            .select("user_id", F.col("slot").alias("time"), *COMBO_COLS, "plays"))
