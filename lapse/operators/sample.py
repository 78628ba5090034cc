"""User sampling and the raw stream pull (I1 active users, I2 user info, I3 raw streams)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapse.conf import Settings
from lapse.functions.buckets import hash_bucket
from lapse.functions.timefn import epoch_seconds
from lapse.schema import SEARCH_PATTERN, SECS_IN_DAY
from lapse.sources.tables import read_days, snapshot_on


def hash_sample(df: DataFrame, share: float, col: str = "user_id", family: str = "sha") -> DataFrame:
    """Deterministic share of users: ``hash(user_id) mod int(1/share) = 0``."""
    n = int(1 / share)
    if n <= 1:
        return df
    return df.where(hash_bucket(col, n, "sample", family) == 0)


def drop_search(ctx: DataFrame) -> DataFrame:
    """Contexts that are not searches; NULL contexts are dropped too."""
    return ctx.where(~F.col("play_context_decrypted").like(SEARCH_PATTERN))


def with_context(plays: DataFrame, ctx: DataFrame) -> DataFrame:
    """plays JOIN contexts ON (user_id, time, date)."""
    c = ctx.select("user_id", "time", "date", "play_context_decrypted")
    return plays.join(c, ["user_id", "time", "date"], "inner")


def sample_users(plays: DataFrame, contexts: DataFrame, snapshots: DataFrame, s: Settings) -> DataFrame:
    """Users with a significant, non-search Android play on an activity day,
    registered more than ``obsdays`` before that day, in a sampled country,
    in the hash sample (I1).  One scan over the activity days replaces the
    per-day UNION DISTINCT; the distinct (user, day) pairs are taken before
    the snapshot is consulted, so the snapshot join sees one row per active
    user-day instead of one per play.  Returns ``user_id``.
    """
    w = s.windows
    days = w.activity_days()
    dates = [d for d, _ in days]
    # day start of each activity partition: date 00:00 + 06:00 (UTC)
    day_start = F.unix_date(F.col("date")).cast("bigint") * SECS_IN_DAY + F.lit(w.end % SECS_IN_DAY)
    t = epoch_seconds("time")
    p = read_days(plays, min(dates), max(dates), dates=dates)
    p = p.where((F.col("ms_played") > s.significant_ms) & F.col("platform").isin(list(s.platforms))
                & (t >= day_start) & (t < day_start + F.lit(SECS_IN_DAY)))
    p = hash_sample(p, s.shareusers, family=s.hash_family)
    c = hash_sample(drop_search(read_days(contexts, min(dates), max(dates), dates=dates)),
                    s.shareusers, family=s.hash_family)
    active = (p.select("user_id", "time", "date")
              .join(c.select("user_id", "time", "date"), ["user_id", "time", "date"], "left_semi")
              .select("user_id", "date").distinct())
    snap = snapshots
    if s.countries is not None:
        snap = snap.where(F.col("reporting_country").isin(list(s.countries)))
    snap = snap.select("user_id", F.to_date("registration_date").alias("reg_date"),
                       *(["date"] if "date" in snap.columns else []))
    keys = ["user_id"] + (["date"] if "date" in snap.columns else [])
    a = active.alias("a")
    b = snap.alias("b")
    cond = [F.col(f"a.{k}") == F.col(f"b.{k}") for k in keys]
    cond.append(F.datediff(F.col("a.date"), F.col("b.reg_date")) > F.lit(s.obsdays))
    return a.join(b, cond, "left_semi").select("user_id").distinct()


def add_user_info(users: DataFrame, snapshots: DataFrame, s: Settings) -> DataFrame:
    """Attach days since registration, product and country from the snapshot
    of day D - (actdays + preddays - 1); users missing there drop out (I2, C3).
    The join is left to the planner: AQE turns it into a broadcast at run
    time when the measured user side is small."""
    day = s.windows.info_date
    snap = snapshot_on(snapshots, day)
    return users.join(snap, "user_id", "inner").select(
        "user_id",
        F.datediff(F.lit(day), F.to_date("registration_date")).alias("days_since_registration"),
        "product", "reporting_country",
    )


def filter_raw(plays: DataFrame, contexts: DataFrame, users: DataFrame, s: Settings) -> DataFrame:
    """Streams of the sampled users over all days of the dataset with
    ``ms_played > 0`` and a non-search context (I3: B7, B8, C1, C4)."""
    w = s.windows
    dates = w.raw_dates()
    # all ids that can match; as a filter it lets the planner build a Bloom
    # filter from the ids where they are too many to be broadcast
    ids = users.select("user_id").where(F.col("user_id") >= "")
    p = read_days(plays, min(dates), max(dates)).where(F.col("ms_played") > 0)
    p = p.join(ids, "user_id", "left_semi")
    c = drop_search(read_days(contexts, min(dates), max(dates))).join(ids, "user_id", "left_semi")
    cols = [
        "user_id",
        "skipped",
        # ms / 1000 rounded half away from zero (warehouse CAST), in integers
        F.floor((F.col("ms_played") + F.lit(500)) / F.lit(1000)).cast("bigint").alias("secs_played"),
        epoch_seconds("time").alias("timestampp"),
        "client_type", "product_type", "platform", "hardware",
        F.col("location.latitude").alias("latitude"),
        F.col("location.longitude").alias("longitude"),
        F.col("time").alias("timestr"),
        "play_context_decrypted",
    ]
    return with_context(p, c).select(*cols)
