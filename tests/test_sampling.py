"""Hand-made sampling cases for I1/I2/I3 (platform, length, search, registration, day window)."""
import datetime as dt

from lapse.conf import Settings
from lapse.operators.sample import add_user_info, filter_raw, sample_users

# activity days for this setting: 2024-01-04 06:00 -> 01-05 06:00, and 01-03 06:00 -> 01-04 06:00
S = Settings(enddate="20240110", obsdays=5, preddays=5, actdays=2, timesplits=3, countries=("US",))
PLAY = ("user_id string, time string, ms_played long, skipped boolean, client_type string, product_type string, "
        "platform string, hardware string, location struct<latitude: double, longitude: double>, date date")
CTX = "user_id string, time string, play_context_decrypted string, date date"
SNAP = "user_id string, registration_date string, product string, reporting_country string"


def _play(u, t, ms=40000, platform="android"):
    d = dt.date.fromisoformat(t[:10])
    return (u, t, ms, False, "c", "p", platform, "h", None, d)


def _ctx(u, t, c="app:radio:1"):
    return (u, t, c, dt.date.fromisoformat(t[:10]))


def test_sampling_rules(spark):
    plays = [
        _play("ok", "2024-01-04 07:00:00.000000"),
        _play("ios", "2024-01-04 07:00:00.000000", platform="ios"),
        _play("short", "2024-01-04 07:00:00.000000", ms=30000),
        _play("search", "2024-01-04 07:00:00.000000"),
        _play("early", "2024-01-04 05:59:59.000000"),      # before 06:00 of the partition day
        _play("newbie", "2024-01-04 07:00:00.000000"),
        _play("abroad", "2024-01-04 07:00:00.000000"),
        _play("day2", "2024-01-03 23:00:00.000000", platform="android-tablet"),
        _play("outside", "2024-01-06 07:00:00.000000"),    # not an activity day
    ]
    ctx = [_ctx(p[0], p[1], "app:search:1" if p[0] == "search" else "app:radio:1") for p in plays]
    snap = [(u, "2023-12-01", "premium", "MX" if u == "abroad" else "US") for u, *_ in plays]
    snap = [r if r[0] != "newbie" else ("newbie", "2024-01-02", "free", "US") for r in snap]
    p, c, s = (spark.createDataFrame(plays, PLAY), spark.createDataFrame(ctx, CTX), spark.createDataFrame(snap, SNAP))
    users = sorted(r.user_id for r in sample_users(p, c, s, S).collect())
    assert users == ["day2", "ok"]
    info = {r.user_id: r for r in add_user_info(sample_users(p, c, s, S), s, S).collect()}
    # info day is D - (act + pred - 1) = 2024-01-04
    assert info["ok"].days_since_registration == (dt.date(2024, 1, 4) - dt.date(2023, 12, 1)).days
    raw = filter_raw(p, c, sample_users(p, c, s, S), S).collect()
    assert sorted(r.user_id for r in raw) == ["day2", "ok"]
    assert {r.secs_played for r in raw} == {40}
