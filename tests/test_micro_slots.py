"""Hand-made micro fixtures (FIXTURES.md section 5, items 1-3)."""
import calendar
import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from lapse.conf import Settings
from lapse.operators.slots import slot_features, slot_features_from_steps
from lapse.operators.steps import add_step_features

S = Settings(enddate="20240110", obsdays=2, preddays=1, actdays=1, timesplits=3, countries=None)
SCHEMA = ("user_id string, timestampp long, skipped boolean, secs_played long, play_context_decrypted string, "
          "top_type string, sub_type string, platform string, latitude double, longitude double, client_type string")


def ts(day, h, m=0, s=0):
    return calendar.timegm(dt.datetime(2024, 1, day, h, m, s).timetuple())


ROWS = [
    ("A", ts(8, 5), False, 10, "app:catalog:1", "Catalog", "1", "p1", 999.9, 999.9, "c"),   # before the grid
    ("A", ts(8, 6), True, 20, "app:catalog:1", "Catalog", "1", "p1", 999.9, 999.9, "c"),    # on a slot start
    ("A", ts(8, 6, 10), False, 40, "app:catalog:1", "Catalog", "1", "p1", 999.9, 999.9, "c"),
    ("A", ts(8, 7), False, 60, "app:catalog:1", "Catalog", "1", "p2", 999.9, 999.9, "c"),   # 2nd combination
    ("B", ts(8, 14), False, 30, "app:radio:2", "Radio", "2", "p1", 10.0, 20.0, "c"),         # 14:00 -> 2nd slot
]


@pytest.fixture(scope="module")
def feats(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    return {r["user_id"] + str(r["time"]): r.asDict() for r in slot_features(df, S).collect()}


def test_slot_rows(feats):
    assert set(feats) == {"A" + str(ts(8, 6)), "B" + str(ts(8, 14))}


def test_fanout_counts_and_std(feats):
    a = feats["A" + str(ts(8, 6))]
    assert a["total_streams"] == 6 and a["total_streams_catalog"] == 6
    assert a["unique_top_types"] == 1
    assert a["secs_played"] == pytest.approx(40.0)
    assert a["secs_played_std"] == pytest.approx(math.sqrt(1600 / 5))
    assert a["iat"] == pytest.approx(2400.0)
    assert a["iat_std"] == pytest.approx(math.sqrt(2 * (1200 ** 2 + 1800 ** 2 + 600 ** 2) / 5))
    assert a["sum_secs_played"] == 130
    assert a["skip_ratio"] == pytest.approx(1 / 3)
    assert a["latitude"] is None and a["platform"] == "p1"


def test_single_event(feats):
    b = feats["B" + str(ts(8, 14))]
    assert b["total_streams"] == 1 and b["secs_played_std"] == 0.0 and b["iat_std"] == 0.0
    assert b["iat"] == ts(8, 14) - (S.windows.end - 3 * 86400 - 60)
    assert b["latitude"] == 10.0 and b["secs_played_radio"] == 30.0


def test_no_fanout(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    a = [r for r in slot_features(df, S.with_(fanout="none")).collect() if r["user_id"] == "A"][0]
    assert a["total_streams"] == 3
    assert a["secs_played_std"] == pytest.approx(20.0)


def test_closed_form_equals_row_form(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    a = slot_features(df, S)
    b = slot_features_from_steps(add_step_features(df, S), S)
    cols = [c for c, t in a.dtypes if t in ("double", "bigint")]
    j = a.alias("a").join(b.alias("b"), ["user_id", "time"])
    assert j.count() == a.count() == b.count()
    diff = j.select(*[F.abs(F.col(f"a.{c}") - F.col(f"b.{c}")).alias(c) for c in cols if c != "time"]).collect()
    assert all((v or 0) < 1e-9 for r in diff for v in r)


def test_running_sums_and_iat_rows(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    rows = sorted(add_step_features(df, S).where("user_id = 'A'").collect(), key=lambda r: r["timestampp"])
    assert [r["sum_secs_played"] for r in rows] == [10, 30, 70, 130]
    assert [r["iat"] for r in rows][1:] == [3600, 600, 3000]
    assert rows[0]["iat"] == ts(8, 5) - S.windows.iat_start
