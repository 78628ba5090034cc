"""The slot aggregation of wide rows: hash aggregation, and the any-values and
distinct combinations on odd rows."""

from pyspark.sql import functions as F

from lapse.conf import resolve
from lapse.operators.slots import slot_features

COLS = ("user_id string, timestampp long, skipped boolean, secs_played long, play_context_decrypted string, "
        "top_type string, platform string, latitude double, longitude double, client_type string")


def _parsed(spark, s):
    t = s.windows.first_start
    return spark.createDataFrame([
        ("u", t + 10, False, 5, "a", "Radio", "ios", 0.0, 1.0, "b"),
        ("u", t + 20, True, 7, "a", "Radio", "ios", -0.0, 1.0, "b"),
        ("u", t + 30, False, 9, "a", "Mix", None, 999.9, 999.9, "a"),
        ("u", t + 30, False, 9, "a", "Mix", None, 999.9, 999.9, "a"),
        ("v", t + 40, False, 3, "a", "Charts", None, None, None, None)], COLS)


def test_texts_are_not_in_aggregation_buffers(spark):
    s = resolve("fixture", "26_3d")
    plan = slot_features(_parsed(spark, s), s)._jdf.queryExecution().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan


def test_combinations_and_any_values_of_odd_rows(spark):
    s = resolve("fixture", "26_3d")
    rows = {r["user_id"]: r for r in slot_features(_parsed(spark, s), s).collect()}
    u, v = rows["u"], rows["v"]
    assert (u["total_streams"], v["total_streams"]) == (8, 1)  # zeros of either sign are one place
    assert (u["top_type"], u["platform"], u["client_type"]) == ("Mix", "ios", "a")
    assert (u["latitude"], u["longitude"], u["unique_top_types"]) == (0.0, 1.0, 2)
    assert (v["top_type"], v["platform"], v["client_type"], v["latitude"]) == ("Charts", None, None, None)


def test_wide_stages_are_split(spark):
    assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000
