"""One row per user from slots and labels: plan, odd rows, and the scaler's moments."""

import math

from lapse.conf import resolve
from lapse.operators.prepare import fit_scaler, to_user_arrays

S = resolve("fixture", "26_3d")
GRID = S.windows.training_slots()
SLOTS = "user_id string, time long, iat double, skip_ratio double"


def _frames(spark):
    slots = spark.createDataFrame([("a", GRID[2], 3.0, None), ("a", GRID[0], 1.0, 0.5), ("b", GRID[-1], 7.0, 0.25),
                                   (None, GRID[1], 9.0, 0.1), ("unlabelled", GRID[1], 9.0, 0.1)], SLOTS)
    labels = spark.createDataFrame([("a", 0), ("b", 1), ("b", 1), ("none", 1), (None, 1)], "user_id string, churn int")
    return slots, labels


def test_slots_are_not_collected_by_an_object_aggregate(spark):
    plan = to_user_arrays(*_frames(spark), S)._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan and "Join" not in plan, plan
    assert plan.count("Exchange hashpartitioning(user_id") == 1


def test_filled_arrays_of_odd_rows(spark):
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    for per_batch in ("2", old):  # also users that go on in the next batch
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", per_batch)
        try:
            rows = to_user_arrays(*_frames(spark), S).collect()
        finally:
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
        assert sorted(str(r["user_id"]) for r in rows) == ["None", "a", "b", "b", "none"]
        by_user = {r["user_id"]: r for r in rows}
        assert all(r["times"] == GRID for r in rows)
        a, b = by_user["a"], by_user["b"]
        assert a["churn"] == 0 and a["iat"] == [1.0, 0.0, 3.0] + [0.0] * (len(GRID) - 3)
        assert a["skip_ratio"][:3] == [0.5, 0.0, None] and a["filled"][:4] == [False, True, False, True]
        assert b["iat"] == [0.0] * (len(GRID) - 1) + [7.0] and b["filled"].count(False) == 1
        for u in ("none", None):
            assert by_user[u]["iat"] == [0.0] * len(GRID) and all(by_user[u]["filled"])


def test_arrays_without_filling(spark):
    rows = {r["user_id"]: r for r in to_user_arrays(*_frames(spark), S, fill=False).collect()}
    assert set(rows) == {"a", "b"}
    assert rows["a"]["times"] == [GRID[0], GRID[2]] and rows["a"]["iat"] == [1.0, 3.0]


def test_moments_of_many_tasks(spark):
    df = spark.range(1000).repartition(7).selectExpr(
        "cast(id as string) as user_id", "id as time", "1e9 + id as iat", "0.1D as skip_ratio",
        "if(id < 10, cast(id as double), null) as secs_played", "cast(null as double) as secs_played_std")
    got = fit_scaler(df, ["iat", "skip_ratio", "secs_played", "secs_played_std"])
    assert math.isclose(got.mean["iat"], 1e9 + 499.5, rel_tol=1e-15)
    assert math.isclose(got.std["iat"], math.sqrt((1000 ** 2 - 1) / 12), rel_tol=1e-9)
    assert got.mean["skip_ratio"] == 0.1 and got.std["skip_ratio"] == 0.0  # a constant has exactly none
    assert got.mean["secs_played"] == 4.5 and math.isclose(got.std["secs_played"], math.sqrt(99 / 12))
    assert got.mean["secs_played_std"] is None and got.std["secs_played_std"] is None
