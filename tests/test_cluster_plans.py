"""Plans and stages at cluster settings."""
import os

from pyspark.sql import functions as F

from fixture_paths import SF_MID
from lapse.operators.prepare import fit_scaler
from lapse.operators.slots import slot_features
from lapse.operators.sample import filter_raw
from lapse.plans.queries import Ctx
from lapse.session import checkpoint_dir, cluster_conf, drop_stages, materialize


def test_plays_are_not_shuffled_to_be_filtered_by_sampled_ids(spark):
    conf = cluster_conf(4000, 40 * 2**40)
    assert int(conf["spark.sql.shuffle.partitions"]) >= 160_000
    old = {k: spark.conf.get(k, None) for k in conf}
    c = Ctx(spark, SF_MID)
    users = c.users(staged=True)
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        plan = filter_raw(c.plays, c.contexts, users, c.s)._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    semi = [line for line in plan.splitlines() if "LeftSemi" in line]
    assert len(semi) == 2 and all("BroadcastHashJoin" in line for line in semi), plan


def test_one_scan_and_one_exchange_of_stream_rows(spark):
    c = Ctx(spark, SF_MID)
    parsed = c.staged_parsed()
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = slot_features(parsed, c.s)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert plan.count("FileScan parquet") == 1 and "Join" not in plan
    # stream rows by (user, slot) once; slot rows by user for the carry-over
    assert plan.count("Exchange hashpartitioning(user_id") == 2, plan


def test_stages_of_the_application_are_dropped(spark):
    path = materialize(spark.range(5)).inputFiles()[0]
    folder = os.path.dirname(path.removeprefix("file://").removeprefix("file:"))
    assert os.path.isdir(folder) and folder.startswith(checkpoint_dir(spark).removeprefix("file:"))
    assert drop_stages(spark) and not os.path.exists(folder)


def test_scaler_on_the_training_split(spark):
    rows = spark.createDataFrame([(f"u{i}", i, float(i), False) for i in range(400)],
                                 "user_id string, time long, iat double, backfill boolean")
    from lapse.operators.prepare import split
    want = split(rows, 0.1).where("split = 'train'").agg(F.avg("iat")).first()[0]
    assert abs(fit_scaler(rows, ["iat"], fit_on="train").mean["iat"] - want) < 1e-9
    assert fit_scaler(rows, ["iat"]).mean["iat"] == 199.5
