"""Stage lifetime, bucketed sources, Bloom filters, pruned results, quantiles by rank."""
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from fixture_paths import SF_MID, SF_SMALL
from lapse.operators import metrics as M
from lapse.operators.sample import filter_raw
from lapse.plans.queries import LABELLED, Ctx, settings
from lapse.plans.run import run_query
from lapse.plans.training import train_run
from lapse.session import bloom_conf, checkpoint_dir, materialize, stages
from lapse.sources.bucketed import bucketed
from lapse.sources.io import read_runs, write_run


def files(spark):
    root = checkpoint_dir(spark).removeprefix("file:")
    return {os.path.join(d, f) for d, _, fs in os.walk(root) for f in fs}


@pytest.fixture
def conf(spark):
    """Set session settings for one test."""
    before = {}

    def change(new):
        for k, v in new.items():
            before.setdefault(k, spark.conf.get(k, None))
            spark.conf.set(k, v)

    yield change
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("name", ["churn_labels", "auc_summary", "run_metrics_read", "score_five_number"])
def test_a_query_leaves_no_stages(spark, tmp_path, name):
    before = files(spark)
    got = run_query(E.queries()[name], spark, SF_SMALL, str(tmp_path / name))
    assert files(spark) == before and got.count() == E.queries()[name](spark, SF_SMALL).count() > 0


def test_a_failing_query_leaves_no_stages(spark, tmp_path):
    before = files(spark)

    def query(spark, sf):
        return materialize(spark.range(5)).select(F.raise_error(F.lit("no")).alias("x"))

    with pytest.raises(Exception, match="no"):
        run_query(query, spark, SF_SMALL, str(tmp_path / "x"))
    assert files(spark) == before


def test_scopes_are_nested(spark):
    with stages(spark) as outer:
        a = materialize(spark.range(3))
        with stages(spark) as inner:
            materialize(spark.range(4))
        assert len(outer) == len(inner) == 1 and a.count() == 3
    assert not os.path.exists(outer[0].removeprefix("file:"))


def test_a_training_run_leaves_its_results_only(spark, tmp_path):
    arrays = materialize(Ctx(spark, SF_SMALL, LABELLED).arrays())
    before = files(spark)
    preds, _, _ = train_run(arrays, "gnb", settings(LABELLED), out=str(tmp_path))
    assert files(spark) == before
    assert preds.count() == arrays.count() and set(preds.columns) >= {"experiment", "dataset", "model", "score"}


def test_bloom_filter_below_the_exchange_of_plays(spark, conf):
    c = Ctx(spark, SF_MID)
    users = c.users(staged=True)
    conf({**bloom_conf(1_000_000), "spark.sql.autoBroadcastJoinThreshold": "-1",
          "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0"})
    assert spark.conf.get("spark.sql.optimizer.runtime.bloomFilter.numBits") == "10000000"
    raw = filter_raw(c.plays, c.contexts, users, c.s)
    plan = raw._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    probes = [i for i, line in enumerate(lines) if "might_contain" in line and "Filter" in line]
    assert len(probes) >= 2, plan  # plays and contexts
    for i in probes:  # an exchange stands above the filter
        depth = len(lines[i]) - len(lines[i].lstrip(" :+-"))
        above = next(j for j in range(i - 1, -1, -1) if "Exchange hashpartitioning(user_id" in lines[j])
        assert len(lines[above]) - len(lines[above].lstrip(" :+-")) < depth
    want = raw.count()
    conf({"spark.sql.optimizer.runtime.bloomFilter.enabled": "false"})
    assert filter_raw(c.plays, c.contexts, users, c.s).count() == want > 0


def test_bucketed_sources_are_joined_without_an_exchange(spark, conf, tmp_path):
    conf({"spark.sql.requireAllClusterKeysForCoPartition": "true", "spark.sql.autoBroadcastJoinThreshold": "1m"})
    c = Ctx(spark, SF_MID)
    plays, contexts = bucketed(c.plays, c.contexts, "lapse_test", 6, str(tmp_path))
    try:
        conf({"spark.sql.autoBroadcastJoinThreshold": "100k"})  # ids only
        for dataset in ("26_3d", "12_3d"):  # every dataset's pull
            raw = filter_raw(plays, contexts, c.users(staged=True), settings(dataset))
            plan = raw._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" in plan and "Exchange hashpartitioning" not in plan, plan
            want = filter_raw(c.plays, c.contexts, c.users(staged=True), settings(dataset))
            assert sorted(map(str, raw.collect())) == sorted(map(str, want.collect()))
    finally:
        for t in ("plays", "contexts"):
            spark.sql(f"DROP TABLE IF EXISTS lapse_test_{t}")


def test_other_runs_are_not_read(spark, tmp_path):
    root = str(tmp_path)
    for d in ("26_1d", "12_1d"):
        for m in ("lr", "rf_16f"):
            preds = spark.createDataFrame([(f"{d}{m}", 1, 0.5)], "user_id string, label int, score double")
            write_run(preds, spark.createDataFrame([(0,)], "setting int"), {"a": 1.0}, root, "obs", d, m)
    assert read_runs(spark, root).count() == 4 and read_runs(spark, root, "none").count() == 0
    one = read_runs(spark, root, "obs", "12_1d", "rf_16f")
    assert [r["user_id"] for r in one.collect()] == ["12_1drf_16f"]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(experiment" in plan, plan
    scan = one._jdf.queryExecution().sparkPlan().collectLeaves().head()
    assert scan.relation().location().listFiles(scan.partitionFilters(), scan.dataFilters()).size() == 1


def test_quantiles_by_rank(spark):
    n = 2_000_000
    df = spark.range(n).select((F.col("id") % 3 == 0).alias("g"), (F.xxhash64("id") / 2.0**63).alias("v"))
    got = {r["g"]: r for r in M.five_number(df, "v", ["g"]).collect()}
    x = df.toPandas()
    for g in (False, True):
        v = x.v[x.g == g].to_numpy()
        assert np.allclose([got[g][c] for c in ("min", "q1", "median", "q3", "max")], np.percentile(v, [0, 25, 50, 75, 100]),
                           rtol=0, atol=1e-15)
    odd = spark.createDataFrame([("a", 1.0), ("a", None), ("a", 1.0), ("a", 4.0), ("b", None), (None, 2.0)], "g string, v double")
    rows = {r["g"]: tuple(r)[1:] for r in M.five_number(odd, "v", ["g"]).collect()}
    assert rows == {"a": (1.0, 1.0, 1.0, 2.5, 4.0), "b": (None,) * 5, None: (2.0,) * 5}
    assert M.five_number(odd, "v").first()["median"] == 1.5


def test_best_scores_of_every_group(spark):
    df = spark.range(1000).select((F.col("id") % 4).alias("g"), F.col("id").alias("row_id"), (F.col("id") % 7).cast("double").alias("score"))
    got = M.head_k(df, 3, ["g"], by="score")
    assert got.groupBy("g").count().where("count <> 3").count() == 0 and got.where("score <> 6").count() == 0
    assert "WindowGroupLimit" in got._jdf.queryExecution().executedPlan().toString()
    assert [r["row_id"] for r in M.head_k(df, 2, by="score").collect()] == [6, 13]
