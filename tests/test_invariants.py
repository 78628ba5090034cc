"""Invariants on the fixture pipeline (SURVEY section 5 (b))."""
import pytest
from pyspark.sql import functions as F

from fixture_paths import SF_MID
from lapse.operators import labels as L
from lapse.operators import prepare as P
from lapse.operators.steps import add_running_sums
from lapse.plans.queries import LABELLED, Ctx
from lapse.schema import COUNT_COLS, MODEL_FEATURES, SUM_COLS


@pytest.fixture(scope="module")
def ctx(spark):
    return Ctx(spark, SF_MID, LABELLED)


def test_fill_grid(ctx):
    filled = ctx.filled()
    n_users = ctx.labels().count()
    n_slots = len(ctx.s.windows.training_slots())
    assert filled.count() == n_users * n_slots
    assert filled.select("user_id", "time").distinct().count() == n_users * n_slots
    zeros = filled.where("backfill").select(*[F.max(F.abs(F.col(c))).alias(c) for c in MODEL_FEATURES]).first()
    assert all((v or 0) == 0 for v in zeros)


def test_normalized_real_rows(ctx):
    n = ctx.normed().where(~F.col("backfill"))
    stats = n.select(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(MODEL_FEATURES)],
                     *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(MODEL_FEATURES)]).first()
    for i in range(len(MODEL_FEATURES)):
        assert abs(stats[f"m{i}"]) < 1e-9
        assert stats[f"s{i}"] == pytest.approx(1.0) or stats[f"s{i}"] == pytest.approx(0.0)


def test_arrays_equal_long_fill(ctx):
    arr = ctx.arrays()
    assert arr.count() == ctx.labels().count()
    n_slots = len(ctx.s.windows.training_slots())
    assert arr.where(F.size("times") != n_slots).count() == 0
    long = ctx.normed()
    got = arr.select("user_id", F.posexplode("secs_played").alias("i", "v"))
    exp = long.select("user_id", "time", "secs_played")
    t = arr.select("user_id", F.posexplode("times").alias("i", "time"))
    j = got.join(t, ["user_id", "i"]).join(exp, ["user_id", "time"])
    assert j.count() == long.count()
    assert j.where(F.abs(F.col("v") - F.col("secs_played")) > 1e-9).count() == 0


def test_splits_disjoint_complete(ctx):
    sp = P.split_tables(ctx.labels(), ctx.s.testsize)
    ids = [set(r.user_id for r in d.select("user_id").collect()) for d in sp.values()]
    allids = set(r.user_id for r in ctx.labels().select("user_id").collect())
    assert sum(len(i) for i in ids) == len(allids) and set().union(*ids) == allids


def test_running_sums_never_fall(ctx):
    from pyspark.sql import Window
    rs = add_running_sums(ctx.parsed(), ctx.s)
    w = Window.partitionBy("user_id").orderBy("timestampp", "secs_played", "play_context_decrypted")
    bad = rs.select(*[(F.col(c) - F.lag(c).over(w)).alias(c) for c in SUM_COLS]) \
        .where(" OR ".join(f"{c} < 0" for c in SUM_COLS))
    assert bad.count() == 0


def test_counts_divisible_by_k(ctx):
    ref = ctx.slots("reference")
    plain = ctx.slots("none")
    j = ref.alias("r").join(plain.alias("p"), ["user_id", "time"])
    k = F.col("r.total_streams") / F.col("p.total_streams")
    bad = j.where((k != F.floor(k)) | F.expr(" OR ".join(
        f"r.{c} != p.{c} * (r.total_streams / p.total_streams)" for c in COUNT_COLS)))
    assert bad.count() == 0


def test_labels_both_classes(ctx):
    counts = {r["churn"]: r["count"] for r in ctx.labels().groupBy("churn").count().collect()}
    assert set(counts) == {0, 1}
