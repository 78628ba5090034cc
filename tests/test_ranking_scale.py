"""Positions, folds and running totals on inputs of many partitions, with
columns beyond the sort keys and at two shuffle settings."""
import os
import tempfile

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lapse.operators.folds import assign_folds, class_counts, undersample
from lapse.operators.metrics import head_k
from lapse.operators.ranking import running_totals, with_positions


@pytest.fixture(scope="module")
def scored(spark):
    root = tempfile.mkdtemp(prefix="lapse-ranking-")

    def make(n):
        path = os.path.join(root, str(n))
        if not os.path.isdir(path):
            d = spark.range(0, n, 1, 16).select(
                F.concat(F.lit("u"), "id").alias("user_id"), F.col("id").alias("row_id"),
                (F.xxhash64("id") % 2 == 0).cast("int").alias("label"),
                (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(100_000)) / 100_000).alias("score"),
                F.rand(3).alias("extra"), F.sha2(F.col("id").cast("string"), 256).alias("more"))
            d.write.parquet(path)
        return spark.read.parquet(path)

    return make


@pytest.mark.parametrize("n", [5_000, 20_000, 200_000])
@pytest.mark.parametrize("parts", ["8", "23"])
def test_exact_at_size(spark, scored, n, parts):
    d = scored(n)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        counts = class_counts(d)
        pos = with_positions(d, ["label"], ["score", "row_id"], name="p")
        got = {r["label"]: tuple(r)[1:] for r in pos.groupBy("label").agg(
            F.count(F.lit(1)), F.count_distinct("p"), F.min("p"), F.max("p")).collect()}
        assert got == {k: (c, c, 0, c - 1) for k, c in counts.items()}
        folds = assign_folds(d, 4)
        per = {(r["label"], r["fold"]): r["n"] for r in folds.groupBy("label", "fold").agg(F.count(F.lit(1)).alias("n")).collect()}
        assert sum(per.values()) == n and set(f for _, f in per) == {0, 1, 2, 3}
        assert all(max(v for (k2, _), v in per.items() if k2 == k) - min(v for (k2, _), v in per.items() if k2 == k) <= 1 for k in counts)
        least = min(counts.values())
        assert sorted(class_counts(undersample(d, 1.0)).values()) == [least, least]
        assert head_k(d, 1000).agg(F.count(F.lit(1)), F.max("row_id")).first()[:] == (1000, 999)
        assert head_k(d, 1000, by="score").count() == 1000
        per_score = d.groupBy("label", "score").agg(F.count(F.lit(1)).alias("n"))
        w = Window.partitionBy("label").orderBy(F.col("score").desc())
        want = per_score.withColumn("w", F.sum("n").over(w)).select("label", "score", "w")
        cum = running_totals(per_score, ["label"], [F.col("score").desc()], ["n"], totals="all_")
        assert cum.count() == per_score.count()
        assert cum.join(want, ["label", "score"]).where("w = cum_n").count() == per_score.count()
        assert {r[0]: r[1] for r in cum.select("label", "all_n").distinct().collect()} == counts
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
