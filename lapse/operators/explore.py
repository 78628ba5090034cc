"""Exploration tables."""

from __future__ import annotations

from pyspark.ml.feature import PCA
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapse.functions.buckets import hash_bucket


def churn_by(labels: DataFrame, col: str) -> DataFrame:
    """Users, churners and churn share per value of a user attribute."""
    return labels.groupBy(col).agg(F.count(F.lit(1)).alias("users"),
                                   F.sum("churn").cast("bigint").alias("churners"),
                                   F.avg(F.col("churn").cast("double")).alias("churn_share"))


def class_counts(labels: DataFrame) -> DataFrame:
    return labels.groupBy(F.col("churn").cast("bigint").alias("churn")).agg(F.count(F.lit(1)).alias("users"))


def tenure_histogram(labels: DataFrame, width: int = 10) -> DataFrame:
    """Days since registration in buckets of ``width`` days, per label."""
    b = (F.floor(F.col("days_since_registration") / F.lit(width)) * width).cast("bigint")
    return labels.groupBy(F.col("churn").cast("bigint").alias("churn"), b.alias("bucket_start")) \
        .agg(F.count(F.lit(1)).alias("users"))


def feature_trend(slots: DataFrame, labels: DataFrame, features: list[str]) -> DataFrame:
    """Mean of each feature per slot and label (zero-filled slots included)."""
    j = slots.join(labels.select("user_id", "churn"), "user_id", "inner")
    return j.groupBy(F.col("churn").cast("bigint").alias("churn"), F.col("time").cast("bigint").alias("time")) \
        .agg(*[F.avg(f).alias(f) for f in features])


def user_sample(df: DataFrame, share: float = 0.01) -> DataFrame:
    """A deterministic share of users (hash bucket 0)."""
    n = int(round(1 / share))
    return df.where(hash_bucket("user_id", n, "sample") == 0) if n > 1 else df


def projection_2d(single: DataFrame, k: int = 2) -> DataFrame:
    """Centred principal components (``pyspark.ml.feature.PCA``) of the
    single-period vectors, for a scatter of the two classes."""
    model = PCA(k=k, inputCol="features", outputCol="pcs").fit(single)
    return model.transform(single).select("user_id", "churn", "pcs")
