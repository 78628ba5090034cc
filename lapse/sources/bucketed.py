"""Plays and contexts written once in buckets of users.

Every dataset of every experiment joins plays with contexts on (user, time,
day).  Tables bucketed by user hold both sides of a user in buckets of the
same number, so the join reads them side by side and shuffles neither.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

#: A bucket of the user holds all keys of the join, which have the user first.
CO_LOCATED = {"spark.sql.requireAllClusterKeysForCoPartition": "false"}


def write_bucketed(df: DataFrame, table: str, buckets: int, root: str | None = None, key: str = "user_id") -> DataFrame:
    """Write ``df`` as a table in daily folders and ``buckets`` of ``key``
    (under ``root`` if given, else in the warehouse) and read it."""
    parts = df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
    if "date" in df.columns:
        parts = parts.partitionBy("date")
    if root:
        parts = parts.option("path", os.path.join(root, table))
    parts.saveAsTable(table)
    return df.sparkSession.table(table)


def use_buckets(spark: SparkSession) -> None:
    """Let joins on more keys than the bucket's use the buckets."""
    for k, v in CO_LOCATED.items():
        spark.conf.set(k, v)


def bucketed(plays: DataFrame, contexts: DataFrame, name: str, buckets: int,
             root: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Both sources as bucketed tables ``<name>_plays`` and ``<name>_contexts``.
    The number of buckets should keep a bucket of a day's pull in a task's
    memory; later datasets only read."""
    use_buckets(plays.sparkSession)
    return (write_bucketed(plays, f"{name}_plays", buckets, root),
            write_bucketed(contexts, f"{name}_contexts", buckets, root))
