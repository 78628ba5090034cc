"""Scans of day-partitioned tables (A1, A2)."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Parquet table ``root/name.parquet``, or else ``root/name`` (file or
    partitioned folder), on any storage Spark can read."""
    try:
        return spark.read.parquet(f"{root}/{name}.parquet")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.read.parquet(f"{root}/{name}")


def read_days(df: DataFrame, first: dt.date, last: dt.date, dates: list | None = None) -> DataFrame:
    """Rows of the daily partitions ``first``..``last`` (both included).

    On a table partitioned by ``date`` this is partition pruning.  When the
    frame also carries the raw timestamp ``ts`` (the fixture adapters keep
    it), the same range is added on ``ts`` so the bound reaches the parquet
    scan as a pushed filter.
    """
    cond = F.col("date").between(F.lit(first), F.lit(last))
    if dates is not None:
        cond = F.col("date").isin([F.lit(d) for d in dates])
    if "ts" in df.columns:
        lo = dt.datetime.combine(first, dt.time())
        hi = dt.datetime.combine(last + dt.timedelta(days=1), dt.time())
        cond = cond & (F.col("ts") >= F.lit(lo).cast("timestamp_ntz")) & (F.col("ts") < F.lit(hi).cast("timestamp_ntz"))
    return df.where(cond)


def snapshot_on(snap: DataFrame, day: dt.date | None) -> DataFrame:
    """The user snapshot of one day; a snapshot without a ``date`` column is
    treated as valid on every day."""
    if day is not None and "date" in snap.columns:
        return snap.where(F.col("date") == F.lit(day)).drop("date")
    return snap.drop("date") if "date" in snap.columns else snap
