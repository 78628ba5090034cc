"""Run a named query to a result that stays, and leave no stages behind."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lapse.session import keep, stages


def run_query(query: Callable[[SparkSession, str], DataFrame], spark: SparkSession, sf_dir: str, path: str) -> DataFrame:
    """Write a query's result under ``path`` and read it back; the stages it
    wrote on the way are removed, also if it fails."""
    with stages(spark):
        return keep(query(spark, sf_dir), path)
