"""Adapters from the driver's tables to the pipeline's input schemas.

The original reads private daily play, context and user-snapshot tables.
These adapters derive tables with the same schemas from ``events``,
``customer`` and ``nation`` (rules in FIXTURES.md section 3).  They are
plain projections, so filters on ``ts`` and the used columns still reach
the parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapse.schema import TOP_TYPES
from lapse.sources.tables import read_table

# Context type field chosen by k % 13 (the 11 top types in
# lower case, then 'search' and 'other').
CONTEXT_NAMES = [t.lower() for t in TOP_TYPES] + ["search", "other"]
PLATFORMS = ["android", "android-tablet", "ios"]
CLIENTS = ["client-a", "client-b"]
REGISTRATION_BASE = "2023-12-31"
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def _k() -> F.Column:
    return F.get_json_object("props", "$.k").cast("int")


def _from_k(build) -> F.Column:
    """``build`` of the props' number, which is read once however often it is
    used: a filter that is pushed to the scan repeats an expression's parts."""
    return F.get(F.transform(F.array(_k()), build), 0)


def _time() -> F.Column:
    return F.date_format("ts", TIME_FORMAT)


def plays_from_events(events: DataFrame) -> DataFrame:
    """events -> play log (user_id, time, ms_played, skipped, client_type,
    product_type, platform, hardware, location, date, ts)."""
    k = _k()
    platform = F.element_at(F.array(*[F.lit(p) for p in PLATFORMS]), (F.pmod(k, F.lit(3)) + 1).cast("int"))
    client = F.element_at(F.array(*[F.lit(c) for c in CLIENTS]), (F.pmod(k, F.lit(2)) + 1).cast("int"))
    no_loc = F.pmod(k, F.lit(10)) == 0
    location = F.when(no_loc, F.lit(None)).otherwise(
        F.struct((k - F.lit(50.0)).alias("latitude"), (F.lit(2.0) * k - F.lit(100)).alias("longitude")))
    return events.select(
        F.col("user_id").cast("string").alias("user_id"),
        _time().alias("time"),
        F.floor(F.col("value") * 1000 + F.lit(0.5)).cast("bigint").alias("ms_played"),
        (F.col("event_id") % 4 == 0).alias("skipped"),
        client.alias("client_type"),
        F.col("event_type").alias("product_type"),
        platform.alias("platform"),
        F.concat(F.lit("device-"), F.pmod(k, F.lit(4)).cast("string")).alias("hardware"),
        location.alias("location"),
        F.to_date("ts").alias("date"),
        F.col("ts"),
    )


def contexts_from_events(events: DataFrame) -> DataFrame:
    """events -> decrypted context log (user_id, time, play_context_decrypted, date, ts)."""
    names = F.array(*[F.lit(n) for n in CONTEXT_NAMES])
    return events.select(
        F.col("user_id").cast("string").alias("user_id"),
        _time().alias("time"),
        _from_k(lambda k: F.concat(F.lit("app:"), F.element_at(names, (F.pmod(k, F.lit(13)) + 1).cast("int")), F.lit(":"),
                                   k.cast("string"))).alias("play_context_decrypted"),
        F.to_date("ts").alias("date"),
        F.col("ts"),
    )


def snapshots_from_customers(customer: DataFrame, nation: DataFrame) -> DataFrame:
    """customer x nation -> user snapshot (user_id, registration_date,
    product, reporting_country).  Static: valid on every day."""
    reg = F.date_sub(F.lit(REGISTRATION_BASE).cast("date"), F.pmod(F.col("c_custkey"), F.lit(120)).cast("int"))
    return customer.join(nation, customer.c_nationkey == nation.n_nationkey, "inner").select(
        F.col("c_custkey").cast("string").alias("user_id"),
        F.date_format(reg, "yyyy-MM-dd").alias("registration_date"),
        F.col("c_mktsegment").alias("product"),
        F.col("n_name").alias("reporting_country"),
    )


def load_fixture(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """plays, contexts and snapshots from ``sf_dir``; every event is kept."""
    events = read_table(spark, sf_dir, "events")
    customer = read_table(spark, sf_dir, "customer")
    nation = read_table(spark, sf_dir, "nation")
    return {
        "plays": plays_from_events(events),
        "contexts": contexts_from_events(events),
        "snapshots": snapshots_from_customers(customer, nation),
    }
