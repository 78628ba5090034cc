"""Context parsing (I4: H10 rule table, H11 null defaults)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapse.functions.contexts import DEFAULT_RULES, parse_context_cols
from lapse.schema import MISSING_COORD, TOP_TYPES


def parse_context(df: DataFrame, rules: dict[str, str] | None = None) -> DataFrame:
    """Raw streams -> parsed streams with ``top_type`` and ``sub_type``.

    Null defaults as in the original: timestamp 0, skipped false, seconds 0,
    coordinates 999.9.  Rule targets must be top types of the fixed list, so
    the slot features can count distinct types from per-type counts.
    """
    rules = DEFAULT_RULES if rules is None else rules
    bad = set(rules.values()) - set(TOP_TYPES)
    if bad:
        raise ValueError(f"rule targets outside the top-type list: {sorted(bad)}")
    top, sub = parse_context_cols("play_context_decrypted", rules)
    return df.select(
        "user_id",
        F.coalesce(F.col("timestampp"), F.lit(0).cast("bigint")).alias("timestampp"),
        F.coalesce(F.col("skipped"), F.lit(False)).alias("skipped"),
        F.coalesce(F.col("secs_played"), F.lit(0).cast("bigint")).alias("secs_played"),
        "play_context_decrypted",
        top.alias("top_type"),
        sub.alias("sub_type"),
        "platform",
        F.coalesce(F.col("latitude").cast("double"), F.lit(MISSING_COORD)).alias("latitude"),
        F.coalesce(F.col("longitude").cast("double"), F.lit(MISSING_COORD)).alias("longitude"),
        "client_type",
    )
