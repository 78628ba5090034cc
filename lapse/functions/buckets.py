"""Deterministic hash buckets for sampling, splitting and undersampling.

Three independent hash families are used for the three decisions (sample,
split, undersample), as in the original.  The portable form takes the first
15 hex digits of a cryptographic digest as a non-negative BIGINT, so the same
bucket comes out of Spark and of any SQL engine with sha256/sha1/md5.
``family="xxhash"`` uses Spark's native xxhash64 instead (faster, Spark-only).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_DIGESTS = {
    "sample": lambda c: F.sha2(c, 256),
    "split": F.sha1,
    "undersample": F.md5,
}

_SQL_DIGESTS = {"sample": "sha256", "split": "sha1", "undersample": "md5"}


def hash_value(col, purpose: str = "sample", family: str = "sha", seed: int | None = None) -> Column:
    """Non-negative 60-bit hash of ``col`` (cast to string) for a purpose."""
    c = F.col(col) if isinstance(col, str) else col
    c = c.cast("string")
    if seed is not None:
        c = F.concat(c, F.lit(f"#{seed}"))
    if family == "xxhash":
        return F.pmod(F.xxhash64(c, F.lit(purpose)), F.lit(1 << 60))
    digest = _DIGESTS[purpose](c)
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def hash_bucket(col, buckets, purpose: str = "sample", family: str = "sha",
                seed: int | None = None) -> Column:
    """``hash(col) mod buckets`` (``buckets`` may be a Column)."""
    b = buckets if isinstance(buckets, Column) else F.lit(int(buckets))
    return hash_value(col, purpose, family, seed) % b


def sql_hash_value(expr: str, purpose: str = "sample", seed: int | None = None) -> str:
    """The same hash as SQL text (DuckDB dialect) for oracles."""
    e = f"CAST({expr} AS VARCHAR)"
    if seed is not None:
        e = f"({e} || '#{seed}')"
    return f"CAST(('0x' || substr({_SQL_DIGESTS[purpose]}({e}), 1, 15)) AS BIGINT)"
