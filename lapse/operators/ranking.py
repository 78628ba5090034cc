"""Global positions and running totals without a single-partition window.

``Window.orderBy(...)`` without a partition key moves all rows into one
task.  The helpers here number or sum rows inside buckets and add the totals
of the buckets before; the bucket table is small (buckets times groups).

A row's bucket must be the same wherever it is read.  ``with_positions`` and
``running_totals`` therefore range-partition the rows once and *write* them
with their bucket; both the rows and the bucket totals are read from those
files, so no result depends on a second, differently sampled exchange, on
exchange reuse or on the number of shuffle partitions.  ``hash_positions``
orders by a uniform hash and needs no files: the bucket is the hash's top bits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lapse.session import materialize

HASH_BITS = 60
_BUCKET_BITS = 12


def _parts(df: DataFrame, n: int | None) -> int:
    if n:
        return n
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _as_cols(cols) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def _bucketed(df: DataFrame, keys: list[Column], num_partitions: int | None) -> DataFrame:
    """The rows in range partitions of ``keys``, written with their partition
    number ``_bucket``."""
    ranged = df.repartitionByRange(_parts(df, num_partitions), *keys)
    return materialize(ranged.withColumn("_bucket", F.spark_partition_id()))


def _before(stats: DataFrame, group_cols: list[str], values: list[str]) -> DataFrame:
    """Sums of ``values`` over the lower buckets of the group (``_b_<v>``) and
    over the whole group (``_g_<v>``), one row per bucket and group."""
    w = Window.partitionBy(*group_cols) if group_cols else Window.partitionBy(F.lit(0))
    lower = w.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    return stats.select("_bucket", *group_cols,
                        *[F.coalesce(F.sum(v).over(lower), F.lit(0)).alias(f"_b_{v}") for v in values],
                        *[F.sum(v).over(w).alias(f"_g_{v}") for v in values])


def _join_stats(rows: DataFrame, stats: DataFrame, group_cols: list[str]) -> DataFrame:
    right = stats.select(F.col("_bucket").alias("_sb"), *[F.col(g).alias(f"_s_{g}") for g in group_cols],
                         *[c for c in stats.columns if c.startswith(("_b_", "_g_"))])
    cond = F.col("_bucket") == F.col("_sb")
    for g in group_cols:
        cond = cond & F.col(g).eqNullSafe(F.col(f"_s_{g}"))
    return rows.join(right, cond, "inner").drop("_sb", *[f"_s_{g}" for g in group_cols])


def with_positions(df: DataFrame, group_cols: list[str], order_cols: list, name: str = "pos",
                   num_partitions: int | None = None) -> DataFrame:
    """Add ``name``: 0-based position of each row inside its group in the given
    order.  The order columns must make rows unique (add an id) so the
    numbering is reproducible."""
    order = _as_cols(order_cols)
    rows = _bucketed(df, _as_cols(group_cols) + order, num_partitions)
    stats = rows.groupBy("_bucket", *group_cols).agg(F.count(F.lit(1)).alias("n"))
    own = Window.partitionBy("_bucket", *group_cols).orderBy(*order)
    rows = rows.withColumn("_own", F.row_number().over(own) - 1)
    out = _join_stats(rows, _before(stats, group_cols, ["n"]), group_cols)
    return out.withColumn(name, F.col("_b_n") + F.col("_own")).drop("_bucket", "_own", "_b_n", "_g_n")


def hash_positions(df: DataFrame, group_cols: list[str], hash_col: str, key: str, name: str = "pos") -> DataFrame:
    """Add ``name``: 0-based position inside the group ordered by
    (``hash_col``, ``key``), for a hash uniform over 0..2^60 - 1."""
    rows = df.withColumn("_bucket", F.shiftright(hash_col, HASH_BITS - _BUCKET_BITS))
    stats = rows.groupBy("_bucket", *group_cols).agg(F.count(F.lit(1)).alias("n"))
    own = Window.partitionBy("_bucket", *group_cols).orderBy(hash_col, key)
    rows = rows.withColumn("_own", F.row_number().over(own) - 1)
    out = _join_stats(rows, _before(stats, group_cols, ["n"]), group_cols)
    return out.withColumn(name, F.col("_b_n") + F.col("_own")).drop("_bucket", "_own", "_b_n", "_g_n")


def running_totals(df: DataFrame, group_cols: list[str], order_cols: list, value_cols: list[str],
                   prefix: str = "cum_", totals: str | None = None, num_partitions: int | None = None) -> DataFrame:
    """Add ``cum_<v>``: inclusive running sum of each value column inside
    its group in the given order (order columns unique within the group), and
    with ``totals`` the group's sums as ``<totals><v>``."""
    order = _as_cols(order_cols)
    rows = _bucketed(df, _as_cols(group_cols) + order, num_partitions)
    inner = Window.partitionBy("_bucket", *group_cols).orderBy(*order) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    stats = rows.groupBy("_bucket", *group_cols).agg(*[F.sum(v).alias(v) for v in value_cols])
    rows = rows.withColumns({f"_in_{v}": F.sum(v).over(inner) for v in value_cols})
    out = _join_stats(rows, _before(stats, group_cols, value_cols), group_cols)
    new = {f"{prefix}{v}": F.col(f"_b_{v}") + F.col(f"_in_{v}") for v in value_cols}
    if totals is not None:
        new |= {f"{totals}{v}": F.col(f"_g_{v}") for v in value_cols}
    return out.withColumns(new).drop("_bucket", *[f"{p}{v}" for v in value_cols for p in ("_in_", "_b_", "_g_")])
