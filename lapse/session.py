"""Session settings the library relies on, and the shared checkpoint folder."""

from __future__ import annotations

import contextlib
import contextvars
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings every job here expects.  Times are computed in UTC
# without relying on the session zone, but the zone is pinned for output.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # the JVM compiles no method above 8000 bytecodes: stages of wide rows run
    # faster as split projections than as one such method
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def configure(spark: SparkSession) -> SparkSession:
    for k, v in RUNTIME_CONF.items():
        try:
            spark.conf.set(k, v)
        except Exception:  # some settings are static on shared clusters
            pass
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "lapse",
                  driver_memory: str = "8g") -> SparkSession:
    """A local session for tests and benchmarks (UI off, UTC, AQE on)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    Read from the session; a folder is set only when none is configured,
    which happens in local tests.
    """
    d = spark.sparkContext.getCheckpointDir()
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set; point it at the cluster's shared folder")
        d = tempfile.mkdtemp(prefix="lapse-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return spark.sparkContext.getCheckpointDir() or d


def stage_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for a written stage."""
    return os.path.join(checkpoint_dir(spark), "stages", name)


def unique_name(spark: SparkSession) -> str:
    """A name for a stage of this application that no other stage has."""
    return f"{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"


#: Paths of the stages written inside the open ``stages`` scopes, innermost last.
_scopes: contextvars.ContextVar[tuple[list[str], ...]] = contextvars.ContextVar("scopes", default=())


def register(path: str) -> None:
    """Note a stage's path, for its removal when the innermost scope ends."""
    scopes = _scopes.get()
    if scopes:
        scopes[-1].append(path)


def discard(spark: SparkSession, *paths: str) -> None:
    """Remove stages that nothing reads any more."""
    for p in paths:
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p)
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


@contextlib.contextmanager
def stages(spark: SparkSession):
    """A scope whose stages go when it ends, also by an error: what is computed
    inside must be written (or collected) inside.  Yields the list of paths."""
    own: list[str] = []
    token = _scopes.set((*_scopes.get(), own))
    try:
        yield own
    finally:
        _scopes.reset(token)
        discard(spark, *own)


def keep(df: DataFrame, path: str) -> DataFrame:
    """Write a result where it is to stay and read it back: the last thing to
    do inside a ``stages`` scope."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize(df: DataFrame, name: str | None = None) -> DataFrame:
    """Cut the lineage of a frame that several jobs reuse: write it as
    parquet under the shared checkpoint folder and read it back (one job;
    survives executor loss, unlike a local checkpoint)."""
    path = stage_path(df.sparkSession, name or unique_name(df.sparkSession))
    df.write.mode("overwrite").parquet(path)
    if name is None:
        register(path)
    return df.sparkSession.read.parquet(path)


def drop_stages(spark: SparkSession) -> bool:
    """Remove all unnamed stages this application has written.  Call it when
    no frame that reads them is needed any more (results are written)."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(stage_path(spark, spark.sparkContext.applicationId))
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(folder) and fs.delete(folder, True))


def cluster_conf(total_cores: int, shuffle_bytes: float, sampled_ids: int = 0) -> dict:
    """Suggested settings for a large cluster (set them at submit time).

    ``shuffle_bytes`` is the expected size of the largest shuffle (for the
    slot features: the projected play rows of the whole pull).  Initial
    shuffle partitions are sized to ~256 MB each and at least 3 per core;
    AQE then coalesces small ones and splits skewed join partitions.

    ``sampled_ids`` (the row count of the staged sample) sizes the Bloom
    filter that drops other users' plays before their shuffle where the ids
    are too many to be broadcast: 10 bits an id keep out 99 % of the others.
    """
    target = 256 * 1024 * 1024
    parts = max(3 * total_cores, int(shuffle_bytes // target) + 1)
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": "512m",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
        # a side whose files are known to be small (the staged sample of user
        # ids) is broadcast from the start, so play rows are not shuffled by
        # user only to be filtered; AQE adds what it measures at run time
        "spark.sql.autoBroadcastJoinThreshold": "64m",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
        "spark.sql.session.timeZone": "UTC",
        **bloom_conf(sampled_ids),
    }


BLOOM_BITS = 10  # for each id
_MOST_BITS = 1 << 27  # 16 MB: the filter travels with every task


def bloom_conf(sampled_ids: int) -> dict:
    """Settings of the runtime Bloom filter for a semi join with so many ids."""
    bits = min(max(BLOOM_BITS * sampled_ids, 1 << 23), _MOST_BITS)
    return {
        "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
        "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "8g",
        "spark.sql.optimizer.runtime.bloomFilter.expectedNumItems": str(max(sampled_ids, 1_000_000)),
        "spark.sql.optimizer.runtime.bloomFilter.maxNumItems": str(max(sampled_ids, 4_000_000)),
        "spark.sql.optimizer.runtime.bloomFilter.numBits": str(bits),
        "spark.sql.optimizer.runtime.bloomFilter.maxNumBits": str(max(bits, 1 << 26)),
    }
