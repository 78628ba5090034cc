"""Small helpers the operators share: table access, stages, stable numbering."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lapse.session import checkpoint_dir, register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: While a stage is written: what the write shuffled goes at its end, as nothing
#: will read it again.
_WRITING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
#: For the whole session: texts reach Python in small batches.
_SESSION = {"spark.sql.execution.arrow.maxBytesPerBatch": "4m"}


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once under the shared checkpoint folder and read it back:
    the lineage is cut and any executor can reread the files."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"
    register(path)
    before = {k: spark.conf.get(k) for k in _WRITING}
    try:
        for k, v in _WRITING.items():
            spark.conf.set(k, v)
        df.write.parquet(path)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    out = spark.read.schema(df.schema).parquet(path)
    out.stage_path = path
    return out


def discard(*stages: DataFrame) -> None:
    """Remove stages that no other frame reads any more."""
    for s in stages:
        jvm = s.sparkSession.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(s.stage_path)
        path.getFileSystem(s.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def prepare(spark: SparkSession) -> None:
    """Session settings of this package, and let Python workers import it from
    where the driver has it (a no-op where it is installed or sent along with
    the job)."""
    for k, v in _SESSION.items():
        spark.conf.set(k, v)
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    known = env.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (known, root) if x)


def texts(docs: DataFrame) -> DataFrame:
    """``(doc_id long, text string)``; other columns, whatever their names,
    never reach the operators."""
    prepare(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def unused(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def number_rows(df: DataFrame, group: list[str], order: list[Column], salt: Column, name: str,
                salts: int = 1024) -> DataFrame:
    """Add ``name``: gapless 0-based numbers inside each ``group``.

    Rows are numbered inside (group, salt) and shifted by the row counts of
    the lower salts.  The count table has at most ``salts`` rows a group, so
    no group, however large, is numbered in one task.
    """
    d = df.withColumn("_salt", F.pmod(salt, F.lit(salts)).cast("int"))
    n = d.groupBy(*group, "_salt").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    n = n.select(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)], F.col("_salt").alias("_s"),
                 (F.sum("_n").over(before.orderBy("_salt")) - F.col("_n")).alias("_before"))
    on = [F.col(g).eqNullSafe(F.col(f"_g{i}")) for i, g in enumerate(group)] + [F.col("_salt") == F.col("_s")]
    cond = on[0]
    for c in on[1:]:
        cond = cond & c
    own = Window.partitionBy(*group, "_salt").orderBy(*order)
    d = d.withColumn("_own", F.row_number().over(own) - 1).join(n, cond, "inner")
    return (d.withColumn(name, F.col("_before") + F.col("_own"))
            .drop("_salt", "_s", "_before", "_own", *[f"_g{i}" for i in range(len(group))]))
