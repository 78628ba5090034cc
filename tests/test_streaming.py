import os
import tempfile

import pytest
from pyspark.sql import functions as F

from fixture_paths import SF_SMALL
from lapse.plans.queries import Ctx
from lapse.schema import SECS_COLS
from lapse.streaming.slots import slot_stats_stream


def test_stream_matches_batch(spark):
    c = Ctx(spark, SF_SMALL)
    parsed = c.parsed()
    root = tempfile.mkdtemp(prefix="lapse-stream-")
    src = os.path.join(root, "in")
    parsed.write.parquet(src)
    stream = spark.readStream.schema(parsed.schema).parquet(src)
    q = (slot_stats_stream(stream, c.s).writeStream.outputMode("complete").format("memory")
         .queryName("slot_stats_test").trigger(availableNow=True).start())
    q.awaitTermination(300)
    got = spark.table("slot_stats_test")
    w = c.s.windows
    got = got.where((F.col("time") >= w.first_start) & (F.col("time") < w.last_end))
    exp = c.slots("none")
    j = got.alias("g").join(exp.alias("e"), ["user_id", "time"])
    assert got.count() == exp.count() == j.count()
    cols = ["total_streams", "skip_ratio", "unique_top_types"] + SECS_COLS + [f"{x}_std" for x in SECS_COLS]
    bad = j.where(" OR ".join(f"abs(g.{x} - e.{x}) > 1e-9" for x in cols))
    assert bad.count() == 0


def test_append_with_watermark(spark):
    from lapse.streaming.slots import start_slot_stats
    c = Ctx(spark, SF_SMALL)
    parsed = c.parsed()
    root = tempfile.mkdtemp(prefix="lapse-stream2-")
    parsed.write.parquet(os.path.join(root, "in"))
    stream = spark.readStream.schema(parsed.schema).parquet(os.path.join(root, "in"))
    q = start_slot_stats(stream, c.s, os.path.join(root, "out"), os.path.join(root, "ckpt"),
                         trigger={"availableNow": True})
    q.awaitTermination(300)
    out = spark.read.parquet(os.path.join(root, "out"))
    batch = c.slots("none")
    # closed slots only: everything up to the watermark has been emitted, and matches the batch rows
    assert out.count() > 0
    j = out.join(batch, ["user_id", "time"])
    assert j.count() == out.where(F.col("time") >= c.s.windows.first_start).count()
