"""Operator 1: near-duplicate documents by MinHash with tensored banding.

Two small collections of ``m`` half keys are computed for a document, each
half key from ``rows`` MinHash values.  Every pair (left half, right half) is
the key of one table: ``m * m`` tables cost only ``2 * m * rows`` MinHash
values, about a square root of what separate bands would need.  A pair of
similarity J meets in a table unless all left or all right halves differ:
at J = 0.85 with m = 8 and rows = 2 it is missed with probability 7e-5.
Candidates are confirmed on the full shingle sets.

Results for odd input: a null or blank text has the empty set and is linked
with nothing; rows that share a doc_id are one node, linked with all that one
of their texts is linked with; a row without a doc_id is linked with nothing
and has a null component; an empty table gives an empty result; columns other
than doc_id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapse.llm import words as W
from lapse.llm.common import stage, texts, unused
from lapse.llm.linking import components, link

SHINGLE = 5
HALVES = 8
ROWS = 2
SHARE = (85, 100)


def _sketches(shingle: int, halves: int, rows: int):
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            data, off = W.raw(batch.column(1))
            for a, b in W.blocks(off):
                w = W.Words(data[off[a]:off[b]], off[a:b + 1] - off[a])
                h, at = w.shingles(shingle)
                low = W.minima(h, at, 2 * halves * rows, 11)
                half = np.zeros((len(low), 2 * halves), np.uint64)
                with np.errstate(over="ignore"):
                    for j in range(rows):
                        half = W.mix(half * np.uint64(0x9E3779B97F4A7C15) + low[:, j::rows])
                n = np.zeros(b - a, np.int64)
                total = np.zeros((b - a, 2), np.uint64)
                for i in range(b - a):
                    if at[i + 1] > at[i]:
                        u = np.unique(h[at[i]:at[i + 1]])
                        n[i] = len(u)
                        total[i] = W.mix(u).sum(), (u ^ (u << np.uint64(21))).sum()
                sizes = np.where(np.diff(at) > 0, 2 * halves, 0)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(a, b - a), pa.array(n), pa.array(W.signed(total[:, 0])), pa.array(W.signed(total[:, 1])),
                     W.list_column(W.signed(half.ravel()), np.concatenate([[0], np.cumsum(sizes)]))],
                    names=["doc_id", "n", "f1", "f2", "sig"])

    return sketch


def shingle_sets(shingle: int):
    """Per row the sorted distinct shingle hashes of its whole text."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            data, off = W.raw(batch.column(1))
            for a, b in W.blocks(off):
                h, at = W.Words(data[off[a]:off[b]], off[a:b + 1] - off[a]).shingles(shingle)
                each = [np.unique(h[at[i]:at[i + 1]]) for i in range(b - a)]
                ends = np.concatenate([[0], np.cumsum([len(x) for x in each])])
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(a, b - a), W.list_column(W.signed(np.concatenate(each)), ends)], names=["node", "items"])

    return sets


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, share: tuple[int, int] = SHARE, halves: int = HALVES,
                    rows: int = ROWS) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs``.

    Documents whose shingle sets have ``share[1] * intersection >= share[0] *
    union`` are linked; ``component_id`` is the smallest doc_id reachable and
    ``kept`` says whether that is the document itself.
    """
    own = texts(docs)
    d = stage(own.mapInArrow(_sketches(shingle, halves, rows),
                             "doc_id long, n long, f1 long, f2 long, sig array<long>"), "sketches")
    known = d.where("n > 0 and doc_id is not null")
    same = known.groupBy("f1", "f2").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("c"))
    same = stage(same, "same")
    reps = d.join(same.select(F.col("f1").alias("g1"), F.col("f2").alias("g2"), "rep"),
                  (F.col("f1") == F.col("g1")) & (F.col("f2") == F.col("g2")) & (F.col("doc_id") == F.col("rep")))
    reps = reps.dropDuplicates(["f1", "f2"]).select(F.col("doc_id").alias("node"), "n", "sig")
    reps = stage(reps, "reps")
    # the texts of a repeated doc_id belong together
    text = F.struct("f1", "f2")
    several = known.groupBy("doc_id").agg(F.min(text).alias("t1"), F.max(text).alias("t2")).where("t1 <> t2")
    several = known.join(several.select("doc_id").hint("merge"), "doc_id", "left_semi").select("doc_id", "f1", "f2").distinct()
    several = several.join(same.hint("merge"), ["f1", "f2"]).select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))

    def keys(nodes: DataFrame) -> DataFrame:
        t = nodes.select("node", "sig", F.explode(F.sequence(F.lit(0), F.lit(halves * halves - 1))).alias("t"))
        left = F.element_at("sig", (F.col("t") / halves).cast("int") + 1)
        right = F.element_at("sig", F.col("t") % halves + halves + 1)
        return t.select("node", F.xxhash64("t", left, right).alias("key"))

    def sets_of(nodes: DataFrame) -> DataFrame:
        wanted = own.join(nodes.withColumnRenamed("node", "doc_id").hint("merge"), "doc_id", "left_semi")
        return wanted.mapInArrow(shingle_sets(shingle), "node long, items array<long>")

    links = link(reps, keys, sets_of, share).unionByName(several)
    roots = components(links).select(F.col("node").alias("rep"), "root")
    named = same.join(roots, "rep", "left").select("f1", "f2", F.coalesce("root", "rep").alias("root"))
    base = d.select("doc_id", "n", "f1", "f2")
    out = base.join(named, ["f1", "f2"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.when(F.col("n") > 0, F.col("root")).otherwise(F.col("doc_id")))
    out = out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def one_of_each(docs: DataFrame, share: tuple[int, int] = SHARE) -> DataFrame:
    """The rows of ``docs``, all columns, without near-duplicates: of every
    group the document with the smallest doc_id, of repeated rows one.  Rows
    that share a doc_id but differ in text count as documents of their own."""
    own = texts(docs)
    rows = own.agg(F.count("doc_id").alias("n"), F.count_distinct("doc_id").alias("k")).first()
    gone, number = unused(docs, "gone"), "number"
    if rows["n"] == rows["k"]:
        found = near_duplicates(docs, share=share).where(~F.col("kept")).select(F.col("doc_id").alias(gone)).distinct()
        return docs.join(found.hint("merge"), F.col("doc_id") == F.col(gone), "left_anti")
    # distinct rows get numbers that ascend with doc_id
    key, text_key = unused(docs, "key"), F.xxhash64(F.col("text").cast("string"))
    order = ["doc_id", F.xxhash64("text")]
    each = own.where("doc_id is not null").distinct().repartitionByRange(*order).sortWithinPartitions(*order)
    each = stage(each.withColumn(number, F.monotonically_increasing_id()), "numbered")
    found = near_duplicates(each.select(F.col(number).alias("doc_id"), "text"), share=share).where(~F.col("kept"))
    found = each.join(found.select(F.col("doc_id").alias(number)).hint("merge"), number, "left_semi")
    found = found.select(F.col("doc_id").alias(gone), F.xxhash64("text").alias(key)).distinct()
    left = docs.where("doc_id is not null").dropDuplicates(["doc_id", "text"])
    left = left.join(found.hint("merge"), (F.col("doc_id") == F.col(gone)) & (text_key == F.col(key)), "left_anti")
    return left.unionByName(docs.where("doc_id is null"))
