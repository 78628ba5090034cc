"""Operator 2: removal of repeated passages by paragraph MinHash banding.

A text is cut into paragraphs at line ends and at sentence ends (a word that
ends in ``.``, ``!`` or ``?``), so that a passage is found wherever in a line it
was put.  Paragraphs of at least ``MIN_WORDS`` words are compared: MinHash
values of their five-word shingles are joined in ``BANDS`` bands of ``ROWS``
values, a candidate pair is verified by the exact Jaccard similarity of the
shingle sets, and verified pairs are clustered by connected components.  Bands
are tuned for recall: a pair at the threshold 0.8 shares one with probability
0.983, a pair of similarity 0.9 with 0.999, equal sets always.

A shorter paragraph is compared by two windows of ``MIN_WORDS`` words, the one
that starts with it and the one that ends with it: it repeats if one of them
stands, word for word, at an earlier short paragraph, that is, if it repeats
next to the same neighbours.

The first paragraph of a cluster (smallest doc_id, then place) stays; the others
are repeated.  A text loses its runs of adjacent repeated paragraphs, if a run
has at least ``RUN_WORDS`` words; a paragraph that does not repeat, however
short, ends a run and stays, and so do single short sentences that recur.

Results for odd input: null, empty and short texts lose nothing; rows that
share doc_id and text count as one document, rows that share a doc_id alone are
compared and cut each for itself (``text_key`` tells them apart); rows without a
doc_id are left out of the comparison; an empty table gives an empty result;
columns other than doc_id and text are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lapse.llm import words as W
from lapse.llm.common import stage, texts, unused
from lapse.llm.linking import components, link

SHINGLE = 5
SHARE = (4, 5)
BANDS = 4
ROWS = 2
MIN_WORDS = 8
RUN_WORDS = 20


def paragraphs(w: W.Words) -> np.ndarray:
    """Word bounds of the paragraphs of a batch, those of a row adjacent."""
    n = len(w.start)
    if not n:
        return np.zeros(1, np.int64)
    stop = np.isin(w.data[w.end - 1], np.frombuffer(b".!?", np.uint8))
    lines = np.concatenate([[0], np.cumsum(w.data == 10)])
    stop[:-1] |= lines[w.start[1:]] > lines[w.end[:-1]]
    stop[w.row[1:][w.counts() > 0] - 1] = True
    return np.concatenate([[0], np.flatnonzero(stop) + 1])


class Units:
    """The paragraphs of a batch that are compared by their shingles."""

    def __init__(self, data: np.ndarray, off: np.ndarray, shingle: int, least: int):
        self.words = w = W.Words(data, off)
        self.bounds = bounds = paragraphs(w)
        size = np.diff(bounds)
        h, at = w.shingles(shingle, bounds)
        keep = size >= least
        self.first, self.size = bounds[:-1][keep], size[keep]
        self.row = np.searchsorted(w.row, self.first, "right") - 1
        self.place = np.flatnonzero(keep) - np.searchsorted(bounds[:-1], w.row[self.row])
        count = np.diff(at)[keep]
        flat = np.repeat(at[:-1][keep] - np.concatenate([[0], np.cumsum(count)])[:-1], count) + np.arange(count.sum())
        owner = np.repeat(np.arange(len(count)), count)
        order = np.lexsort((h[flat], owner))
        h, owner = h[flat][order], owner[order]
        fresh = np.ones(len(h), bool)
        fresh[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
        self.items = h[fresh]
        self.ends = np.concatenate([[0], np.cumsum(np.bincount(owner[fresh], minlength=len(count)))]).astype(np.int64)
        with np.errstate(over="ignore"):
            self.node = np.add.reduceat(W.mix(self.items ^ np.uint64(0x51ED27)), self.ends[:-1]) if len(count) else self.items
        self.chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])

    def spans(self, row: np.ndarray, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Character spans, in their text, of runs of words."""
        w, base = self.words, self.chars[self.words.offsets[row]]
        return self.chars[w.start[first]] - base, self.chars[w.end[first + size - 1]] - base

    def windows(self, least: int) -> tuple[np.ndarray, ...]:
        """(row, place, first word, words, hash, 32 more bits of hash) of the
        shorter paragraphs, once for each of their two windows of ``least`` words."""
        w, size = self.words, np.diff(self.bounds)
        short = np.flatnonzero(size < least)
        first, size = self.bounds[:-1][short], size[short]
        row = np.searchsorted(w.row, first, "right") - 1
        place = short - np.searchsorted(self.bounds[:-1], w.row[row])
        out = []
        for side, at in enumerate((first, first + size - least)):
            fits = np.flatnonzero((at >= w.row[row]) & (at + least <= w.row[row + 1]))
            h = np.full((2, len(fits)), side + 1, np.uint64)
            with np.errstate(over="ignore"):
                for j in range(least):
                    x = w.hash[at[fits] + j]
                    h[0] = W.mix(h[0] * np.uint64(0x9E3779B97F4A7C15) + x)
                    h[1] = W.mix(h[1] * np.uint64(0xD1B54A32D192ED03) + (x ^ np.uint64(0x2545F4914F6CDD1D)))
            also = (h[1] >> np.uint64(32)).astype(np.uint32).view(np.int32)
            out.append((row[fits], place[fits], first[fits], size[fits], h[0], also))
        return tuple(np.concatenate(x) for x in zip(*out))


def _units(shingle: int, least: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, versions = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            data, off = W.raw(batch.column(1))
            for a, b in W.blocks(off):
                u = Units(data[off[a]:off[b]], off[a:b + 1] - off[a], shingle, least)
                low = W.minima(u.items, u.ends, bands * rows, 31)
                key = np.zeros((len(low), bands), np.uint64)
                with np.errstate(over="ignore"):
                    for j in range(rows):
                        key = W.mix(key * np.uint64(0x9E3779B97F4A7C15) + low[:, j::rows] + np.uint64(j))
                    key = W.mix(key + np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))
                row, place, first, size, node, also = u.windows(least)
                long, short = len(u.row), len(row)
                row, place = np.concatenate([u.row, row]), np.concatenate([u.place, place])
                first, size = np.concatenate([u.first, first]), np.concatenate([u.size, size])
                start, stop = u.spans(row, first, size)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[a + row]), pa.array(versions[a + row]), pa.array(place.astype(np.int32)),
                     pa.array(W.signed(np.concatenate([u.node, node]))),
                     pa.array(np.concatenate([np.zeros(long, np.int32), also])),
                     pa.array(np.concatenate([np.diff(u.ends), np.zeros(short, np.int64)])),
                     pa.array(size.astype(np.int32)), pa.array(start.astype(np.int32)), pa.array(stop.astype(np.int32)),
                     W.list_column(W.signed(key.ravel()), np.minimum(np.arange(long + short + 1), long) * bands)],
                    names=["doc", "version", "place", "node", "also", "n", "words", "start", "stop", "keys"])

    return run


def _sets(shingle: int, least: int):
    """Shingle sets of the asked paragraphs of a text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = W.raw(batch.column(0))
            for a, b in W.blocks(off):
                u = Units(data[off[a]:off[b]], off[a:b + 1] - off[a], shingle, least)
                wanted = batch.column(1)[a:b]
                keys = np.repeat(np.arange(b - a), pa.compute.list_value_length(wanted).to_numpy())
                ask = set(zip(keys.tolist(), wanted.flatten().to_pylist()))
                hit = [i for i, k in enumerate(zip(u.row.tolist(), u.place.tolist())) if k in ask]
                each = [u.items[u.ends[i]:u.ends[i + 1]] for i in hit]
                ends = np.concatenate([[0], np.cumsum([len(x) for x in each])])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(W.signed(u.node[hit])), W.list_column(W.signed(np.concatenate(each or [u.items[:0]])), ends)],
                    names=["node", "items"])

    return run


def repeated_passages(docs: DataFrame, shingle: int = SHINGLE, share: tuple[int, int] = SHARE, bands: int = BANDS,
                      rows: int = ROWS, min_words: int = MIN_WORDS, run_words: int = RUN_WORDS) -> DataFrame:
    """``doc_id, text_key, start, stop, n_words, n_paragraphs, kept_doc_id``: one
    row for every removed run, its span in characters of the text, the words and
    number of its paragraphs, and the document that keeps the first of them."""
    d = _keyed(texts(docs).where("doc_id is not null"))
    units = stage(d.mapInArrow(_units(shingle, min_words, bands, rows), "doc long, version long, place int, node long, "
                               "also int, n long, words int, start int, stop int, keys array<long>"), "units")
    long = units.where("n > 0")

    def keys(nodes: DataFrame) -> DataFrame:
        return long.select("node", F.explode("keys").alias("key"))

    def sets_of(nodes: DataFrame) -> DataFrame:
        where = long.groupBy("node").agg(F.min(F.struct("doc", "version", "place")).alias("w"))
        where = where.join(nodes.withColumnRenamed("node", "x").hint("merge"), F.col("node") == F.col("x"))
        where = where.groupBy(F.col("w.doc").alias("doc_id"), F.col("w.version").alias("text_key")).agg(
            F.collect_set("w.place").alias("places"))
        asked = d.join(where.hint("merge"), ["doc_id", "text_key"]).select("text", "places")
        return asked.mapInArrow(_sets(shingle, min_words), "node long, items array<long>").dropDuplicates(["node"])

    roots = components(link(long.select("node", "n"), keys, sets_of, share)).select(F.col("node").alias("x"), "root")
    at = ["doc", "version", "place", "words", "start", "stop", "also"]
    own = long.select(*at, "node").join(roots, F.col("node") == F.col("x"), "left").select(
        *at, F.coalesce("root", "node").alias("root"))
    own = own.unionByName(units.where("n = 0").select(*at, F.col("node").alias("root")))
    me = F.struct("doc", "version", "place")
    first = own.groupBy("root", "also").agg(F.min(me).alias("first"), F.count(F.lit(1)).alias("c")).where("c > 1")
    # read from its files the small side gets an exchange of its own, so that a root with many members can be split
    first = stage(first.select(F.col("root").alias("r"), F.col("also").alias("b"), "first"), "firsts")
    gone = own.join(first.hint("merge"), (F.col("root") == F.col("r")) & (F.col("also") == F.col("b")))
    gone = gone.where(me != F.col("first"))
    w = Window.partitionBy("doc", "version").orderBy("place")
    gone = gone.select(*at[:-1], F.col("first.doc").alias("kept"), (F.col("place") - F.dense_rank().over(w)).alias("run"),
                       F.coalesce(F.lag("place").over(w) != F.col("place"), F.lit(True)).alias("fresh"))
    runs = gone.groupBy("doc", "version", "run").agg(
        F.min("start").alias("start"), F.max("stop").alias("stop"), F.sum(F.when(F.col("fresh"), F.col("words"))).alias("n_words"),
        F.count_if("fresh").alias("n_paragraphs"), F.min(F.struct("place", "kept")).alias("k"))
    return runs.where(F.col("n_words") >= run_words).select(
        F.col("doc").alias("doc_id"), F.col("version").alias("text_key"), F.col("start").cast("long").alias("start"),
        F.col("stop").cast("long").alias("stop"), "n_words", "n_paragraphs", F.col("k.kept").alias("kept_doc_id"))


def _keyed(rows: DataFrame) -> DataFrame:
    """``rows(doc_id, text)`` with the number that tells texts of one id apart."""
    return rows.withColumn("text_key", F.xxhash64("text"))


def without(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """``docs``, all columns, with the ``spans(doc_id, text_key, start, stop)``
    cut out of their texts."""
    own, key, cuts = unused(docs, "own"), unused(docs, "key"), unused(docs, "cuts")
    cut = spans.groupBy(F.col("doc_id").alias(own), F.col("text_key").alias(key)).agg(
        F.array_sort(F.collect_set(F.struct("start", "stop"))).alias(cuts))
    text = F.col("text").cast("string")
    out = docs.join(cut.hint("merge"), (F.col("doc_id") == F.col(own)) & (F.xxhash64(text) == F.col(key)), "left")
    # the spans are apart: keep what lies between them, from the last one on
    kept = F.aggregate(F.reverse(cuts), F.struct(F.lit("").alias("tail"), F.length(text).alias("end")),
                       lambda acc, s: F.struct(
                           F.concat(F.substring(text, (s["stop"] + 1).cast("int"), acc["end"] - s["stop"].cast("int")),
                                    acc["tail"]).alias("tail"), s["start"].cast("int").alias("end")),
                       lambda acc: F.concat(F.substring(text, F.lit(1), acc["end"]), acc["tail"]))
    return out.withColumn("text", F.when(F.col(cuts).isNull(), text).otherwise(kept)).drop(own, key, cuts)
