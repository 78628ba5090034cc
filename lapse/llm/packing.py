"""Operator 10: packing by power-of-two decomposition.

A document of n tokens (its ids and a closing 0) is cut into pieces of the
binary digits of n: as many full pieces of ``length`` as fit, then one piece
for every power of two in the rest.  Pieces of equal length are one bucket,
and every piece is a sequence of its own: no sequence crosses documents and
none is padded, for a sequence's length is always a power of two.

Results for odd input: a null or empty text is one piece of one token (the
closing 0); repeated rows are packed as documents of their own; an empty
table gives an empty result; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapse.llm import words as W
from lapse.llm.byte_level import encoder
from lapse.llm.common import number_rows, stage, texts

LENGTH = 1024
VOCABULARY = "byte_bpe_50k.json"


def pieces(n: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, start, length) of the pieces of documents of ``n`` tokens, in
    the documents' order, the longest of a document first."""
    full = n // length
    doc = [np.repeat(np.arange(len(n)), full)]
    start = [(np.arange(len(doc[0])) - np.repeat(np.cumsum(full) - full, full)) * length]
    size = [np.full(len(doc[0]), length)]
    for bit in range(length.bit_length() - 1):
        own = np.flatnonzero(n >> bit & 1)
        doc.append(own)
        start.append(n[own] >> (bit + 1) << (bit + 1))
        size.append(np.full(len(own), 1 << bit))
    doc, start, size = (np.concatenate(x) for x in (doc, start, size))
    order = np.lexsort((start, doc))
    return doc[order], start[order], size[order]


def closed(data: np.ndarray, offsets: np.ndarray, path: str, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of a batch of texts, each document closed by the id ``end``, and
    where each document's begin."""
    ids, bound = encoder(path).tokens(data, offsets)
    return np.insert(ids, bound[1:], end).astype("<u4"), bound + np.arange(len(bound))


def checksums(ids: np.ndarray, start: np.ndarray, size: np.ndarray) -> list[int]:
    """CRC-32 of runs of ids, as little-endian unsigned 32-bit numbers."""
    code = memoryview(ids.tobytes())
    return [zlib.crc32(code[a:b]) for a, b in zip((4 * start).tolist(), (4 * (start + size)).tolist())]


def _pieces_of(path: str, length: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * with_ids
        for batch in batches:
            data, off = W.raw(batch.column(1))
            for a, b in W.blocks(off):
                ids, first = closed(data[off[a]:off[b]], off[a:b + 1] - off[a], path, 0)
                count = np.diff(first)
                doc, start, size = pieces(count, length)
                at = first[doc] + start
                out = [batch.column(0).slice(a, b - a).take(pa.array(doc)), pa.array(start), pa.array(size),
                       pa.array(checksums(ids, at, size), pa.int64()), pa.array(count[doc])]
                if with_ids:  # the pieces tile the ids
                    out.append(W.list_column(ids.astype(np.int32), np.append(at, len(ids))))
                yield pa.RecordBatch.from_arrays(out, names=names)

    return run


def pack(docs: DataFrame, tokenizer_path: str, length: int = LENGTH, with_ids: bool = False) -> DataFrame:
    """One row a piece: ``doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset`` and, if asked for, the piece's ``ids``.  Sequence
    numbers are gapless, those of a bucket of equal length adjacent."""
    if length & (length - 1):
        raise ValueError("the sequence length must be a power of two")
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + ", ids array<int>" * with_ids
    cut = stage(texts(docs).mapInArrow(_pieces_of(tokenizer_path, length, with_ids), schema), "pieces")
    order = [F.col("doc_id"), F.col("start"), F.col("ids_crc32")]
    own = number_rows(cut, ["length"], order, F.xxhash64("doc_id", "start"), "_at")
    count = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    first, total = F.lit(0).cast("long"), 0  # one entry for every power of two up to the length
    for size in sorted(count, reverse=True):
        first = F.when(F.col("length") == size, F.lit(total).cast("long")).otherwise(first)
        total += count[size]
    own = own.withColumn("sequence_id", first + F.col("_at"))
    return own.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id",
                      F.lit(0).cast("long").alias("offset"), *["ids"] * with_ids)
