"""Operator 12: best-fit packing with a bounded number of open sequences.

A document (its ids and a closing 2) of up to ``length`` tokens is one piece
and is never cut; a longer one is cut into pieces of ``length``, of which the
first may be shorter.  Pieces arrive one by one.  A task keeps at most
``open_bins`` unfinished sequences, told apart by their free space alone: a
bitset has a bit for every free space that some open sequence has, so the
tightest sequence a piece fits in is the lowest bit from the piece's size on.
If it fits nowhere and all places are taken, the fullest sequence closes.

Every task packs its own documents and then hands over the pieces of the
sequences that are still open; a second pass, in tasks of about ``SECOND``
pieces, packs those by the same rule.  What a task holds is bounded by
``open_bins`` sequences in both passes.

Results for odd input: a null or empty text is one piece of one token (the
closing 2); rows without a doc_id and repeated rows are packed as documents of
their own; an empty table gives an empty result; columns other than doc_id and
text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapse.llm import words as W
from lapse.llm.common import stage, texts
from lapse.llm.packing import LENGTH, VOCABULARY, checksums, closed

__all__ = ["LENGTH", "VOCABULARY", "Bins", "pack"]

CLOSING = 2
OPEN_BINS = 1024
SECOND = 100_000
_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
_TYPES = [pa.int64(), pa.int32(), *[pa.int64()] * 5]
_NAMES = [c.split()[0] for c in _SCHEMA.split(", ")]
_FLUSH = 20_000


class Bins:
    """Open sequences in a bitset keyed by free space.  ``put`` returns the
    sequences it closes, each as the list of its pieces in their order."""

    def __init__(self, length: int, most: int):
        self.length, self.most, self.count = length, most, 0
        self.free = 0  # bit f: some open sequence has f tokens free
        self.held: list[list[list]] = [[] for _ in range(length + 1)]  # open sequences by free space

    def _take(self, space: int) -> list:
        found = self.held[space].pop()
        if not self.held[space]:
            self.free ^= 1 << space
        self.count -= 1
        return found

    def put(self, piece, size: int) -> list[list]:
        out = []
        fits = self.free >> size
        if fits:
            space = size + (fits & -fits).bit_length() - 1  # the tightest
            own = self._take(space)
        else:
            if self.count == self.most:
                out.append(self._take((self.free & -self.free).bit_length() - 1))  # the fullest closes first
            own, space = [], self.length
        own.append(piece)
        left = space - size
        if left:
            self.held[left].append(own)
            self.free |= 1 << left
            self.count += 1
        else:
            out.append(own)
        return out

    def rest(self) -> list[list]:
        return [own for held in self.held for own in held]


def cut(n: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, piece, start, length) of documents of ``n`` tokens."""
    count = -(-n // length)
    doc = np.repeat(np.arange(len(n)), count)
    piece = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
    first = n - (count - 1) * length
    start = np.where(piece, first[doc] + (piece - 1) * length, 0)
    return doc, piece, start, np.where(piece, length, first[doc])


def _sized(batches: Iterator[pa.RecordBatch], path: str, length: int) -> Iterator[list[list]]:
    """Pieces of the batches' documents, as columns of plain values."""
    for batch in batches:
        data, off = W.raw(batch.column(1))
        for a, b in W.blocks(off):
            ids, first = closed(data[off[a]:off[b]], off[a:b + 1] - off[a], path, CLOSING)
            doc, piece, start, size = cut(np.diff(first), length)
            yield [batch.column(0).slice(a, b - a).take(pa.array(doc)).to_pylist(), piece.tolist(), start.tolist(),
                   size.tolist(), checksums(ids, first[doc] + start, size)]


def _packed(blocks: Iterator[list[list]], length: int, open_bins: int, first: int, last: bool) -> Iterator[pa.RecordBatch]:
    """Pieces with the sequences they end up in, numbered from ``first``; those
    of sequences still open at the end have none unless this is the ``last`` pass."""
    bins, done, sequence = Bins(length, open_bins), [], first

    def batch() -> pa.RecordBatch:
        columns = zip(*done) if done else [[] for _ in _NAMES]
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, _TYPES)], names=_NAMES)

    def close(own: list, number: int | None) -> None:
        at = 0
        for p in own:
            done.append((*p, number, None if number is None else at))
            at += p[3]

    for block in blocks:
        for p in zip(*block):
            for own in bins.put(p, p[3]):
                close(own, sequence)
                sequence += 1
        if len(done) > _FLUSH:
            yield batch()
            done.clear()
    for own in bins.rest():
        close(own, sequence if last else None)
        sequence += 1
    yield batch()


def pack(docs: DataFrame, tokenizer_path: str, length: int = LENGTH, open_bins: int = OPEN_BINS) -> DataFrame:
    """One row a piece: ``doc_id, piece, start, length, ids_crc32, sequence_id,
    offset`` (the token of the sequence at which the piece begins)."""

    def once(batches):
        yield from _packed(_sized(batches, tokenizer_path, length), length, open_bins,
                           TaskContext.get().partitionId() << 32, False)

    def again(batches):
        blocks = (list(b.to_pydict().values()) for b in batches)
        yield from _packed(blocks, length, open_bins, (1 << 62) + (TaskContext.get().partitionId() << 32), True)

    packed = stage(texts(docs).mapInArrow(once, _SCHEMA), "packed")
    left = packed.where("sequence_id is null").select(*_NAMES[:5])
    tasks = max(1, left.count() // SECOND)
    return packed.where("sequence_id is not null").unionByName(left.coalesce(tasks).mapInArrow(again, _SCHEMA))
