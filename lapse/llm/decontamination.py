"""Operator 7: benchmark decontamination by CGK embedding, bit sampling and exact edit distance.

Texts are compared as words (letters, digits and all non-ASCII characters,
``A-Z`` lower-cased) parted by single spaces.  An item counts as contained in
a document if some part of the document is within an edit distance of
``1 - similarity`` of the item's length.

1. Embedding.  A CGK walk reads a byte a step and then stays or moves on by
   one, as a random function of the step and the byte says.  Two walks that
   edits have set apart tend to meet again, so that few edits become few
   differing steps.  The walks of an item start at every one of its bytes and
   stay inside it, those of a text at every ``stride``-th byte, so every leak
   holds about (its length / stride) windows that line up with one of the item.
2. Bit sampling.  The bytes read at ``picked`` random steps are the key of a
   window.  Several independent walks, each with steps of its own, repeat this.
3. Votes.  Windows with equal keys vote for an item's start; starts no further
   apart than the limit that reach the number of votes asked for are candidates.
   Walks and votes are set by measuring, through steps 1 to 3, edited copies of
   the items at the limit, at random and at even places (``plan``): as few walks
   and as many votes as reach ``recall``.
4. Verification.  Candidates are confirmed by the exact edit distance of
   the whole item to the best-matching part of the range.

Items are sent to the tasks in blocks of at most ``BLOCK_CHARS`` characters; a
larger benchmark takes several scans of the documents.

Results for odd input: null, empty or wordless items match nothing; items
shorter than ``MIN_CHARS`` normalised characters are not searched for (such
strings say nothing about leakage); null texts match nothing; rows without a
doc_id are searched and reported with a null doc_id; repeated rows are
reported each; empty tables give an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapse.llm import words as W
from lapse.llm.common import texts

SIMILARITY = 0.8
RECALL = 0.98
MIN_CHARS = 20
BLOCK_CHARS = 1_000_000


class Windows(NamedTuple):
    """Walks of ``steps`` steps from every ``stride``-th byte of a text, with
    ``picked`` of the bytes read; for items of ``shortest`` bytes or more."""
    shortest: int
    steps: int
    picked: int
    stride: int


#: Windows of long and of short items.
WINDOWS = (Windows(64, 32, 8, 4), Windows(0, 14, 5, 1))
#: Samplings of one walk, and of all walks at most.
SAMPLINGS = 4
MOST_TABLES = 48
#: Edited copies of each item, to set walks and votes.
COPIES = 6
#: Votes that a leak at the limit shall reach, so that as many can be asked for.
ENOUGH = 4
#: Windows of a text embedded together, and bytes behind the last one.
CHUNK = 1 << 14
ROOM = 64
#: Candidates compared together, and the longest items (in words of 64 bits) that are.
TOGETHER = 4096
MOST_BLOCKS = 32
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_BETWEEN = np.ones(256, bool)
_BETWEEN[48:58] = _BETWEEN[65:91] = _BETWEEN[97:123] = _BETWEEN[128:] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_DOWN = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def _words(texts: list[bytes]) -> W.Words:
    off = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    return W.Words(np.frombuffer(b"".join(texts), np.uint8), off, _BETWEEN)


def plain(w: W.Words, a: int, b: int) -> bytes:
    """Words ``a`` to ``b`` of a batch, normalised."""
    data = w.data
    return b" ".join([data[s:e].tobytes() for s, e in zip(w.start[a:b], w.end[a:b])]).translate(_DOWN)


def edit_distance(pattern: bytes, text: bytes) -> tuple[int, int]:
    """(distance, end): least edit distance of ``pattern`` to a part of
    ``text``, and where the first such part ends.  One machine-independent big
    integer holds a whole column of the dynamic programme."""
    m = len(pattern)
    if not m:
        return 0, 0
    mask: dict[int, int] = {}
    for i, c in enumerate(pattern):
        mask[c] = mask.get(c, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score, best, end = full, 0, m, m, 0
    for j, c in enumerate(text):
        eq = mask.get(c, 0)
        x = (((eq & up) + up) ^ up) | eq | down
        plus, minus = down | (full & ~(x | up)), up & x
        if plus & top:
            score += 1
        elif minus & top:
            score -= 1
        plus, minus = (plus << 1) & full, (minus << 1) & full
        v = eq | down
        up, down = minus | (full & ~(v | plus)), plus & v
        if score < best:
            best, end = score, j + 1
    return best, end


def distances(patterns: list[bytes], which: np.ndarray, text: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Least edit distance of ``patterns[which]`` to a part of ``text[start:stop]``,
    for many at once: the bit-parallel programme of ``edit_distance`` in
    columns of 64-bit words, whose carries go from word to word."""
    length = stop - start
    order = np.argsort(length, kind="stable")  # those that end go first
    which, start, length = which[order], start[order], length[order]
    size = np.array([len(p) for p in patterns])
    blocks = int(-(-size.max() // 64))
    mask = np.zeros((len(patterns), blocks, 256), np.uint64)
    for n, p in enumerate(patterns):
        i = np.arange(len(p))
        np.bitwise_or.at(mask, (n, i // 64, np.frombuffer(p, np.uint8)), np.uint64(1) << (i % 64).astype(np.uint64))
    flat = mask.ravel()
    one = np.uint64(1)
    m = size[which]
    top = np.where(np.arange(blocks)[:, None] == (m - 1) // 64, (m - 1) % 64, 63).astype(np.uint64)
    last = np.arange(blocks)[:, None] == (m - 1) // 64
    up, down = np.full((blocks, len(which)), ~np.uint64(0)), np.zeros((blocks, len(which)), np.uint64)
    score, best = m.copy(), m.copy()
    left = np.searchsorted(length, np.arange(length.max(initial=0)), "right")
    for j, f in enumerate(left):
        column = which[f:] * (blocks * 256) + text[start[f:] + j]
        more = less = np.zeros(len(column), np.uint64)
        for k in range(blocks):
            u, d, t = up[k, f:], down[k, f:], top[k, f:]
            eq = flat.take(column + k * 256)
            v = eq | d
            eq |= less
            x = (((eq & u) + u) ^ u) | eq
            plus, minus = d | ~(x | u), u & x
            out_more, out_less = (plus >> t) & one, (minus >> t) & one
            score[f:] += last[k, f:] * (out_more.astype(np.int64) - out_less.astype(np.int64))
            plus, minus = plus << one | more, minus << one | less
            up[k, f:], down[k, f:] = minus | ~(v | plus), plus & v
            more, less = out_more, out_less
        best[f:] = np.minimum(best[f:], score[f:])
    out = np.empty_like(best)
    out[order] = best
    return out


def _flat(w: W.Words) -> tuple[np.ndarray, np.ndarray]:
    """All words of a batch, normalised, a space after each, and where each begins."""
    size = w.end - w.start
    begin = np.concatenate([[0], np.cumsum(size + 1)])
    out = np.full(begin[-1], 32, np.uint8)
    inside = w.data[~_BETWEEN[w.data]]
    out[np.arange(len(inside)) + np.repeat(np.arange(len(size)), size)] = _LOWER[inside]
    return out, begin


@lru_cache(None)
def _walk(windows: Windows, number: int) -> tuple[np.ndarray, np.ndarray]:
    """Moves by step and byte of one random walk, and which steps each of its
    samplings takes (one of every ``steps / picked`` in a row)."""
    rng = np.random.default_rng([windows.steps, number])
    edge = np.arange(windows.picked + 1) * windows.steps // windows.picked
    sampled = np.zeros((windows.steps, SAMPLINGS), bool)
    for n in range(SAMPLINGS):
        sampled[rng.integers(edge[:-1], edge[1:]), n] = True
    return rng.integers(0, 2, (windows.steps, 256)), sampled


def _embed(text: np.ndarray, at: np.ndarray, windows: Windows, number: int) -> tuple[list[np.ndarray], np.ndarray]:
    """(sampled bytes by sampling, ends) of the walks that start at the places
    ``at`` of a text, whose bytes are 64-bit integers."""
    moves, sampled = _walk(windows, number)
    keys, at = [np.zeros(len(at), np.int64) for _ in range(SAMPLINGS)], at.copy()
    for move, taken in zip(moves, sampled):
        byte = text.take(at)
        for key, wanted in zip(keys, taken):
            if wanted:
                key <<= 8
                key |= byte
        at += move.take(byte)
    return [key.view(np.uint64) for key in keys], at


def _padded(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Texts in a row with room for a walk behind, and where each begins."""
    begin = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])]).astype(np.int64)
    return np.frombuffer(b" ".join([*texts, b" " * ROOM]), np.uint8), begin


class Table:
    """The keys of some items under one sampling of one walk."""

    def __init__(self, texts: list[bytes], windows: Windows, number: int, names: np.ndarray):
        flat, begin = _padded(texts)
        size = np.diff(begin) - 1
        item = np.repeat(np.arange(len(texts)), size)
        place = np.arange(len(item)) - np.repeat(np.cumsum(size) - size, size)
        keys, end = _embed(flat.astype(np.int64), begin[item] + place, windows, number // SAMPLINGS)
        key = keys[number % SAMPLINGS]
        inside = np.flatnonzero(end < begin[item] + size[item])
        order = inside[np.lexsort((place[inside], item[inside], key[inside]))]
        key, item, place = key[order], item[order], place[order]
        # a key that an item holds several times is one entry, from its first to its last place
        new = np.flatnonzero(np.append(True, (np.diff(key) != 0) | (np.diff(item) != 0))) if len(key) else np.zeros(0, int)
        last = np.append(new[1:], len(key))[:len(new)] - 1
        self.item, self.first, self.last = names[item[new]], place[new], place[last]
        self.key, self.at, self.count = np.unique(key[new], return_index=True, return_counts=True)
        self.windows, self.number = windows, number
        bits = max(16, int(8 * len(self.key)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.known = np.zeros(1 << bits, bool)
        self.known[(self.key * _MULTIPLIER) >> self.shift] = True

    def hits(self, key: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(place, item, least, greatest start of the item) of all keys, those
        of the windows at the places ``at``, that are known."""
        some = np.flatnonzero(self.known[(key * _MULTIPLIER) >> self.shift])
        if len(some):
            found = np.minimum(np.searchsorted(self.key, key[some]), len(self.key) - 1)
            equal = self.key[found] == key[some]
            some, found = some[equal], found[equal]
        else:
            found = some
        n = self.count[found]
        ends = np.cumsum(n)
        entry = np.repeat(self.at[found] - ends + n, n) + np.arange(n.sum())
        place = at[np.repeat(some, n)]
        return place, self.item[entry], place - self.last[entry], place - self.first[entry]


def _hits(tables: list[Table], text: np.ndarray, until: int) -> list[np.ndarray]:
    """The hits of all tables in a text (with room for a walk behind ``until``)."""
    out = []
    stride = tables[0].windows.stride
    for a in range(0, until, CHUNK * stride):
        b = min(until, a + CHUNK * stride)
        part, at = text[a:b + ROOM].astype(np.int64), np.arange(0, b - a, stride)
        for t in tables:
            if t is tables[0] or t.number % SAMPLINGS == 0:
                keys, _ = _embed(part, at, t.windows, t.number // SAMPLINGS)
            place, item, low, high = t.hits(keys[t.number % SAMPLINGS], at)
            out.append((place + a, item, low + a, high + a))
    return [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64)] * 4


def _votes(row: np.ndarray, item: np.ndarray, low: np.ndarray, limit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, votes): hits by item, row and start, and how many begin at each
    one's start or up to the item's limit after it."""
    order = np.lexsort((low, row, item))
    row, item, low = row[order], item[order], low[order]
    if not len(order):
        return order, order
    new = np.append(True, (np.diff(row) != 0) | (np.diff(item) != 0))
    low = low - low.min()
    code = (np.cumsum(new) - 1) * (low.max() + limit.max() + 1) + low
    return order, np.searchsorted(code, code + limit[item], "right") - np.arange(len(code))


def _edited(text: bytes, limit: int, even: bool, rng: np.random.Generator) -> bytes:
    """A copy with ``limit`` bytes dropped, replaced by one that no text holds,
    or followed by it."""
    out = [bytes([c]) for c in text]
    places = np.arange(limit) * len(out) // max(limit, 1) if even else rng.choice(len(out), limit, False)
    for p, kind in zip(places, rng.integers(0, 3, limit)):
        out[p] = (b"", b"\x01", out[p] + b"\x01")[kind]
    return b"".join(out)


def _length_class(size: int) -> int:
    """Half octaves of the length."""
    return (size * size).bit_length()


def _limit(size: int, similarity: float) -> int:
    share = Fraction(similarity).limit_denominator(10_000)  # 0.8 is four fifths, not a float
    return int((1 - share) * size)


def plan(texts: list[bytes], similarity: float, recall: float) -> dict[int, tuple[int, int, Windows]]:
    """(tables, votes asked for, windows) by class of lengths.  Copies of all
    items of a class, edited at the limit, are searched; the fewest samplings are
    taken whose share of copies found is ``recall`` or more, and the most votes
    that keep it."""
    out, rng = {}, np.random.default_rng(11)
    by_class: dict[int, list[bytes]] = {}
    for t in texts:
        by_class.setdefault(_length_class(len(t)), []).append(t)
    for name, some in by_class.items():
        windows = _windows(min(len(t) for t in some))
        copies = [(i, _edited(t, _limit(len(t), similarity), c % 2 == 1, rng))
                  for i, t in enumerate(some) for c in range(COPIES)]
        flat, begin = _padded([c for _, c in copies])
        limit = np.array([_limit(len(t), similarity) for t in some])
        own = np.array([i for i, _ in copies])
        hits: list = []
        for tables in range(1, MOST_TABLES + 1):
            hits.append(_hits([Table(some, windows, tables - 1, np.arange(len(some)))], flat, int(begin[-1])))
            place, item, low, _ = (np.concatenate(c) for c in zip(*hits))
            row = np.searchsorted(begin, place, "right") - 1
            true = item == own[row]
            order, votes = _votes(row[true], item[true], low[true], limit)
            most = np.zeros(len(copies), np.int64)
            np.maximum.at(most, row[true][order], votes)
            # random and even edits each reach the recall
            asked = min(int(np.sort(kind)[int((1 - recall) * len(kind))]) for kind in (most[::2], most[1::2]))
            if asked >= ENOUGH:
                break
        out[name] = tables, max(asked, 1), windows
    return out


def _windows(size: int) -> Windows:
    return next(w for w in WINDOWS if size >= w.shortest)


def _normal(raw: list[str]) -> list[bytes]:
    w = _words([t.encode() for t in raw])
    return [plain(w, int(w.row[i]), int(w.row[i + 1])) for i in range(len(raw))]


class Items:
    """A block of benchmark items with the tables of their walks."""

    def __init__(self, ids: list[int], text: list[bytes], similarity: float, plans: dict[int, tuple[int, int, Windows]]):
        self.ids, self.text = ids, text
        self.size = np.array([len(t) for t in text], np.int64)
        self.limit = np.array([_limit(len(t), similarity) for t in text], np.int64)
        self.asked = np.array([plans[_length_class(len(t))][1] for t in text], np.int64)
        # windows of the item's class, so that they are those that were measured
        count = np.array([plans[_length_class(len(t))][0] for t in text], np.int64)
        windows = [plans[_length_class(len(t))][2] for t in text]
        self.groups = []
        for some in sorted(set(windows)):
            own = np.array([i for i, x in enumerate(windows) if x == some])
            tables = []
            for n in range(count[own].max()):
                more = own[count[own] > n]
                tables.append(Table([text[i] for i in more], some, n, more))
            self.groups.append(tables)

    def find(self, data: np.ndarray, off: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """(row, item id, distance, first byte, last byte) of contained items,
        the best place of each row and item."""
        w = W.Words(data, off, _BETWEEN)
        if not self.groups or not len(w.hash):
            return []
        flat, begin = _flat(w)
        room = np.concatenate([flat, np.full(ROOM, 32, np.uint8)])
        rows = begin[w.row]
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        for tables in self.groups:
            place, item, low, high = _hits(tables, room, len(flat))
            row = np.searchsorted(rows, place, "right") - 1
            order, votes = _votes(row, item, low, self.limit)
            full = np.flatnonzero(votes >= self.asked[item[order]])
            if not len(full):
                continue
            # ranges of hits that overlap are one candidate
            stop = np.maximum.accumulate(full + votes[full])
            new = np.flatnonzero(np.append(True, full[1:] >= stop[:-1]))
            last = np.append(new[1:], len(full)) - 1
            a, b = full[new], stop[last]
            i, r = item[order[a]], row[order[a]]
            edge = np.column_stack([a, b]).ravel()
            low = np.minimum.reduceat(np.append(low[order], 0), edge)[::2] - self.limit[i]
            high = np.maximum.reduceat(np.append(high[order], 0), edge)[::2] + self.size[i] + self.limit[i]
            first = np.maximum(np.searchsorted(begin, low, "right") - 1, w.row[r])
            until = np.minimum(np.searchsorted(begin, high), w.row[r + 1])
            for c in self._near(i, flat, begin[first], begin[until] - 1):
                self._confirm(w, flat, begin, int(first[c]), int(until[c]), int(i[c]), int(r[c]), best)
        return [(r, self.ids[i], *found) for (r, i), found in best.items()]

    def _near(self, item: np.ndarray, flat: np.ndarray, start: np.ndarray, stop: np.ndarray) -> Iterator[int]:
        """The candidates within the limit; long ones are all left to ``_confirm``."""
        size = self.size[item]
        together = (size <= 64 * MOST_BLOCKS) & (stop - start <= 8 * size)
        yield from np.flatnonzero(~together)
        some = np.flatnonzero(together)
        some = some[np.argsort(-(-size[some] // 64), kind="stable")]
        for a in range(0, len(some), TOGETHER):
            c = some[a:a + TOGETHER]
            names, which = np.unique(item[c], return_inverse=True)
            d = distances([self.text[i] for i in names], which, flat, start[c], stop[c])
            yield from c[d <= self.limit[item[c]]]

    def _confirm(self, w: W.Words, flat: np.ndarray, begin: np.ndarray, a: int, b: int, item: int, row: int,
                 best: dict) -> None:
        """Compares an item with the words ``a`` to ``b`` of a row."""
        text, limit = self.text[item], int(self.limit[item])
        known = best.get((row, item))
        area = flat[begin[a]:begin[b] - 1].tobytes()
        if known and known[0] == 0 or len(area) < len(text) - limit:
            return
        distance, end = edit_distance(text, area)
        if distance > limit or known and known[0] <= distance:
            return
        back, length = edit_distance(text[::-1], area[:end][::-1])
        own = begin[a:b + 1] - begin[a]
        one = a + int(np.searchsorted(own, end - length, "right")) - 1
        two = a + int(np.searchsorted(own, max(end - 1, 0), "right")) - 1
        base = int(w.offsets[row])
        best[(row, item)] = (distance, int(w.start[one]) - base, int(w.end[min(two, b - 1)]) - base)


def _finder(block: tuple):
    made: list[Items] = []

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not made:
            made.append(Items(*block))
        items = made[0]
        for batch in batches:
            docs = batch.column(0)
            data, off = W.raw(batch.column(1))
            for a, b in W.blocks(off, 4_000_000):
                some = data[off[a]:off[b]]
                own = off[a:b + 1] - off[a]
                rows = []
                for row, item, distance, first, last in items.find(some, own):
                    text = some[own[row]:own[row + 1]].tobytes()
                    start = len(text[:first].decode())
                    rows.append((docs[a + row].as_py(), item, distance, start, start + len(text[first:last].decode())))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)],
                                                     names=["doc_id", "item_id", "distance", "start", "stop"])

    return find


def _item_blocks(benchmark: DataFrame, similarity: float, recall: float, block_chars: int) -> Iterator[tuple]:
    """Arguments of ``Items``, by blocks of about ``block_chars`` characters."""
    bench = benchmark.select(F.col("item_id").cast("long").alias("item_id"),
                             F.col("text").cast("string").alias("text")).where("text is not null and item_id is not null")
    chars = bench.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = max(1, -(-chars // block_chars))
    for part in range(parts):
        rows = bench.where(F.pmod(F.xxhash64("item_id"), F.lit(parts)) == part).orderBy("item_id").collect()
        text = _normal([r.text for r in rows])
        long = [i for i, t in enumerate(text) if len(t) >= MIN_CHARS]
        yield ([rows[i].item_id for i in long], [text[i] for i in long], similarity,
               plan([text[i] for i in long], similarity, recall))


def contaminated(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY,
                 recall: float = RECALL, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``doc_id, item_id, distance, start, stop``: every document row and
    benchmark item it contains, with the edit distance of the best place and
    that place's span in characters of the text."""
    d = texts(docs)
    out = None
    for block in _item_blocks(benchmark, similarity, recall, block_chars):
        found = d.mapInArrow(_finder(block),
                             "doc_id long, item_id long, distance long, start long, stop long")
        out = found if out is None else out.unionByName(found)
    return out


def clean(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL,
          block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of ``docs``, all columns, that contain no benchmark item."""
    texts(docs)
    text = docs.columns.index("text")
    for block in _item_blocks(benchmark, similarity, recall, block_chars):
        docs = docs.mapInArrow(_cleaner(block, text), docs.schema)
    return docs


def _cleaner(block: tuple, text: int):
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = Items(*block)
        for batch in batches:
            data, off = W.raw(batch.column(text))
            ok = np.ones(batch.num_rows, bool)
            for a, b in W.blocks(off, 4_000_000):
                for found in items.find(data[off[a]:off[b]], off[a:b + 1] - off[a]):
                    ok[a + found[0]] = False
            yield batch.filter(pa.array(ok))

    return keep
