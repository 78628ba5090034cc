"""Operator 6: removal of repeated byte strings by suffix sorting.

Every byte covered by a ``length``-byte string that also starts earlier (in a
smaller doc_id, or earlier in the same text) is removed; strings are judged on
the input.  Two suffixes share such a string if they agree in their first
``length`` bytes, so the suffixes only need to be sorted to that depth.

Suffixes are dealt to tasks by content.  The *minimizer* of a suffix is the
leftmost of the smallest-hashing ``GRAM``-byte strings in its first ``length``
bytes: equal prefixes have the same minimizer at the same distance, and
neighbouring suffixes mostly share it, so it stands for a run of them.

1. All minimizers' hashes are counted; a run whose minimizer occurs once
   cannot repeat and is dropped.  Texts that equal an earlier text are settled
   as a whole beforehand.
2. The other runs' contexts (the bytes of all their prefixes) are gathered.
   Equal contexts repeat as a whole: all but the earliest are marked.
3. The suffixes of the contexts left are sorted per minimizer and distance
   with a deep-shallow sort: multikey sorting over 8-byte symbols to the
   depth ``SHALLOW``, then blind tries for groups that still agree.  In a group
   of equal prefixes all but the earliest suffix are marked.
4. A minimizer with more than ``HOT`` different contexts is not sorted in one
   task: its prefixes are grouped by a 128-bit digest instead, an aggregation
   whose partial results are combined before the shuffle.

Results for odd input: a null text counts as empty; texts shorter than
``length`` bytes lose nothing; equal rows (id and text) are one document, and
each gets its result; different texts of one doc_id stand in the order of
their digests; rows without a doc_id come after all others; an empty table
gives an empty result; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lapse.llm import words as W
from lapse.llm.common import discard, stage, texts

LENGTH = 100
GRAM = 32
SHALLOW = 32
HOT = 200_000
#: Suffixes sorted at a time in a task.
CHUNK = 300_000
_TIE = 40  # positions hold the number of the text among those of its doc_id above this bit
_LAST = 2**63 - 1  # stands for a missing doc_id
_PLACE = np.uint64((1 << 28) - 1)
_CODES = np.random.default_rng(606).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def minimizers(data: np.ndarray, off: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, place, hash by place): for every position at which a whole
    ``length``-byte string starts the place of its minimizer."""
    n = len(data)
    size = np.diff(off)
    long = size >= length
    if not long.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    power, inverse = W._powers(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_CODES[data] * power[:n], out=total[1:])
    grams = n - GRAM + 1
    h = W.mix((total[GRAM:] - total[:grams]) * inverse[:grams])
    low = (h & ~_PLACE) | np.arange(grams, dtype=np.uint64)
    width, window = 1, length - GRAM + 1
    while 2 * width <= window:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    rest = window - width
    if rest:
        low = np.minimum(low[:-rest], low[rest:])
    count = np.where(long, size - length + 1, 0)
    ends = np.concatenate([[0], np.cumsum(count)])
    start = np.repeat(off[:-1] - ends[:-1], count) + np.arange(ends[-1])
    return start, (low[start] & _PLACE).astype(np.int64), h


def _anchors(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, tie = (batch.column(i).to_numpy() for i in (0, 1))
            data, offs = W.raw(batch.column(2))
            for a, b in W.blocks(offs):
                off = offs[a:b + 1] - offs[a]
                _, place, h = minimizers(data[offs[a]:offs[b]], off, length)
                if len(place):
                    place = place[np.append(True, place[1:] != place[:-1])]
                    row = np.searchsorted(off, place, "right") - 1
                    pos = (tie[a + row].astype(np.int64) << _TIE) | (place - off[row])
                    yield pa.RecordBatch.from_arrays([pa.array(W.signed(h[place])), pa.array(doc[a + row]),
                                                      pa.array(pos)], names=["h", "doc", "pos"])

    return run


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts as compressed bytes: they are shuffled once and read twice."""
    pack = zstandard.ZstdCompressor(level=1).compress
    for batch in batches:
        blobs = [pack((t.as_py() or "").encode()) for t in batch.column(2)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(blobs, pa.binary())],
                                         names=["doc", "tie", "blob"])


def _contexts(length: int):
    """Runs whose minimizer occurs more than once, with their bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        names = ["c1", "c2", "h", "doc", "pos", "off", "text"]
        types = [pa.int64()] * 5 + [pa.int32(), pa.binary()]
        rows = [[] for _ in names]

        def taken() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(r, t) for r, t in zip(rows, types)], names=names)
            for r in rows:
                r.clear()
            return out

        for batch in batches:
            for doc, tie, blob, places in zip(*(c.to_pylist() for c in batch.columns[:3]), batch.column(3)):
                raw = unpack(blob)
                start, place, h = minimizers(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), length)
                first = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
                last = np.append(first[1:], len(place)) - 1
                keep = np.isin(place[first], places.values.to_numpy() & ((1 << _TIE) - 1))
                first, last = first[keep], last[keep]
                base = int(tie) << _TIE
                for lo, hi, at in zip(start[first].tolist(), start[last].tolist(), place[first].tolist()):
                    text = raw[lo:hi + length]
                    key = hashlib.blake2b(text, digest_size=16, salt=(at - lo).to_bytes(4, "little")).digest()
                    for r, v in zip(rows, (int.from_bytes(key[:8], "little", signed=True),
                                           int.from_bytes(key[8:], "little", signed=True),
                                           int(h[at].astype(np.int64)), doc, base + lo, at - lo, text)):
                        r.append(v)
                if len(rows[0]) > 20_000:
                    yield taken()
        yield taken()

    return run


def _symbols(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from every position on as one big-endian number."""
    n = len(data)
    padded = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(8):
        out = (out << np.uint64(8)) | padded[j:j + n]
    return out


def _groups(order_keys: tuple[np.ndarray, ...]) -> tuple[np.ndarray, np.ndarray]:
    """(order, group number by order) of equal key tuples, last key first."""
    order = np.lexsort(order_keys)
    change = np.zeros(len(order), bool)
    for k in order_keys:
        s = k[order]
        change[1:] |= s[1:] != s[:-1]
    return order, np.cumsum(change)


def deep_shallow(data: np.ndarray, at: np.ndarray, bucket: np.ndarray, length: int, shallow: int = SHALLOW
                 ) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes ``at`` of ``data`` that agree with another one of their bucket
    in the first ``length`` bytes: (indexes into ``at`` in suffix order, group
    numbers).  Others are left out as soon as they stand alone.

    Shallow: groups are ordered symbol by symbol (8 bytes each), as multikey
    quicksort does, to the depth ``shallow``.  Deep: a group's blind trie is
    grown from one leaf at a time; members are compared with the leaf by
    whole symbols, and those that leave its path at the same depth with the
    same byte hang below the same branch and form the next round's group.
    """
    symbol = _symbols(data)
    live = np.arange(len(at))
    order, group = _groups((bucket,))
    live = live[order]

    def several(live, group):
        count = np.bincount(group)
        keep = count[group] > 1
        live, group = live[keep], group[keep]
        return live, np.cumsum(np.append(False, group[1:] != group[:-1])) if len(group) else group

    live, group = several(live, group)
    for depth in range(0, min(shallow, length), 8):
        if not len(live):
            return live, group
        mask = np.uint64(2**64 - 1) << np.uint64(8 * max(0, depth + 8 - length))
        order, new = _groups((symbol[at[live] + depth] & mask, group))
        live, group = several(live[order], new)
    # blind tries; rank orders the finished groups by their path
    done_live, done_group, done = [], [], 0
    while len(live):
        head = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
        leaf = at[live[head]][group]
        own = at[live]
        common = np.full(len(live), length)
        open_ = np.arange(len(live))
        for depth in range(min(shallow, length), length, 8):
            mask = np.uint64(2**64 - 1) << np.uint64(8 * max(0, depth + 8 - length))
            x = (symbol[own[open_] + depth] ^ symbol[leaf[open_] + depth]) & mask
            off = x != 0
            bits = np.floor(np.log2(np.maximum(x[off] >> np.uint64(11), 1).astype(float))).astype(int) + 11
            bits = np.where(x[off] >> np.uint64(11) == 0, np.floor(np.log2(x[off].astype(float))).astype(int), bits)
            common[open_[off]] = depth + (63 - bits) // 8
            open_ = open_[~off]
        same = common == length
        keep_live, keep_group = several(live[same], _dense(group[same]))
        done_live.append(keep_live)
        done_group.append(keep_group + done)
        done += int(keep_group.max()) + 1 if len(keep_group) else 0
        live, own, leaf, group, common = (x[~same] for x in (live, own, leaf, group, common))
        if len(live):
            order, new = _groups((data[own + common], common, group))
            live, group = several(live[order], new)
    live, group = np.concatenate(done_live or [live]), np.concatenate(done_group or [group])
    return live, group


def _dense(group: np.ndarray) -> np.ndarray:
    return np.cumsum(np.append(False, group[1:] != group[:-1])) if len(group) else group


def _repeats(length: int):
    """Marks of the contexts of whole minimizers, which arrive sorted by hash."""

    def settle(h, doc, pos, off, texts) -> Iterator[pa.RecordBatch]:
        data = np.frombuffer(b"".join(texts) + bytes(8), np.uint8)
        size = np.array([len(t) for t in texts])
        base = np.concatenate([[0], np.cumsum(size)])[:-1]
        # a context's suffixes lie at distances low..off before its minimizer;
        # distances are independent, so many suffixes are sorted by slices of them
        low = off - (size - length)
        change = np.zeros(int(off.max()) + 2, np.int64)
        np.add.at(change, low, 1)
        np.add.at(change, off + 1, -1)
        total = np.cumsum(np.cumsum(change))
        one, last = int(low.min()), int(off.max())
        while one <= last:
            done = total[one - 1] if one else 0
            two = max(one, min(last, int(np.searchsorted(total, done + CHUNK, "right")) - 1))
            first, stop = np.maximum(low, one), np.minimum(off, two)
            count = np.maximum(stop - first + 1, 0)
            ends = np.concatenate([[0], np.cumsum(count)])
            which = np.repeat(np.arange(len(texts)), count)
            step = (off - stop)[which] + np.arange(ends[-1]) - ends[which]
            found = slice_(h, doc, pos, off, data, base, which, step)
            if found:
                yield found
            one = two + 1

    def slice_(h, doc, pos, off, data, base, which, step) -> pa.RecordBatch | None:
        bucket = W.mix(h[which].view(np.uint64) ^ W.mix((off[which] - step).astype(np.uint64)))
        live, group = deep_shallow(data, base[which] + step, bucket, length)
        own = which[live]
        order = np.lexsort((pos[own], doc[own], group))
        live, group = live[order], group[order]
        marked = np.sort(live[np.append(False, group[1:] == group[:-1])]) if len(live) else live
        if not len(marked):
            return None
        cut = np.append(True, (marked[1:] != marked[:-1] + 1) | (which[marked[1:]] != which[marked[:-1]]))
        one, two = marked[cut], marked[np.append(cut[1:], True)]
        own = which[one]
        return pa.RecordBatch.from_arrays([pa.array(doc[own]), pa.array(pos[own] + step[one]),
                                           pa.array(pos[own] + step[two] + length)], names=["doc", "one", "two"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = [np.zeros(0, np.int64)] * 4 + [[]]
        for batch in batches:
            new = [batch.column(i).to_numpy().astype(np.int64) for i in range(4)] + [batch.column(4).to_pylist()]
            held = [np.concatenate([x, y]) for x, y in zip(held[:4], new[:4])] + [held[4] + new[4]]
            while sum(map(len, held[4])) - length * len(held[4]) > CHUNK:
                windows = np.cumsum([len(t) - length + 1 for t in held[4]])
                change = np.flatnonzero(held[0][1:] != held[0][:-1]) + 1
                ready = change[change <= np.searchsorted(windows, CHUNK) + 1]
                ready = ready[-1:] if len(ready) else change[:1]
                if not len(ready):
                    break
                r = int(ready[0])
                yield from settle(*[x[:r] for x in held])
                held = [x[r:] for x in held]
        if held[4]:
            yield from settle(*held)

    return run


def _prefixes(length: int):
    """Every prefix of a context by its digest, for hot minimizers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, pos, text in zip(*(c.to_pylist() for c in batch.columns)):
                keys = [hashlib.blake2b(text[i:i + length], digest_size=16).digest()
                        for i in range(len(text) - length + 1)]
                both = np.frombuffer(b"".join(keys), "<i8").reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.ascontiguousarray(both[:, 0])), pa.array(np.ascontiguousarray(both[:, 1])),
                     pa.array(np.full(len(keys), doc)), pa.array(pos + np.arange(len(keys)))], names=["w1", "w2", "doc", "one"])

    return run


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What is left of a text without its marked spans."""
    unpack = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        rows = [[] for _ in range(7)]
        for doc, tie, blob, ones, twos in zip(*(c.to_pylist() for c in batch.columns)):
            raw = unpack(blob)
            spans: list[list[int]] = []
            for one, two in sorted(zip(ones, twos)):
                one, two = one & ((1 << _TIE) - 1), two & ((1 << _TIE) - 1)
                if spans and one <= spans[-1][1]:
                    spans[-1][1] = max(spans[-1][1], two)
                else:
                    spans.append([one, two])
            kept, at = [], 0
            for one, two in spans:
                kept.append(raw[at:one])
                at = two
            kept.append(raw[at:])
            values = (doc, tie, sum(b - a for a, b in spans), len(spans), hashlib.sha256(b"".join(kept)).hexdigest(),
                      [a for a, _ in spans], [b for _, b in spans])
            for r, v in zip(rows, values):
                r.append(v)
        types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64())]
        yield pa.RecordBatch.from_arrays([pa.array(r, t) for r, t in zip(rows, types)],
                                         names=["doc", "tie", "removed", "spans", "sha", "starts", "stops"])


def _numbered(docs: DataFrame) -> DataFrame:
    """``doc, tie, text`` with ``(doc, tie)`` telling different texts apart."""
    d = texts(docs).select(F.coalesce("doc_id", F.lit(_LAST)).alias("doc"), F.coalesce("text", F.lit("")).alias("text"))
    n = d.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("doc").alias("k")).first()
    if n["n"] == n["k"]:
        return d.select("doc", F.lit(0).cast("int").alias("tie"), "text")
    w = Window.partitionBy("doc").orderBy(F.md5("text"))
    return d.select("doc", (F.dense_rank().over(w) - 1).cast("int").alias("tie"), "text")


def repeated_strings(docs: DataFrame, length: int = LENGTH, hot: int = HOT) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, starts, stops`` for
    every row of ``docs``; the spans are byte offsets of the removed runs."""
    d = _numbered(docs)
    base = stage(d.select("doc", "tie", F.octet_length("text").cast("long").alias("n"), F.md5("text").alias("digest"),
                          F.sha2("text", 256).alias("own_sha")), "base")
    first = base.where(F.col("n") >= length).groupBy("digest").agg(
        F.min(F.struct("doc", "tie")).alias("f"), F.count(F.lit(1)).alias("c")).where("c > 1")
    copies = stage(base.join(first, "digest").where((F.col("doc") != F.col("f.doc")) | (F.col("tie") != F.col("f.tie")))
                   .select("doc", "tie").distinct(), "copies")
    anchors = d.mapInArrow(_anchors(length), "h long, doc long, pos long")
    several = anchors.groupBy("h").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select(F.col("h").alias("h2"))
    places = anchors.join(several.hint("merge"), anchors["h"] == several["h2"]).select(
        "doc", F.shiftright("pos", _TIE).cast("int").alias("tie"), "pos")
    places = places.groupBy("doc", "tie").agg(F.collect_set("pos").alias("places")).join(copies, ["doc", "tie"], "left_anti")
    blobs = d.mapInArrow(_packed, "doc long, tie int, blob binary")
    kept = stage(blobs.join(places.hint("merge"), ["doc", "tie"]), "candidates")
    if _repeats_rows(base):
        kept = stage(kept.dropDuplicates(["doc", "tie"]), "candidates")
    runs = stage(kept.mapInArrow(_contexts(length), "c1 long, c2 long, h long, doc long, pos long, off int, text binary"),
                 "runs")
    # one of each context, the earliest; the others repeat it as a whole
    left = runs.groupBy("c1", "c2").agg(F.min(F.struct("doc", "pos", "h", "off", "text")).alias("lead"))
    left = stage(left.select("c1", "c2", "lead.*"), "contexts")
    lead = left.select(F.col("c1").alias("d1"), F.col("c2").alias("d2"), F.col("doc").alias("d"), F.col("pos").alias("p"))
    later = runs.select("c1", "c2", "doc", "pos", F.octet_length("text").alias("size")).join(
        lead.hint("merge"), (F.col("c1") == F.col("d1")) & (F.col("c2") == F.col("d2")))
    marks = [stage(later.where("doc <> d or pos <> p").select("doc", F.col("pos").alias("one"),
                                                              (F.col("pos") + F.col("size")).alias("two")), "copied")]
    discard(runs)
    left = left.select("h", "doc", "pos", "off", "text")
    often = stage(left.groupBy("h").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") > hot).select("h"), "hot")
    if not often.isEmpty():
        spread = left.join(often, "h", "left_semi").select("doc", "pos", "text").mapInArrow(
            _prefixes(length), "w1 long, w2 long, doc long, one long")
        first = spread.groupBy("w1", "w2").agg(F.min(F.struct("doc", "one")).alias("lead"))
        first = first.select(F.col("w1").alias("x1"), F.col("w2").alias("x2"), "lead")
        spread = spread.join(first.hint("merge"), (F.col("w1") == F.col("x1")) & (F.col("w2") == F.col("x2"))).where(
            (F.col("doc") != F.col("lead.doc")) | (F.col("one") != F.col("lead.one")))
        marks.append(stage(spread.select("doc", "one", (F.col("one") + length).alias("two")), "spread"))
        left = left.join(often, "h", "left_anti")
    sorted_ = left.repartition("h").sortWithinPartitions("h").mapInArrow(_repeats(length), "doc long, one long, two long")
    marks.append(stage(sorted_, "sorted"))
    marks = reduce(DataFrame.unionByName, marks)
    marks = marks.groupBy("doc", F.shiftright("one", _TIE).cast("int").alias("tie")).agg(
        F.collect_list(F.struct("one", "two")).alias("m"))
    marks = marks.select("doc", "tie", F.col("m.one").alias("ones"), F.col("m.two").alias("twos"))
    cut = kept.select("doc", "tie", "blob").join(marks.hint("merge"), ["doc", "tie"]).mapInArrow(
        _cut, "doc long, tie int, removed long, spans long, sha string, starts array<long>, stops array<long>")
    out = base.join(cut, ["doc", "tie"], "left").join(copies.withColumn("copy", F.lit(True)), ["doc", "tie"], "left")
    copy, none = F.col("copy").isNotNull(), F.array().cast("array<bigint>")
    pick = lambda other, if_copy, default: F.when(copy, if_copy).otherwise(F.coalesce(other, default))
    return out.select(
        F.when(F.col("doc") != _LAST, F.col("doc")).alias("doc_id"), F.col("n").alias("n_bytes"),
        pick(F.col("removed"), F.col("n"), F.lit(0).cast("long")).alias("n_removed"),
        pick(F.col("spans"), F.lit(1).cast("long"), F.lit(0).cast("long")).alias("n_spans"),
        pick(F.col("sha"), F.sha2(F.lit(""), 256), F.col("own_sha")).alias("kept_sha256"),
        pick(F.col("starts"), F.array(F.lit(0).cast("long")), none).alias("starts"),
        pick(F.col("stops"), F.array(F.col("n")), none).alias("stops"))


def _repeats_rows(base: DataFrame) -> bool:
    """Are there rows of the same id and text?"""
    n = base.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("doc", "tie").alias("k")).first()
    return n["n"] != n["k"]
