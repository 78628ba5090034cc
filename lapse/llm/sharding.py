"""Operator 4: shards of nearly equal bytes by minimax contiguous partition.

Groups of equal texts are atomic and stand in the order of their text digest.
The smallest shard capacity for which a greedy walk needs no more than
``shards`` shards is found by binary search, and the walk's cuts at that
capacity are the shard bounds.

The walk needs prefix sums over all groups, which never leave the cluster:
the order is split into digest ranges, and only range sums (at most ``FANOUT``
a step) reach the driver.  A range in which a cut may fall - the cuts of the
smallest and of the largest capacity still possible bound it - is split
further until every range that matters is one group.

Results for odd input: a null text has size 1 and the digest and CRC of the
empty text; repeated rows are rows of their own, in the same group; null
doc_ids are placed like any other; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from bisect import bisect_right

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapse.llm.common import number_rows, stage, texts

SHARDS = 8
#: Digest ranges looked at in one step are split into so many parts in all.
FANOUT = 1 << 14
DIGEST_BITS = 60


def sizes(docs: DataFrame) -> DataFrame:
    """``doc_id, size, text_crc32, digest``; the digest is 60 bits of MD5.  Two
    texts of one digest would share a shard, which is harmless."""
    t = texts(docs).withColumn("text", F.coalesce("text", F.lit("")))
    return t.select("doc_id", (F.octet_length("text") + 1).cast("long").alias("size"),
                    F.crc32("text").alias("text_crc32"),
                    F.conv(F.substring(F.md5("text"), 1, 15), 16, 10).cast("long").alias("digest"))


def _walk(runs: list[tuple[int, int, int]], ends: list[int], capacity: int, shards: int) -> list[int] | None:
    """Greedy cuts (indexes into ``runs``) at ``capacity``; None if more than
    ``shards`` shards would be needed."""
    cuts, start = [], 0
    for _ in range(shards):
        if start == len(runs):
            return cuts
        before = ends[start - 1] if start else 0
        stop = bisect_right(ends, before + capacity)
        if stop == start:
            return None
        cuts.append(stop)
        start = stop
    return cuts if start == len(runs) else None


def _least(runs: list[tuple[int, int, int]], shards: int) -> tuple[int, list[int]]:
    """Smallest feasible capacity and its cuts."""
    ends, total = [], 0
    for r in runs:
        total += r[2]
        ends.append(total)
    low, high = max(r[2] for r in runs), total
    while low < high:
        middle = (low + high) // 2
        if _walk(runs, ends, middle, shards) is None:
            low = middle + 1
        else:
            high = middle
    return low, _walk(runs, ends, low, shards)


def bounds(groups: DataFrame, shards: int = SHARDS, fanout: int = FANOUT) -> list[int]:
    """First digests of the shards after the first, for ``groups(digest, bytes)``."""

    def sums(spans: list[tuple[int, int]], width: int) -> list[tuple[int, int, int, int]]:
        split = groups
        if len(spans) > 1 or spans[0][1] < 1 << DIGEST_BITS:
            inside = None
            for first, wide in spans:
                c = F.col("digest").between(first, first + wide - 1)
                inside = c if inside is None else inside | c
            split = groups.where(inside)
        split = split.groupBy(F.expr(f"digest div {width}L").alias("part")).agg(
            F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("n"), F.min("digest").alias("first"))
        return [(r["part"], r["bytes"], r["n"], r["first"]) for r in split.collect()]

    return search(sums, shards, fanout)


def search(sums: Callable, shards: int, fanout: int) -> list[int]:
    """The cuts, from ``sums(spans, width)``: (part, bytes, groups, smallest
    digest) of every part of that width inside the spans.

    ``runs`` always covers the whole order: (first digest, width, bytes).  A
    run of one group or one digest is atomic.  Treating wide runs as atomic
    gives a capacity that is surely feasible, treating them as divisible
    anywhere one that no partition can beat; runs in which no cut for a
    capacity between the two can lie need not be split further.
    """
    spans = [(0, 1 << DIGEST_BITS)]
    runs: list[tuple[int, int, int, int]] = []  # first digest, width, bytes, groups
    while spans:
        parts = max(2, fanout // len(spans))
        bits = max(0, (spans[0][1] - 1).bit_length() - (parts.bit_length() - 1))
        width = 1 << bits
        found = [(first if n == 1 else part * width, 1 if n == 1 else width, size, n)
                 for part, size, n, first in sums(spans, width)]
        split = set(spans)
        runs = sorted([r for r in runs if (r[0], r[1]) not in split] + found)
        if not runs:
            return []
        high, _ = _least(runs, shards)
        spans = _undecided(runs, _optimistic(runs, shards), high, shards)
        if spans:  # spans of one step have one width: the widest ones first
            widest = max(w for _, w in spans)
            spans = [s for s in spans if s[1] == widest]
    _, cuts = _least(runs, shards)
    return [runs[c][0] for c in cuts if c < len(runs)]


def _reach(runs, capacity: int, shards: int, divisible: bool) -> list[int]:
    """Bytes that the first k shards of the greedy walk take, for every k.
    Nothing that is cut from finer runs reaches further than the walk over
    divisible runs, nor less far than the walk over atomic ones."""
    out, at, i, used = [], 0, 0, 0
    for _ in range(shards):
        left = capacity
        while i < len(runs):
            rest = runs[i][2] - used
            if rest > left:
                if divisible and runs[i][1] > 1:
                    at, used = at + left, used + left
                break
            at, left, i, used = at + rest, left - rest, i + 1, 0
        out.append(at)
    return out


def _optimistic(runs, shards: int) -> int:
    """A capacity no partition can beat: wide runs may be cut anywhere."""
    total = sum(r[2] for r in runs)
    low, high = max(-(-total // shards), max([r[2] for r in runs if r[1] == 1], default=0)), total
    while low < high:
        middle = (low + high) // 2
        if _reach(runs, middle, shards, True)[-1] == total:
            high = middle
        else:
            low = middle + 1
    return low


def _undecided(runs, low: int, high: int, shards: int) -> list[tuple[int, int]]:
    """Wide runs in which a cut of the greedy walk may fall for a capacity in
    ``low..high``: its k-th cut moves on with the capacity, so it lies between
    the shortest reach at ``low`` and the longest at ``high``."""
    cuts = list(zip(_reach(runs, low, shards - 1, False), _reach(runs, high, shards - 1, True)))
    out, before = [], 0
    for first, width, size, _ in runs:
        after = before + size
        if width > 1 and any(before < b and after > a for a, b in cuts):
            out.append((first, width))
        before = after
    return out


def shard(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` for every row."""
    rows = stage(sizes(docs), "sizes")
    groups = stage(rows.groupBy("digest").agg(F.sum("size").alias("bytes")), "groups")
    first = bounds(groups, shards)
    own = sum([F.when(F.col("digest") >= F.lit(b), 1).otherwise(0) for b in first], F.lit(0))
    placed = rows.select("doc_id", "size", "text_crc32", own.cast("int").alias("shard"))
    placed = number_rows(placed, ["shard"], [F.col("doc_id"), F.col("text_crc32")], F.xxhash64("doc_id"), "slot")
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                         F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
