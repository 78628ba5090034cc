import random
import zlib
from collections import Counter, defaultdict

from lapse.llm.sharding import bounds, search, shard, sizes


def test_whole_table(spark, documents):
    text = {r.doc_id: r.text for r in documents.collect()}
    got = shard(documents).collect()
    assert len(got) == len(text) and {r.law for r in got} == {"bytes"}
    slots = defaultdict(list)
    for r in got:
        raw = (text[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.grown_shard) == (len(raw) + 1, zlib.crc32(raw), None)
        slots[r.shard].append(r.slot)
    assert sorted(slots) == list(range(8)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    where = defaultdict(set)
    for r in got:
        where[text[r.doc_id]].add(r.shard)
    assert all(len(x) == 1 for x in where.values())
    total = Counter()
    for r in got:
        total[r.shard] += r.size
    assert max(total.values()) - min(total.values()) < 2 * max(r.size for r in got) * 3


def best(sizes, shards):
    low, high = max(sizes), sum(sizes)
    while low < high:
        m, n, left = (low + high) // 2, 1, (low + high) // 2
        for s in sizes:
            if s > left:
                n, left = n + 1, m
            left -= s
        low, high = (low, m) if n <= shards else (m + 1, high)
    return low


def test_cuts_are_the_minimax_ones_at_any_fanout(spark):
    r = random.Random(4)
    for trial in range(4):
        groups = {r.randrange(1 << 60): r.choice([1, 5, 20, 400]) * r.randint(1, 9) for _ in range(300)}
        order = sorted(groups)
        df = spark.createDataFrame(list(groups.items()), "digest long, bytes long")
        for fanout in (16, 64, 1 << 14):
            first = bounds(df, 8, fanout)
            total = Counter(sum(g >= b for b in first) for g in order for _ in range(1))
            load = Counter()
            for g in order:
                load[sum(g >= b for b in first)] += groups[g]
            assert max(load.values()) == best([groups[g] for g in order], 8), (trial, fanout, total)


def greedy(groups, capacity):
    """First digests of the shards after the first of the greedy walk."""
    out, left = [], capacity
    for g in sorted(groups):
        if groups[g] > left:
            out.append(g)
            left = capacity
        left -= groups[g]
    return out


def test_cuts_of_skewed_groups_are_the_greedy_ones():
    r = random.Random(9)
    for trial in range(2000):
        kind = trial % 4
        n = r.randint(1, 120)
        groups = {}
        for _ in range(n):
            near = r.choice([r.randrange(1 << 60), r.randrange(1 << 20), (1 << 59) + r.randrange(1 << 12)])
            groups[near] = [r.randint(1, 9), r.choice([1, 1, 1, 500]), int(r.paretovariate(0.6)), 2 ** r.randint(0, 14)][kind]
        order = sorted(groups)

        def sums(spans, width, groups=groups, order=order):
            out = {}
            for g in order:
                if any(f <= g < f + w for f, w in spans):
                    p = out.setdefault(g // width, [0, 0, g])
                    p[0] += groups[g]
                    p[1] += 1
            return [(k, *v) for k, v in out.items()]

        shards, fanout = r.choice([2, 3, 8]), r.choice([4, 8, 16, 64])
        least = best([groups[g] for g in order], shards)
        # a bound may be any digest between two groups
        got = [min(g for g in order if g >= b) for b in search(sums, shards, fanout)]
        assert got == greedy(groups, least), (trial, shards, fanout)


def test_huge_group_and_odd_rows(spark, odd, empty):
    rows = [(i, "copy" * 50) for i in range(300)] + [(1000 + i, f"other {i}") for i in range(300)]
    got = shard(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len({r.shard for r in got if r.doc_id < 300}) == 1
    got = shard(odd).collect()
    assert len(got) == odd.count() and sorted(r.size for r in got)[:2] == [1, 1]
    assert shard(empty).count() == 0
    assert sizes(odd).where("text_crc32 = 0").count() == 2
