import hashlib
import random
import re

import xxhash

from lapse.llm.fingerprints import FUNCTIONS, K, POSITION_BITS, fingerprints


def edited(rows):
    """(edited text, next text) by doc_id, for distinct ids."""
    order = sorted(rows, reverse=True)
    out = {}
    for i, (d, t) in enumerate(order):
        t, nxt = t or "", order[(i + 1) % len(order)][1] or ""
        n = len(t) // 3
        out[d] = (t[:len(t) - n] + nxt[:n], nxt)
    return out


def kmers(text):
    w = text.strip(" \t\n\r\x0b\x0c")
    w = re.split(r"[\x09-\x0d\x20]+", w) if w else []
    seen, out = {}, []
    for i in range(max(1, len(w) - K + 1) if w else 0):
        k = tuple(w[i:i + K])
        out.append((k, seen.setdefault(k, 0)))
        seen[k] += 1
    return out


def xx(*values):
    """xxhash64 of longs, ints (as such pairs) and strings, signed."""
    seed = 42
    for v in values:
        data = v.encode() if isinstance(v, str) else v[0].to_bytes(v[1], "little", signed=True)
        seed = xxhash.xxh64_intdigest(data, seed)
    return seed - (1 << 64) if seed >> 63 else seed


def shortened(value, bits):
    """The low ``64 - bits`` bits, signed."""
    value = (value << bits) & ((1 << 64) - 1)
    return (value - (1 << 64) if value >> 63 else value) >> bits


def brute_force(text):
    """The fingerprint: for each order its first and last k-mer, in text order."""
    ids = [xx((shortened(xx(*k), POSITION_BITS), 8), (n, 4)) for k, n in kmers(text)]
    if not ids:
        return "0" * 8 * FUNCTIONS
    out = []
    for j in range(FUNCTIONS):
        v = [(xx((shortened(x, POSITION_BITS + 1), 8), (j, 4)) >> (POSITION_BITS + 1), at) for at, x in enumerate(ids)]
        one, two = sorted((min(v), max(v)), key=lambda x: x[1])
        out.append(f"{xx((one[0], 8), (two[0], 8)) & 0xFFFFFFFF:08x}")
    return "".join(out)


def test_prints_equal_brute_force_on_whole_table(documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    want = edited(rows)
    got = {r.doc_id: r for r in fingerprints(documents, ranges=16).collect()}
    for d, t in rows:
        assert got[d].fingerprint == brute_force(t or ""), d
        assert got[d].edited_fingerprint == brute_force(want[d][0]), d


def test_both_ends_of_an_order_are_drawn_from_all_pairs():
    """Every ordered pair of k-mers is as likely as any other."""
    text = " ".join("abcdefgh")
    ids = [xx((shortened(xx(*k), POSITION_BITS), 8), (n, 4)) for k, n in kmers(text)]
    n, seen = 20_000, {}
    for j in range(n):
        v = [xx((shortened(x, POSITION_BITS + 1), 8), (j, 4)) for x in ids]
        key = v.index(min(v)), v.index(max(v))
        seen[key] = seen.get(key, 0) + 1
    assert len(seen) == 30 and max(abs(c - n / 30) for c in seen.values()) < 5 * (n / 30) ** 0.5


def pair_share(x, y):
    """Expected share of equal entries: both ends of a random order of the
    union shared, and standing in the same order."""
    a, b = {k: i for i, k in enumerate(x)}, {k: i for i, k in enumerate(y)}
    union, common = list(set(a) | set(b)), set(a) & set(b)
    r = random.Random(1)
    hit = 0
    for _ in range(400):
        p, q = r.sample(union, 2) if len(union) > 1 else union * 2
        hit += p in common and q in common and (a[p] < a[q]) == (b[p] < b[q])
    return hit / 400


def test_whole_table(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    text, want = dict(rows), edited(rows)
    got = {r.doc_id: r for r in fingerprints(documents, ranges=16).collect()}
    assert set(got) == set(text)
    by_text = {}
    for d, r in got.items():
        assert r.n_chars == len(text[d] or "")
        assert r.edited_sha256 == hashlib.sha256(want[d][0].encode()).hexdigest()
        assert by_text.setdefault(text[d], r.fingerprint) == r.fingerprint
        assert by_text.get(want[d][0], r.edited_fingerprint) == r.edited_fingerprint
        nxt = max((e for e in text if e < d), default=max(text))
        same = lambda x, y: sum(x[8 * j:8 * j + 8] == y[8 * j:8 * j + 8] for j in range(32)) / 32
        assert r.near_edited == same(r.fingerprint, r.edited_fingerprint)
        assert r.near_next == same(r.fingerprint, got[nxt].fingerprint)
    mean = sum(r.near_edited for r in got.values()) / len(got)
    some = list(got)[:60]
    expected = sum(pair_share(kmers(text[d] or ""), kmers(want[d][0])) for d in some) / len(some)
    found = sum(got[d].near_edited for d in some) / len(some)
    assert abs(found - expected) < 0.05 and mean > 0.15
    assert sum(r.near_next for r in got.values()) / len(got) < 0.02


def test_order_and_occurrences_matter(spark):
    r = random.Random(3)
    words = [f"w{i}" for i in range(200)]
    halves = " ".join(words[100:] + words[:100])
    back = " ".join(x for i in range(0, 200, 20) for x in words[180 - i:200 - i])
    df = spark.createDataFrame([(1, " ".join(words)), (2, halves), (3, back), (4, "a b c a b c a b c"), (5, "a b c a b c")],
                               "doc_id long, text string")
    p = {x.doc_id: x.fingerprint for x in fingerprints(df).collect()}
    same = lambda x, y: sum(x[8 * j:8 * j + 8] == y[8 * j:8 * j + 8] for j in range(32)) / 32
    # all three share nearly all k-mers; only pairs in the same order agree
    assert 0.3 < same(p[1], p[2]) < 0.75 and same(p[1], p[3]) < 0.35
    assert p[4] != p[5]


def test_odd_rows_and_native_plan(odd, empty):
    df = fingerprints(odd)
    got = df.collect()
    assert len(got) == odd.count()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    zeros = "0" * 256
    assert all(by[d][0].fingerprint == zeros for d in (2, 3, 4)) and by[1][0].fingerprint == by[5][0].fingerprint
    assert len(by[5]) == 2 and by[6][0].fingerprint == by[8][0].fingerprint != zeros
    assert fingerprints(empty).count() == 0
    plan = df._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
