import hashlib
import random

import numpy as np

from lapse.llm.suffix_dedup import deep_shallow, repeated_strings


def brute_force(rows, length=100):
    first, out = {}, {}
    for d, t in sorted(rows):
        raw = (t or "").encode()
        gone = np.zeros(len(raw), bool)
        for i in range(len(raw) - length + 1):
            s = raw[i:i + length]
            if s in first:
                gone[i:i + length] = True
            else:
                first[s] = d
        kept = bytes(np.frombuffer(raw, np.uint8)[~gone])
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out[d] = (len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    return out


def result(df, **kw):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeated_strings(df, **kw).collect()}


def test_whole_table(documents):
    want = brute_force([(r.doc_id, r.text) for r in documents.collect()])
    got = result(documents)
    assert got == want and sum(x[1] > 0 for x in want.values()) > 100


def test_periodic_overlapping_and_hot_strings(spark):
    r = random.Random(3)
    word = lambda: "".join(r.choice("abcdéf ") for _ in range(r.randint(1, 30)))
    shared = [word() * 12 for _ in range(6)] + ["".join(word() for _ in range(40)) for _ in range(6)]
    rows = [(d, "".join(r.choice([word(), r.choice(shared), "x" * r.randint(0, 300)]) for _ in range(r.randint(0, 14))))
            for d in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute_force(rows)
    assert result(df) == want
    assert result(df, hot=3) == want  # through the way for hot minimizers


def test_deep_shallow_finds_the_equal_prefixes_in_order():
    r = random.Random(8)
    data = "".join(r.choice(["ab", "abc", "q" * 50, "zebra" * 9]) for _ in range(400)).encode()
    at = np.arange(len(data) - 100)
    live, group = deep_shallow(np.frombuffer(data + bytes(8), np.uint8), at, np.zeros(len(at), np.int64), 100)
    want = {}
    for i in at:
        want.setdefault(data[i:i + 100], []).append(i)
    got = {}
    for i, g in zip(live.tolist(), group.tolist()):
        got.setdefault(g, []).append(i)
    assert sorted(sorted(x) for x in got.values()) == sorted(x for x in want.values() if len(x) > 1)


def test_odd_rows(odd, empty):
    got = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans) for r in repeated_strings(odd).collect()]
    assert len(got) == odd.count()
    long = next(x for x in got if x[0] == 7)
    assert long[1] == 80 + 18000 and long[2] > 17000 and long[3] == 1
    assert all(x[2] == 0 for x in got if x[0] != 7)
    assert repeated_strings(empty).count() == 0
