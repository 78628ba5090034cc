import math
import re
import zlib
from bisect import bisect_right
from collections import Counter

import numpy as np

from lapse.llm.quality import DIMENSIONS, dual_descent, features, fit, quality_scores


def test_held_out_accuracy_on_whole_table(spark):
    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    got = quality_scores(docs, labels).join(labels, "doc_id").collect()
    out = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    accuracy = {q: np.mean([r.predicted == q for r in out if r.quality == q]) for q in (0, 1)}
    pos, neg = ([r.score for r in out if r.quality == q] for q in (1, 0))
    auc = np.mean([(p > n) + 0.5 * (p == n) for p in pos[:400] for n in neg])
    print(accuracy, auc)
    assert auc > 0.9 and accuracy[1] > 0.95 and accuracy[0] > 0.7


def test_labels_of_held_out_rows_are_not_used(spark, documents):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    flipped = labels.selectExpr("doc_id", "if(crc32(string(doc_id)) % 3 = 1, 1 - quality, quality) as quality")
    one, two = (sorted((r.doc_id, r.score) for r in quality_scores(documents, x).collect()) for x in (labels, flipped))
    assert one == two


def test_dual_descent_reaches_the_primal_optimum():
    rng = np.random.default_rng(0)
    x = rng.random((60, 6)) < 0.5
    y = np.where(x[:, 0] ^ (rng.random(60) < 0.1), 1.0, -1.0)
    rows = [np.flatnonzero(r) for r in x]
    w = dual_descent(rows, y, np.ones(6), cost=1.0, rounds=3000)

    def primal(w):
        unit = np.array([np.append(r / (np.sqrt(r.sum()) or 1), 1.0) for r in x.astype(float)])
        share = np.array([(y <= 0).mean(), (y > 0).mean()])
        cost = np.where(y > 0, 1 / (2 * share[1]), 1 / (2 * share[0]))
        return 0.5 * w @ w + (cost * np.maximum(0, 1 - y * (unit @ w))).sum()

    best = primal(w)
    assert all(best <= primal(w + 0.05 * rng.normal(size=7)) + 1e-2 for _ in range(300))


def test_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(1, 1, None), (3, 0, None), (None, 1, None), (6, None, 1), (4, 7, 1), (1, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    got = quality_scores(odd, labels).collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= .5) for r in got)
    assert quality_scores(empty, labels).count() == 0
    none = quality_scores(odd, labels.where("false")).collect()
    assert {r.score for r in none} == {0.5}


def plain_features(text):
    """The features of one text, unhashed, by plain loops."""
    raw = text.encode()
    parts = re.findall(rb"[^\x20\x09-\x0D]+", raw)
    words = [p.lower() for p in parts]
    size, n = max(len(raw), 1), max(len(words), 1)
    capital = sum(65 <= c <= 90 for c in raw) / size
    symbol = sum(not (65 <= c <= 90 or 97 <= c <= 122 or c >= 128 or c in (32, 10)) for c in raw) / size
    same = sum(a == b for a, b in zip(words, words[1:])) / n
    marks = [(capital, [.01, .03, .06, .1, .2, .4]), (symbol, [.01, .03, .05, .08, .12, .2, .4]),
             (1 - len(set(words)) / n, [.1, .2, .3, .4, .5, .6, .7, .8, .9]), (same, [.01, .05, .1, .3, .6]),
             (len(raw), [1, 50, 200, 1000, 5000, 20000])]
    return ({("one", w) for w in words} | {("two", *w) for w in zip(words, words[1:])} | {("head", p[:4]) for p in parts}
            | {("mark", i, bisect_right(cuts, x)) for i, (x, cuts) in enumerate(marks)})


def packed(texts):
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0] + [len(t) for t in raw])


def test_features_are_those_of_plain_loops(documents):
    texts = [r.text or "" for r in documents.orderBy("doc_id").limit(60).collect()] + ["", "One one ONE  two"]
    slot, at = features(*packed(texts), 1 << 30)
    want = [plain_features(t) for t in texts]
    assert [len(w) for w in want] == np.diff(at).tolist()
    assert sorted(Counter(f for w in want for f in w).values()) == sorted(Counter(slot.tolist()).values())


def test_log_count_ratios_and_scores_equal_brute_force_on_the_whole_table(spark):
    d = "/root/testdata/sf0.001"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    text = {r.doc_id: r.text or "" for r in docs.collect()}
    label = {r.doc_id: r.quality for r in labels.collect() if r.quality in (0, 1)}
    slots = {}
    for i, t in text.items():
        slot, _ = features(*packed([t]))
        slots[i] = slot.tolist()
    held = {i: zlib.crc32(str(i).encode()) % 3 == 1 for i in text}
    count = [Counter(), Counter()]
    for i in text:
        if i in label and not held[i]:
            count[label[i]].update(slots[i])
    total = [sum(c.values()) + DIMENSIONS for c in count]
    weight, ratio, slope, shift = fit(docs, labels)
    for s in {s for own in slots.values() for s in own}:
        want = math.log((count[1][s] + 1) / total[1]) - math.log((count[0][s] + 1) / total[0])
        assert abs(ratio[s] - want) < 1e-5
    got = quality_scores(docs, labels).collect()
    assert len(got) == len(text)
    for r in got:
        own = slots[r.doc_id]
        norm = math.sqrt(sum(float(ratio[s]) ** 2 for s in own)) or 1.0
        margin = sum(float(weight[s]) for s in own) / norm + float(weight[-1])
        assert abs(r.score - 1 / (1 + math.exp(-(slope * margin + shift)))) < 1e-6
        assert r.held_out == held[r.doc_id] and r.predicted == (r.score >= 0.5)


def test_every_training_row_is_in_a_deal(spark, monkeypatch):
    from lapse.llm import quality as Q
    rows = [(i, f"good word{i} fine text{i % 7}" if i % 5 else f"BAD!!! $$ word{i}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 5 > 0)) for i in range(300)], "doc_id long, quality int")
    train = labels.where(~Q.held_out()).count()
    seen, dealt = spark.sparkContext.accumulator(0), spark.sparkContext.accumulator(0)
    descent = Q._descent

    def counted(*args):
        run = descent(*args)

        def one(deal):
            seen.add(deal.num_rows)
            dealt.add(1)
            assert deal.num_rows < 60 and len(set(deal.column("label").to_pylist())) == 2
            return run(deal)

        return one

    monkeypatch.setattr(Q, "_descent", counted)
    out = Q.quality_scores(docs, labels, 1 << 12, 40).collect()
    assert dealt.value > 5 and seen.value >= train
    right = sum(r["predicted"] == int(r["doc_id"] % 5 > 0) for r in out if r["held_out"])
    assert right >= 0.9 * sum(r["held_out"] for r in out)
