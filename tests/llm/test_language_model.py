import time

import numpy as np
from pyspark.sql import functions as F

from lapse.llm import language_model as LM
from lapse.llm import words as W


def brute_force(p, vocabulary, text):
    """Token by token, with the plain softmax."""
    data = text.encode()
    w = W.Words(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
    bucket = LM._buckets(w)
    group = vocabulary.group[bucket].tolist()
    total = 0.0
    for i, (g, b) in enumerate(zip(group, bucket)):
        around = [group[j] if 0 <= j < len(group) else LM._EDGE for j in (i - 2, i - 1, i + 1, i + 2)]
        x = np.concatenate([p["embed"][c] for c in around]).astype(float)
        h = np.tanh(x @ p["inner"] + p["shift"])
        z = h @ p["outer"] + p["bias"]
        total += z[g] - z.max() - np.log(np.exp(z - z.max()).sum()) + vocabulary.share[b]
    return len(group), total


def test_scores_equal_brute_force_and_the_network_learns(documents):
    p, vocabulary = LM.fit(documents, share=4)
    from lapse.llm.common import texts
    d = texts(documents)
    got = {r.doc_id: r for r in d.mapInArrow(LM._scorer(p, vocabulary), "doc_id long, n_tokens long, log_prob double").collect()}
    rows = {r.doc_id: r.text for r in d.collect()}
    assert set(got) == set(rows)
    for i in sorted(rows)[:25]:
        n, total = brute_force(p, vocabulary, rows[i])
        assert got[i].n_tokens == n and abs(got[i].log_prob - total) < 1e-3 * max(1, abs(total))
    # held-out slices: better than the corpus frequencies alone
    plain = LM.start(vocabulary)
    plain["outer"][:] = 0
    held = d.where(F.pmod(F.xxhash64("text", F.lit(41)), F.lit(4)) > 1)
    score = lambda q: held.mapInArrow(LM._scorer(q, vocabulary), "doc_id long, n_tokens long, log_prob double").agg(
        F.sum("log_prob") / F.sum("n_tokens")).first()[0]
    assert score(p) > score(plain) + 0.05


def test_probabilities_add_up_to_one():
    rng = np.random.default_rng(0)
    counts = rng.integers(0, 50, LM.BUCKETS).astype(float)
    v = LM.Vocabulary(counts)
    inside = np.bincount(v.group, np.exp(v.share.astype(float)), LM.CLASSES)
    assert np.allclose(inside[:LM._EDGE], 1, atol=1e-3)
    p = LM.start(v)
    around = np.full((LM.CLASSES, 4), 7, np.int16)
    assert abs(np.exp(LM.token_log_probs(p, around, np.arange(LM.CLASSES)).astype(float)).sum() - 1) < 1e-4


def test_odd_rows(odd, empty):
    got = LM.scores(odd).collect()
    assert len(got) == odd.count()
    assert all((r.n_tokens, r.log_prob, r.mean_log_prob) == (0, 0.0, None) for r in got if r.doc_id in (2, 3, 4))
    assert all(r.mean_log_prob < 0 for r in got if r.n_tokens)
    assert LM.scores(empty).count() == 0


def test_every_text_is_trained_on(spark):
    for i in range(3):
        docs = spark.createDataFrame([(i, f"a table of one text, number {i}, which is all there is")], "doc_id long, text string")
        p, vocabulary = LM.fit(docs)
        assert any((p[k] != x).any() for k, x in LM.start(vocabulary).items())


def plain_train(p, around, group, state, batch=256):
    """The steps of ``train`` as plain expressions."""
    order = np.random.default_rng(len(group)).permutation(len(group))
    for a in range(0, len(order), batch):
        i = order[a:a + batch]
        x = p["embed"][around[i]].reshape(len(i), -1)
        h = np.tanh(x @ p["inner"] + p["shift"])
        z = h @ p["outer"] + p["bias"]
        z -= z.max(1, keepdims=True)
        z = np.exp(z)
        z /= z.sum(1, keepdims=True)
        z[np.arange(len(i)), group[i]] -= 1.0
        z /= len(i)
        back = (z @ p["outer"].T) * (1 - h * h)
        grad = {"outer": h.T @ z, "bias": z.sum(0), "inner": x.T @ back, "shift": back.sum(0),
                "embed": np.zeros_like(p["embed"])}
        np.add.at(grad["embed"], around[i].ravel(), (back @ p["inner"].T).reshape(-1, LM.EMBED))
        for k, g in grad.items():
            state[k] += g * g
            p[k] -= 0.1 * g / (np.sqrt(state[k]) + 1e-4)


def test_training_takes_the_plain_steps_in_less_time():
    rng = np.random.default_rng(3)
    v = LM.Vocabulary(rng.integers(0, 50, LM.BUCKETS).astype(float))
    group = rng.integers(0, LM._EDGE, 20_100).astype(np.int16)
    around = LM.contexts(group, np.arange(0, 20_101, 100))

    def run(step):
        p, state = LM.start(v), {k: np.full(s, 1e-4, np.float32) for k, s in LM._SHAPES.items()}
        t0 = time.process_time()
        step(p, around, group, state)
        return p, time.process_time() - t0

    plain, own = zip(*[(run(plain_train), run(LM.train)) for _ in range(5)])
    assert all(np.allclose(plain[0][0][k], own[0][0][k], rtol=1e-4, atol=1e-5) for k in LM._SHAPES)
    assert min(t for _, t in own) < 0.85 * min(t for _, t in plain)


def test_logits_beyond_the_range_of_exp():
    rng = np.random.default_rng(3)
    p = {k: rng.normal(size=s).astype(np.float32) for k, s in LM._SHAPES.items()}
    around, group = rng.integers(0, LM.CLASSES, (50, 2 * LM.WINDOW)).astype(np.int16), rng.integers(0, LM.CLASSES, 50)
    h = np.tanh(p["embed"][around].reshape(50, -1).astype(float) @ p["inner"] + p["shift"])
    for bias in (0.0, 200.0, -200.0):
        p["bias"] += np.float32(bias)
        z = h @ p["outer"] + p["bias"]
        top = z.max(1)
        want = z[np.arange(50), group] - top - np.log(np.exp(z - top[:, None]).sum(1))
        assert np.allclose(LM.token_log_probs(p, around, group), want, atol=1e-3)
        p["bias"] -= np.float32(bias)
