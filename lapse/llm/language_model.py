"""Operator 9: language-model scores by masked pseudo-likelihood.

A small network predicts every token of a text from the ``WINDOW`` tokens on
either side of it: embeddings of the neighbours, one hidden layer, a softmax
over token classes.  A text's score is the sum over its tokens of
log P(class | both sides) + log P(token | class).

Tokens are words (A-Z lower-cased), told apart by ``BUCKETS`` hash buckets.
The counts of all buckets are taken over every document; the most frequent
buckets are classes of their own, the others share the remaining classes, in
which a token has its share of the corpus counts.

The network is trained in numpy inside the tasks.  In each of ``ROUNDS`` rounds
every task trains on its own documents of that round's ``1 / SHARE`` slice of
the corpus, all slices in turn, so that every text is trained on once, and the tasks' weights are
averaged by token count in an aggregation; the driver sees the averaged
weights only.  A task whose slice is empty takes no part.

Results for odd input: a null or blank text has no tokens, log_prob 0 and a
null mean; null doc_ids and repeated rows are scored like any other; an empty
table gives an empty result; without any training token the network is the
one it starts as.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapse.llm import words as W
from lapse.llm.common import texts

BUCKETS = 1 << 18
CLASSES = 256
OWN = 192
WINDOW = 2
EMBED = 16
HIDDEN = 32
#: Rounds, each on a slice of its own; together they cover every text.
SHARE = 4
ROUNDS = SHARE
#: Tokens whose softmax is taken together in scoring.
_TOGETHER = 256
_EDGE = CLASSES - 1  # the class that stands beyond either end of a text
_SHAPES = {"embed": (CLASSES, EMBED), "inner": (2 * WINDOW * EMBED, HIDDEN), "shift": (HIDDEN,),
           "outer": (HIDDEN, CLASSES), "bias": (CLASSES,)}


def _buckets(w: W.Words) -> np.ndarray:
    return (w.hash & np.uint64(BUCKETS - 1)).astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        data, off = W.raw(batch.column(0))
        for a, b in W.blocks(off):
            total += np.bincount(_buckets(W.Words(data[off[a]:off[b]], off[a:b + 1] - off[a])), minlength=BUCKETS)
    some = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], names=["bucket", "n"])


class Vocabulary:
    """Class of every bucket and log share of a bucket in its class, with one
    count added to every bucket so that none is impossible."""

    def __init__(self, counts: np.ndarray):
        order = np.lexsort((np.arange(BUCKETS), -counts))
        self.group = np.empty(BUCKETS, np.int16)
        self.group[order] = OWN + np.arange(BUCKETS) % (_EDGE - OWN)
        self.group[order[:OWN]] = np.arange(OWN)
        n = counts + 1.0
        self.share = np.log(n / np.bincount(self.group, n, CLASSES)[self.group]).astype(np.float32)
        self.prior = np.log((np.bincount(self.group, n, CLASSES) + 1e-3) / n.sum()).astype(np.float32)


def start(vocabulary: Vocabulary) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(1)
    p = {k: (rng.normal(size=s) * 0.1).astype(np.float32) for k, s in _SHAPES.items()}
    p["bias"] = vocabulary.prior.copy()
    return p


def contexts(group: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Classes of the neighbours of every token, the edge class beyond the
    first and last token of its text; (tokens, 2 * WINDOW)."""
    n = len(group)
    text = np.repeat(np.arange(len(row) - 1), np.diff(row))
    out = np.full((n, 2 * WINDOW), _EDGE, np.int16)
    for k, d in enumerate([d for d in range(-WINDOW, WINDOW + 1) if d]):
        to = np.arange(max(0, -d), min(n, n - d))
        same = text[to] == text[to + d]
        out[to[same], k] = group[to[same] + d]
    return out


def train(p: dict[str, np.ndarray], around: np.ndarray, group: np.ndarray, state: dict, batch: int = 256) -> None:
    """One pass of mini-batch steps with per-weight step sizes, in place."""
    embed, inner, shift, outer, bias = (p[k] for k in _SHAPES)
    order = np.random.default_rng(len(group)).permutation(len(group))
    cell = np.arange(embed.size).reshape(embed.shape)
    row = np.arange(batch) * CLASSES
    room, e = np.empty((batch, CLASSES), np.float32), np.empty(embed.size, np.float32)
    spare = {k: (np.empty(s, np.float32), np.empty(s, np.float32)) for k, s in _SHAPES.items()}
    for a in range(0, len(order), batch):
        i = order[a:a + batch]
        n = around.take(i, axis=0).ravel().astype(np.intp)
        x = embed.take(n, axis=0).reshape(len(i), -1)
        h = x @ inner
        h += shift
        np.tanh(h, out=h)
        z = np.matmul(h, outer, out=room[:len(i)])
        z += bias
        z -= z.max(1, keepdims=True)
        np.exp(z, out=z)
        if len(i) & (len(i) - 1):
            z /= z.sum(1, keepdims=True)
            z.reshape(-1)[row[:len(i)] + group.take(i)] -= 1.0
            z /= len(i)
        else:  # a power of two scales without rounding: softmax and mean in one pass
            z /= z.sum(1, keepdims=True) * np.float32(len(i))
            z.reshape(-1)[row[:len(i)] + group.take(i)] -= np.float32(1 / len(i))
        back = z @ outer.T
        slope = h * h
        back *= np.subtract(1, slope, out=slope)
        grad = {"outer": h.T @ z, "bias": z.sum(0), "inner": x.T @ back, "shift": back.sum(0)}
        e[:] = 0
        np.add.at(e, cell.take(n, axis=0).ravel(), (back @ inner.T).ravel())  # one index: numpy's fast way
        grad["embed"] = e.reshape(embed.shape)
        for k, g in grad.items():
            size, move = spare[k]
            state[k] += np.multiply(g, g, out=size)
            np.sqrt(state[k], out=size)
            size += 1e-4
            np.multiply(g, 0.1, out=move)
            move /= size
            p[k] -= move


def _trainer(p: dict[str, np.ndarray], vocabulary: Vocabulary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = {k: v.copy() for k, v in p.items()}
        state = {k: np.full(s, 1e-4, np.float32) for k, s in _SHAPES.items()}
        tokens = 0
        for batch in batches:
            data, off = W.raw(batch.column(0))
            for a, b in W.blocks(off):
                w = W.Words(data[off[a]:off[b]], off[a:b + 1] - off[a])
                group = vocabulary.group[_buckets(w)]
                if len(group):
                    train(own, contexts(group, w.row), group, state)
                    tokens += len(group)
        if tokens:
            flat = np.concatenate([own[k].ravel() for k in _SHAPES]).astype(float) * tokens
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat), dtype=np.int32)), pa.array(flat),
                                              pa.array(np.full(len(flat), tokens, np.int64))], names=["i", "v", "n"])

    return run


def token_log_probs(p: dict[str, np.ndarray], around: np.ndarray, group: np.ndarray, batch: int = 4096) -> np.ndarray:
    """log P(class | both sides) of every token."""
    table = np.stack([p["embed"] @ p["inner"][k * EMBED:(k + 1) * EMBED] for k in range(2 * WINDOW)])
    out = np.empty(len(group), np.float32)
    room = np.empty((min(batch, len(group)), CLASSES), np.float32)
    row = np.arange(_TOGETHER) * CLASSES
    for a in range(0, len(group), batch):
        n = around[a:a + batch].T.astype(np.intp)
        h = table[0].take(n[0], axis=0)
        for k in range(1, 2 * WINDOW):
            h += table[k].take(n[k], axis=0)
        h += p["shift"]
        logits = np.matmul(np.tanh(h, out=h), p["outer"], out=room[:len(h)])
        for b in range(0, len(h), _TOGETHER):  # so few that they stay in the processor's cache
            z, to = logits[b:b + _TOGETHER], out[a + b:a + min(b + _TOGETHER, len(h))]
            z += p["bias"]
            own = z.reshape(-1).take(row[:len(z)] + group[a + b:a + b + len(z)])
            top = z.max(1)
            z -= top[:, None]
            np.exp(z, out=z)
            to[:] = own - top - np.log(z.sum(1))
    return out


def _scorer(p: dict[str, np.ndarray], vocabulary: Vocabulary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            data, off = W.raw(batch.column(1))
            for a, b in W.blocks(off):
                w = W.Words(data[off[a]:off[b]], off[a:b + 1] - off[a])
                bucket = _buckets(w)
                group = vocabulary.group[bucket]
                each = token_log_probs(p, contexts(group, w.row), group) + vocabulary.share[bucket]
                total = np.concatenate([[0.0], np.cumsum(each.astype(float))])
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(a, b - a), pa.array(w.counts().astype(np.int64)),
                     pa.array(np.round(total[w.row[1:]] - total[w.row[:-1]], 6))], names=["doc_id", "n_tokens", "log_prob"])

    return run


def fit(docs: DataFrame, rounds: int = ROUNDS, share: int = SHARE) -> tuple[dict[str, np.ndarray], Vocabulary]:
    """The trained network and the corpus vocabulary."""
    d = texts(docs)
    counted = d.select("text").mapInArrow(_count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(BUCKETS)
    counts[counted.column("bucket").to_numpy()] = counted.column("n").to_numpy()
    vocabulary = Vocabulary(counts)
    p = start(vocabulary)
    slot = F.pmod(F.xxhash64("text", F.lit(41)), F.lit(share))
    for turn in range(rounds):
        slice_ = d.where(slot == turn % share).select("text")
        mean = (slice_.mapInArrow(_trainer(p, vocabulary), "i int, v double, n long")
                .groupBy("i").agg((F.sum("v") / F.sum("n")).alias("v")).toArrow())
        if mean.num_rows:
            flat = np.zeros(sum(int(np.prod(s)) for s in _SHAPES.values()), np.float32)
            flat[mean.column("i").to_numpy()] = mean.column("v").to_numpy()
            ends = np.cumsum([int(np.prod(s)) for s in _SHAPES.values()])
            p = {k: x.reshape(s) for (k, s), x in zip(_SHAPES.items(), np.split(flat, ends[:-1]))}
    return p, vocabulary


def scores(docs: DataFrame, rounds: int = ROUNDS, share: int = SHARE) -> DataFrame:
    """``doc_id, n_tokens, log_prob, mean_log_prob`` for every row of ``docs``."""
    out = texts(docs).mapInArrow(_scorer(*fit(docs, rounds, share)), "doc_id long, n_tokens long, log_prob double")
    return out.withColumn("mean_log_prob", F.when(F.col("n_tokens") > 0, F.col("log_prob") / F.col("n_tokens")))
