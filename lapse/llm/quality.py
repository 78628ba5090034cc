"""Operator 3: quality classifier, Naive Bayes features in a linear SVM.

A text's features are indicators of its word 1- and 2-grams, of character
4-grams at word starts, and of a few shape marks (share of capitals, of
symbols, of repeated words, length; each cut into levels), hashed into
``DIMENSIONS`` slots.  Every feature is scaled by its class log-count ratio,
counted over all training rows; then all training rows are dealt, by a
hash of the id, into deals of about ``DEAL`` rows with both classes; in each an
L1-loss SVM is fitted by dual coordinate descent, the weights are averaged, and a
logistic curve fitted on the margins of all dealt rows turns a margin into a score.

Labels are read from training rows only.  Scores use nothing but the text.

Results for odd input: a null text counts as empty and gets the score of the
bias alone; doc_ids without a label are scored only; labels other than 0 and
1 or null are ignored; with no training rows, or rows of one class, every
score is the share of label 1 (0.5 without rows); repeated rows are scored
alike; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapse.llm import words as W
from lapse.llm.common import stage, texts

DIMENSIONS = 1 << 18
DEAL = 12_000
_FOLD = 3


def held_out() -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % _FOLD == 1


def _levels(x: np.ndarray, cuts) -> np.ndarray:
    return np.searchsorted(np.asarray(cuts), x, "right").astype(np.uint64)


def features(data: np.ndarray, off: np.ndarray, dimensions: int = DIMENSIONS) -> tuple[np.ndarray, np.ndarray]:
    """(slots, ranges): the distinct feature slots of every row of a batch."""
    w = W.Words(data, off)
    n = len(off) - 1
    row_of = np.repeat(np.arange(n), w.counts())
    with np.errstate(over="ignore"):
        one = w.hash
        two = W.mix(w.hash[:-1] * np.uint64(3) + w.hash[1:])[row_of[:-1] == row_of[1:]] if len(w.hash) else one
        padded = np.concatenate([data, np.zeros(4, np.uint8)]).astype(np.uint64)
        head = np.zeros(len(w.start), np.uint64)
        for j in range(4):
            head = head * np.uint64(257) + np.where(w.start + j < w.end, padded[w.start + j], 0).astype(np.uint64)
        head = W.mix(head + np.uint64(0xABCDEF))
    size = np.maximum(np.diff(off), 1)
    ends = np.concatenate([[0], np.cumsum((data >= 65) & (data <= 90))])
    capital = (ends[off[1:]] - ends[off[:-1]]) / size
    plain = ((data | 32) >= 97) & ((data | 32) <= 122) | (data >= 128) | (data == 32) | (data == 10)
    ends = np.concatenate([[0], np.cumsum(~plain)])
    symbol = (ends[off[1:]] - ends[off[:-1]]) / size
    key = np.stack([row_of.astype(np.uint64), one], 1) if len(one) else np.zeros((0, 2), np.uint64)
    order = np.lexsort((key[:, 1], key[:, 0]))
    k = key[order]
    fresh = np.ones(len(k), bool)
    fresh[1:] = (k[1:] != k[:-1]).any(1)
    distinct = np.bincount(row_of[order][fresh], minlength=n)
    repeated = 1 - distinct / np.maximum(w.counts(), 1)
    same = np.bincount(row_of[1:][(one[1:] == one[:-1]) & (row_of[1:] == row_of[:-1])], minlength=n) / np.maximum(
        w.counts(), 1) if len(one) else np.zeros(n)
    marks = [_levels(capital, [.01, .03, .06, .1, .2, .4]), _levels(symbol, [.01, .03, .05, .08, .12, .2, .4]),
             _levels(repeated, [.1, .2, .3, .4, .5, .6, .7, .8, .9]), _levels(same, [.01, .05, .1, .3, .6]),
             _levels(np.diff(off), [1, 50, 200, 1000, 5000, 20000])]
    shape = np.concatenate([W.mix(m + np.uint64(1000 * (i + 1))) for i, m in enumerate(marks)])
    rows = np.concatenate([row_of, row_of[:-1][row_of[:-1] == row_of[1:]] if len(one) else row_of, row_of,
                           np.tile(np.arange(n), len(marks))]).astype(np.int64)
    slot = (np.concatenate([one, two, head, shape]) % np.uint64(dimensions)).astype(np.int64)
    both = np.unique(rows * dimensions + slot)
    return (both % dimensions).astype(np.int32), np.searchsorted(both, np.arange(n + 1) * dimensions)


def _batches(column: pa.Array, dimensions: int):
    data, off = W.raw(column)
    for a, b in W.blocks(off):
        yield a, b, *features(data[off[a]:off[b]], off[a:b + 1] - off[a], dimensions)


def _counts(dimensions: int):
    """Per task: for every slot the rows of either class that have it."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, dimensions + 1), np.int64)
        for batch in batches:
            label = batch.column(1).to_numpy(zero_copy_only=False)
            for a, b, slot, at in _batches(batch.column(0), dimensions):
                y = label[a:b].astype(np.int64)
                each = np.repeat(y, np.diff(at))
                for c in (0, 1):
                    total[c, :-1] += np.bincount(slot[each == c], minlength=dimensions)
                    total[c, -1] += int((y == c).sum())
        some = np.flatnonzero(total.sum(0))
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[0, some]),
                                          pa.array(total[1, some])], names=["slot", "n0", "n1"])

    return count


def _slots(column: pa.Array, dimensions: int) -> Iterator[np.ndarray]:
    """The feature slots of every text."""
    for _, _, slot, at in _batches(column, dimensions):
        for i in range(len(at) - 1):
            yield slot[at[i]:at[i + 1]]


def _descent(scale: np.ndarray, dimensions: int):
    """The weights of one deal's rows, the bias in the last slot."""

    def fit_deal(deal: pa.Table) -> pa.Table:
        slots = [s for batch in deal.to_batches() for s in _slots(batch.column("text"), dimensions)]
        y = np.where(deal.column("label").to_numpy() == 1, 1.0, -1.0)
        order = np.lexsort(([int(s[:8].sum()) if len(s) else 0 for s in slots], [len(s) for s in slots], y))
        w = dual_descent([slots[i] for i in order], y[order], scale)
        some = np.flatnonzero(w)
        return pa.table({"slot": pa.array(some.astype(np.int32)), "w": pa.array(w[some])})

    return fit_deal


def _margins(w: np.ndarray, scale: np.ndarray, dimensions: int):
    def margins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = [(scale[s] @ w[s]) / (np.sqrt(scale[s] @ scale[s]) or 1.0) + w[-1]
                 for s in _slots(batch.column("text"), dimensions)]
            yield pa.RecordBatch.from_arrays([pa.array(m, pa.float64()), batch.column("label")], names=["margin", "label"])

    return margins


def dual_descent(slots: list[np.ndarray], y: np.ndarray, scale: np.ndarray, cost: float = 0.1,
                 rounds: int = 12, seed: int = 5) -> np.ndarray:
    """L1-loss linear SVM by dual coordinate descent over rows of unit norm;
    the last weight is the bias.  Rows of the rarer class weigh more, so both
    classes carry the same total cost."""
    w = np.zeros(len(scale) + 1)
    share = np.bincount((y > 0).astype(int), minlength=2) / len(y)
    top = np.where(y > 0, cost / (2 * share[1]), cost / (2 * share[0]))
    norm = np.array([np.sqrt(scale[s] @ scale[s]) or 1.0 for s in slots])
    square = np.array([(scale[s] / k) @ (scale[s] / k) for s, k in zip(slots, norm)]) + 1.0
    alpha = np.zeros(len(y))
    rng = np.random.default_rng(seed)
    for _ in range(rounds):
        moved = 0.0
        for i in rng.permutation(len(y)):
            s = slots[i]
            v = scale[s] / norm[i]
            g = y[i] * (w[s] @ v + w[-1]) - 1.0
            new = min(max(alpha[i] - g / square[i], 0.0), top[i])
            if new != alpha[i]:
                step = (new - alpha[i]) * y[i]
                w[s] += step * v
                w[-1] += step
                moved = max(moved, abs(new - alpha[i]))
                alpha[i] = new
        if moved < 1e-3 * cost:
            break
    return w


def logistic(margin: np.ndarray, y: np.ndarray, rows: np.ndarray | None = None) -> tuple[float, float]:
    """Slope and shift of the curve 1 / (1 + exp(-(a * margin + b))), by Newton
    steps on smoothed targets; both classes weigh the same.  ``rows`` says how
    many rows have each margin (one, if it is not given)."""
    rows = np.ones(len(y)) if rows is None else rows
    n1, n0 = rows[y > 0].sum(), rows[y <= 0].sum()
    target = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    weight = rows * np.where(y > 0, 0.5 / max(n1, 1), 0.5 / max(n0, 1))
    x = np.stack([margin, np.ones(len(margin))], 1)
    beta = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        grad = x.T @ (weight * (p - target)) + 1e-4 * beta
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-4 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        beta -= step
        if np.abs(step).max() < 1e-8:
            break
    return max(float(beta[0]), 1e-6), float(beta[1])


def fit(docs: DataFrame, labels: DataFrame, dimensions: int = DIMENSIONS, deal: int = DEAL):
    """(weights by slot with the bias last, slope, shift) from the training rows."""
    lab = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("label"))
           .where("label in (0, 1)").where(~held_out()).dropDuplicates(["doc_id"]))
    train = texts(docs).where(~held_out()).join(lab.hint("merge"), "doc_id").select("doc_id", "text", "label")
    # one shuffle of the labelled texts; features are made three times from the stage
    train = stage(train, "labelled")
    counted = train.select("text", "label").mapInArrow(_counts(dimensions), "slot int, n0 long, n1 long")
    total = counted.groupBy("slot").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).toArrow()
    slot = total.column("slot").to_numpy()
    n = np.zeros((2, dimensions + 1))
    n[0, slot], n[1, slot] = total.column("n0").to_numpy(), total.column("n1").to_numpy()
    rows = n[:, -1]
    if not rows.min():
        share = (rows[1] / rows.sum()) if rows.sum() else 0.5
        return np.zeros(dimensions + 1, np.float32), 0.0, float(np.log(max(share, 1e-9) / max(1 - share, 1e-9)))
    n = n[:, :-1] + 1.0
    ratio = np.log(n[1] / n[1].sum()) - np.log(n[0] / n[0].sum())
    # deals of at most half of ``deal`` rows of either class; where one class has
    # fewer deals, they are dealt again until every row has been in one
    deals = [max(1, -(-int(k) * 2 // deal)) for k in rows]
    most = max(deals)
    spot = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.when(F.col("label") == 1, deals[1]).otherwise(deals[0]))
    step = F.when(F.col("label") == 1, deals[1]).otherwise(deals[0])
    dealt = train.select("label", "text", F.explode(F.sequence(spot.cast("int"), F.lit(most - 1), step)).alias("deal"))
    found = dealt.groupBy("deal").applyInArrow(_descent(ratio, dimensions), "slot int, w double")
    found = found.groupBy("slot").agg(F.sum("w").alias("w")).toArrow()
    w = np.zeros(dimensions + 1)
    w[found.column("slot").to_numpy()] = found.column("w").to_numpy() / most
    margins = dealt.mapInArrow(_margins(w, ratio, dimensions), "margin double, label int")
    margins = margins.groupBy(F.round("margin", 3).alias("margin"), "label").agg(F.count(F.lit(1)).alias("n")).toArrow()
    y = np.where(margins.column("label").to_numpy() == 1, 1.0, -1.0)
    a, b = logistic(margins.column("margin").to_numpy(), y, margins.column("n").to_numpy())
    return np.append(ratio * w[:-1], w[-1]).astype(np.float32), ratio.astype(np.float32), a, b


def _score(column: pa.Array, model, dimensions: int) -> np.ndarray:
    out = [np.zeros(0)]
    for a, b, slot, at in _batches(column, dimensions):
        if len(model) == 3:
            z = np.full(b - a, model[2])
        else:
            weight, ratio, slope, shift = model
            sums = np.concatenate([[0.0], np.cumsum(weight[slot].astype(float))])
            norms = np.concatenate([[0.0], np.cumsum(ratio[slot].astype(float) ** 2)])
            norm = np.sqrt(norms[at[1:]] - norms[at[:-1]])
            z = slope * ((sums[at[1:]] - sums[at[:-1]]) / np.where(norm > 0, norm, 1) + weight[-1]) + shift
        out.append(1 / (1 + np.exp(-np.clip(z, -500, 500))))
    return np.concatenate(out)


def _scores(model, dimensions: int):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(_score(batch.column(1), model, dimensions))],
                                             names=["doc_id", "score"])

    return score


def accepted(docs: DataFrame, labels: DataFrame, dimensions: int = DIMENSIONS, deal: int = DEAL) -> DataFrame:
    """The rows of ``docs``, all columns, whose predicted label is 1."""
    model = fit(docs, labels, dimensions, deal)
    text = docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_score(batch.column(text), model, dimensions) >= 0.5))

    return docs.mapInArrow(keep, docs.schema)


def quality_scores(docs: DataFrame, labels: DataFrame, dimensions: int = DIMENSIONS, deal: int = DEAL) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``."""
    model = fit(docs, labels, dimensions, deal)
    out = texts(docs).mapInArrow(_scores(model, dimensions), "doc_id long, score double")
    return out.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score",
                      F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))
