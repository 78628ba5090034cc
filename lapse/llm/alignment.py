"""Operator 11: alignment of two tokenizers by interval coalescing.

Tokenizer A (byte-level) reads a space and the text, tokenizer B (sentence
pieces) the text, before which it puts that space itself; so the tokens of
both are byte ranges that tile the same bytes.  All ranges of a batch are put
in order of their starts by one lexsort; the running maximum of their ends
breaks them into groups wherever a start reaches it.  Inside a group every A
token is linked with every B token.

How many documents hold an id pair linked is counted over the whole corpus
without moving tokens: a task writes its documents in blocks of about
``BLOCK`` bytes of text, each with the list of its distinct id pairs and how
many of its documents hold each.  These lists are summed by pair, the sums go
back to the blocks that asked for them, and a block's documents look them up.
What is shuffled is a block's distinct pairs and, once, its documents' places
in that list; the only broadcast has one row for every id of A at most.

Results for odd input: null and empty texts, and texts that A's or B's tokens
do not give back byte for byte, have no tokens, zeros and an empty digest;
repeated rows are documents of their own; an empty table gives an empty
result; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapse.llm import words as W
from lapse.llm.byte_level import alphabet, encoder
from lapse.llm.common import stage, texts
from lapse.llm.piece_level import piece_encoder

A_MODEL, B_MODEL = "byte_bpe_50k.json", "piece_bpe_32k.model"
BLOCK = 8_000_000
#: Id pairs held at a time; larger groups are expanded from their distinct ids.
_PAIRS, _LARGE = 2_000_000, 4096
_B_BITS = 15  # ids of B are below 2^15, those of A below 2^16
_KEY = (1 << 31) - 1
_BLOCKS = ("block long, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, "
           "n_links array<long>, groups_sha256 array<string>, pairs array<long>, steps binary, "
           "many_at array<long>, many array<long>, keys array<int>, held array<int>")
_RESULT = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
           "groups_sha256 string")
_RESULT_TYPES = pa.schema([(c.split()[0], pa.string() if c.endswith("string") else pa.int64()) for c in _RESULT.split(", ")])


@lru_cache(maxsize=2)
def _sizes(path: str) -> np.ndarray:
    """Bytes of every entry of A: one character of an entry is one byte."""
    vocabulary = json.load(open(path, encoding="utf-8"))["model"]["vocab"]
    known = set(alphabet())
    out = np.zeros(1 << 16, np.int64)
    for entry, i in vocabulary.items():
        out[i] = sum(c in known for c in entry)
    return out


@lru_cache(maxsize=1)
def _digits() -> tuple[np.ndarray, np.ndarray]:
    """Decimal digits of every id as the low bytes of a 64-bit word, and their number."""
    text = [str(i).encode() for i in range(1 << 16)]
    return np.array([int.from_bytes(t, "little") for t in text], np.uint64), np.array([len(t) for t in text])


def coalesce(a_end: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group of every A and every B token, given where they end: both tile
    the same bytes.  Groups are numbered from 0 in the order of the bytes."""
    a, b = (np.concatenate([[0], e[:-1]]) if len(e) else e for e in (a_end, b_end))
    start, end = np.concatenate([a, b]), np.concatenate([a_end, b_end])
    order = np.lexsort((end, start))
    reach = np.maximum.accumulate(end[order])
    fresh = np.ones(len(order), bool)
    fresh[1:] = start[order][1:] >= reach[:-1]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(fresh) - 1
    return group[:len(a)], group[len(a):]


def _bounded(n: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of entries whose ``n`` sum to about ``most``, one entry at least."""
    total = np.concatenate([[0], np.cumsum(n)])
    at = 0
    while at < len(n):
        to = max(at + 1, int(np.searchsorted(total, total[at] + most, "right")) - 1)
        yield at, to
        at = to


def _counted(codes: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes and how often (with what weight) each occurs."""
    if weights is None:
        return np.unique(codes, return_counts=True)
    order = np.argsort(codes, kind="stable")
    codes, weights = codes[order], weights[order]
    first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
    return codes[first], np.add.reduceat(weights, first)


def linked(a: np.ndarray, b: np.ndarray, ga: np.ndarray, gb: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document << 31 | A id << 15 | B id) of all links, distinct and in
    order, and the number of links of each.  ``doc`` is every A token's."""
    groups = int(ga[-1]) + 1 if len(ga) else 0
    na, nb = np.bincount(ga, minlength=groups), np.bincount(gb, minlength=groups)
    first_a, first_b = np.cumsum(na) - na, np.cumsum(nb) - nb
    large = na * nb > _LARGE
    left = (doc << 31) | (a.astype(np.int64) << _B_BITS)
    b = b.astype(np.int64)
    parts = []
    n = np.where(large[ga], 0, nb[ga])
    for i, j in _bounded(n, _PAIRS):
        own = n[i:j]
        at = np.arange(int(own.sum())) - np.repeat(np.cumsum(own) - own - first_b[ga[i:j]], own)
        parts.append(_counted(np.repeat(left[i:j], own) | b[at]))
    for g in np.flatnonzero(large):
        ua, ca = np.unique(left[first_a[g]:first_a[g] + na[g]], return_counts=True)
        ub, cb = np.unique(b[first_b[g]:first_b[g] + nb[g]], return_counts=True)
        for i, j in _bounded(np.full(len(ua), len(ub)), _PAIRS):
            parts.append(((ua[i:j, None] | ub).ravel(), (ca[i:j, None] * cb).ravel()))
    if len(parts) == 1:
        return parts[0]
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return _counted(np.concatenate([c for c, _ in parts]), np.concatenate([w for _, w in parts]))


def _group_digests(a, b, ga, gb, bound_a, bound_b) -> list[str]:
    """SHA-256 of every document's ``a1,a2|b1;a3|b2,b3``."""
    groups = int(ga[-1]) + 1 if len(ga) else 0
    na, nb = np.bincount(ga, minlength=groups), np.bincount(gb, minlength=groups)
    word, width = _digits()
    records, chars = np.zeros(len(a) + len(b), np.uint64), np.zeros(len(a) + len(b) + 1, np.int64)
    sign = np.uint64(56)
    last_a, last_b = np.append(ga[1:] != ga[:-1], True), np.append(gb[1:] != gb[:-1], True)
    sep_a = np.where(last_a, ord("|"), ord(",")).astype(np.uint64)
    sep_b = np.where(last_b, ord(";"), ord(",")).astype(np.uint64)
    sep_b[bound_b[1:][bound_b[1:] > bound_b[:-1]] - 1] = 0  # a document's last token
    to = np.arange(len(a)) + (np.cumsum(nb) - nb)[ga]
    records[to], chars[to + 1] = word[a] | (sep_a << sign), width[a] + 1
    to = np.arange(len(b)) + np.cumsum(na)[gb]
    records[to], chars[to + 1] = word[b] | (sep_b << sign), width[b] + (sep_b > 0)
    raw = records.view(np.uint8)
    text = memoryview(raw[raw != 0].tobytes())
    at = np.cumsum(chars)[bound_a + bound_b].tolist()
    return [hashlib.sha256(text[i:j]).hexdigest() if j > i else "" for i, j in zip(at[:-1], at[1:])]


def _select(ids: np.ndarray, bound: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the documents to keep; the others have none."""
    n = np.diff(bound)
    if keep.all():
        return ids, bound
    return ids[np.repeat(keep, n)], np.concatenate([[0], np.cumsum(np.where(keep, n, 0))])


def align(data: np.ndarray, offsets: np.ndarray, a_path: str, b_path: str) -> dict:
    """Tokens, groups and links of a batch of texts."""
    size = np.diff(offsets)
    full = size > 0
    data = np.insert(data, offsets[:-1][full], 32)
    offsets = np.concatenate([[0], np.cumsum(size + full)])
    a_sizes, pieces = _sizes(a_path), piece_encoder(b_path)
    b_sizes = np.array([len(x) for x in pieces.bytes])
    a, bound_a = encoder(a_path, True).tokens(data, offsets)
    b, bound_b = pieces.tokens(data, offsets)
    whole = np.concatenate([[0], np.cumsum(a_sizes[a])])[bound_a]
    lossy = np.concatenate([[0], np.cumsum(b == pieces.lossy)])[bound_b]
    keep = full & (np.diff(whole) == np.diff(offsets)) & (np.diff(lossy) == 0)
    a, bound_a = _select(a, bound_a, keep)
    b, bound_b = _select(b, bound_b, keep)
    ga, gb = coalesce(np.cumsum(a_sizes[a]), np.cumsum(b_sizes[b]))
    doc = np.repeat(np.arange(len(size)), np.diff(bound_a))
    codes, count = linked(a, b, ga, gb, doc)
    of = codes >> 31
    links = np.zeros(len(size), np.int64)
    np.add.at(links, of, count)
    groups = np.zeros(len(size), np.int64)
    some = np.flatnonzero(np.diff(bound_a))
    groups[some] = ga[bound_a[1:][some] - 1] + 1 - ga[bound_a[:-1][some]]
    return {"n_a": np.diff(bound_a), "n_b": np.diff(bound_b), "n_groups": groups, "n_links": links,
            "groups_sha256": _group_digests(a, b, ga, gb, bound_a, bound_b),
            "pairs": np.bincount(of, minlength=len(size)), "codes": codes & _KEY, "count": count}


def _block(number: int, docs: list, parts: list[dict]) -> pa.RecordBatch:
    """One row for a block: its documents, its distinct pairs, and every
    document's pairs as steps between their places in that list."""
    join = lambda k: np.concatenate([p[k] for p in parts])
    codes, count, pairs = join("codes"), join("count"), join("pairs")
    keys, held = np.unique(codes, return_counts=True)
    at = np.searchsorted(keys, codes)
    step = np.diff(at, prepend=0)
    first = (np.cumsum(pairs) - pairs)[pairs > 0]
    step[first] = at[first]
    # byte planes, lowest first: the upper ones are nearly all zero and shrink to nothing
    planes = step.astype("<u4").view(np.uint8).reshape(-1, 4).T[:max(1, (len(keys).bit_length() + 7) // 8)]
    many = np.flatnonzero(count > 1)
    row = [pa.array([number])]
    row.append(pa.array([docs], pa.list_(pa.int64())))
    for k in ("n_a", "n_b", "n_groups", "n_links"):
        row.append(pa.array([join(k)], pa.list_(pa.int64())))
    row.append(pa.array([[x for p in parts for x in p["groups_sha256"]]], pa.list_(pa.string())))
    row.append(pa.array([pairs], pa.list_(pa.int64())))
    row.append(pa.array([planes.tobytes()], pa.binary()))
    row += [pa.array([many], pa.list_(pa.int64())), pa.array([count[many]], pa.list_(pa.int64()))]
    row += [pa.array([keys], pa.list_(pa.int32())), pa.array([held], pa.list_(pa.int32()))]
    return pa.RecordBatch.from_arrays(row, names=[c.split()[0] for c in _BLOCKS.split(", ")])


def _blocks_of(a_path: str, b_path: str, block: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        docs, parts, held = [], [], 0
        for batch in batches:
            ids = batch.column(0).to_pylist()
            data, off = W.raw(batch.column(1))
            for i, j in W.blocks(off):
                parts.append(align(data[off[i]:off[j]], off[i:j + 1] - off[i], a_path, b_path))
                docs += ids[i:j]
                held += int(off[j] - off[i])
                if held >= block or len(docs) >= block // 64:
                    yield _block(number, docs, parts)
                    number += 1
                    docs, parts, held = [], [], 0
        if docs:
            yield _block(number, docs, parts)

    return run


def _rated(blocks: pa.Table, rates: pa.Table) -> pa.Table:
    """The result rows of a block, given the rate of each of its pairs: twice
    the number of documents that hold it, plus 1 if it is its A id's best."""
    rate = np.zeros(rates.num_rows, np.int64)
    rate[rates["at"].to_numpy()] = rates["rate"].to_numpy()
    row = {c: blocks[c][0] for c in blocks.column_names}
    pairs, count = (row[c].values.to_numpy() for c in ("pairs", "n_a"))
    total = int(pairs.sum())
    code = np.frombuffer(row["steps"].as_py(), np.uint8).reshape(-1, total) if total else np.zeros((1, 0), np.uint8)
    step = sum(p.astype(np.int64) << (8 * k) for k, p in enumerate(code))
    end = np.cumsum(pairs)
    run = np.concatenate([[0], np.cumsum(step)])
    at = run[1:] - np.repeat(run[end - pairs], pairs)
    times = np.ones(total, np.int64)
    times[row["many_at"].values.to_numpy()] = row["many"].values.to_numpy()
    found = rate[at]

    def summed(x: np.ndarray) -> pa.Array:
        s = np.concatenate([[0], np.cumsum(x * times)])
        return pa.array(s[end] - s[end - pairs])

    out = {c: row[c].values for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")}
    out |= {"n_best": summed(found & 1), "count_sum": summed(found >> 1)}
    return pa.Table.from_arrays([out[c] for c in _RESULT_TYPES.names], schema=_RESULT_TYPES)


def pair_counts(blocks: DataFrame) -> DataFrame:
    """``a, b, documents`` for every id pair linked anywhere."""
    one = blocks.select(F.explode(F.arrays_zip("keys", "held")).alias("p"))
    n = one.groupBy(F.col("p.keys").alias("key")).agg(F.sum("p.held").alias("documents"))
    return n.select("key", F.shiftright("key", _B_BITS).alias("a"),
                    F.col("key").bitwiseAND(F.lit((1 << _B_BITS) - 1)).alias("b"), "documents")


def alignments(docs: DataFrame, a_path: str, b_path: str, block: int = BLOCK) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum,
    groups_sha256`` for every row of ``docs``."""
    blocks = stage(texts(docs).mapInArrow(_blocks_of(a_path, b_path, block), _BLOCKS), "aligned")
    counts = stage(pair_counts(blocks), "pairs")
    best = counts.groupBy("a").agg(F.max("documents").alias("most"))  # one row for every id of A at most
    rates = counts.join(F.broadcast(best), "a").select(
        "key", (F.col("documents") * 2 + (F.col("documents") == F.col("most")).cast("long")).alias("rate"))
    asked = blocks.select(F.col("block").alias("asking"), F.posexplode("keys").alias("at", "key"))
    given = asked.join(rates.hint("merge"), "key").select("asking", "at", "rate")
    return blocks.drop("keys", "held").groupBy("block").cogroup(given.groupBy("asking")).applyInArrow(_rated, _RESULT)
