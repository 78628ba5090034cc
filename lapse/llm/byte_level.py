"""Ids of a public byte-level tokenizer for whole batches of texts.

The tokenizer splits a text by a fixed pattern and merges inside the splits
only, so the ids of a split do not depend on what surrounds it.  The splits
of a batch are found with numpy, every distinct new split is merged by the
tokenizer library once, and the ids of a text are gathered from remembered
ones (:mod:`split_cache`).  Texts with characters from U+0240 on, and texts
that hold the text of a special token, go through the library whole.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import regex
from tokenizers import Tokenizer

from lapse.llm.split_cache import SplitCache

_LETTER, _NUMBER, _SPACE, _OTHER = range(4)
_ODD_LEAD = 0xC9  # first byte of U+0240 and above


def _classes() -> np.ndarray:
    """Class of every code point below U+0240 in the pattern's sense."""
    out = np.full(0x240, _OTHER, np.uint8)
    for c, name in ((_LETTER, r"\p{L}"), (_NUMBER, r"\p{N}"), (_SPACE, r"\s")):
        out[[p for p in range(0x240) if regex.fullmatch(name, chr(p))]] = c
    return out


_CLASS = _classes()


def alphabet() -> list[str]:
    """The character that stands for each byte in the entries of the
    vocabulary: printable ones for themselves, the others from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    out, n = [], 0
    for b in range(256):
        out.append(chr(b if b in plain else 0x100 + n))
        n += b not in plain
    return out


_SIGNS = dict(enumerate(alphabet()))


def split(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Byte positions at which the splits of the texts start.

    The pattern: runs of letters, of numbers, or of other signs, each with one
    space before it if there is one; the rest of a run of white space by
    itself; and the clitics 's 't 're 've 'm 'll 'd cut off a following word.
    """
    n = len(data)
    code = data.astype(np.uint16)
    lead = np.flatnonzero(data >= 0xC0)
    code[lead] = ((code[lead] & 0x1F) << 6) | (code[np.minimum(lead + 1, n - 1)] & 0x3F)
    kind = _CLASS[np.minimum(code, 0x23F)]
    kind[np.minimum(lead + 1, n - 1)] = kind[lead]
    first = np.zeros(n + 1, bool)
    first[offsets] = True
    run = first[:n].copy()
    run[1:] |= kind[1:] != kind[:-1]
    start = run.copy()
    at = np.flatnonzero(run)
    end = np.append(at[1:], n)
    # the last sign of white space before something else stands apart, and
    # goes with what follows if it is a space
    blank = (kind[at] == _SPACE) & ~first[end]
    end = end[blank]
    last = end - 1
    wide = (data[last] & 0xC0) == 0x80
    start[last - wide] = True
    start[end[data[last] == 32]] = False
    # clitics
    mark = at[(data[at] == 39) & start[at]]
    mark = mark[mark + 1 < n]
    mark = mark[run[mark + 1] & ~first[mark + 1] & (kind[mark + 1] == _LETTER)]
    if len(mark):
        one = data[mark + 1]
        two = np.where((mark + 2 < n) & ~first[np.minimum(mark + 2, n)], data[np.minimum(mark + 2, n - 1)], 0)
        short = np.isin(one, np.frombuffer(b"stmd", np.uint8))
        long = ((one == 114) | (one == 118)) & (two == 101) | (one == 108) & (two == 108)
        start[mark[short | long] + 1] = False
        after = np.concatenate([mark[short] + 2, mark[long] + 3])
        start[after[after < n]] = True
    return np.flatnonzero(start)


class Encoder:
    """``plain`` encodes the strings of special tokens as any other text."""

    def __init__(self, path: str, plain: bool = False):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain
        self.special = [] if plain else [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        model = self.tokenizer.model
        self.splits = SplitCache(lambda spans: (
            [t.id for t in model.tokenize(s.decode("latin-1").translate(_SIGNS))] for s in spans))

    def whole(self, batch: list[str]) -> list[np.ndarray]:
        out: list[np.ndarray] = []
        for i in range(0, len(batch), 256):  # the library's results are large
            found = self.tokenizer.encode_batch(batch[i:i + 256], add_special_tokens=False)
            out += [np.asarray(e.ids, np.uint32) for e in found]
        return out

    def tokens(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of a batch of UTF-8 texts, one after the other, and where
        each text's begin (and the last one's end)."""
        n = len(offsets) - 1
        foreign = np.concatenate([[0], np.cumsum(data >= _ODD_LEAD)])
        odd = foreign[offsets[1:]] > foreign[offsets[:-1]]
        raw = data.tobytes() if self.special or odd.any() else b""
        for mark in self.special:
            p = raw.find(mark)
            while p >= 0:
                odd[np.searchsorted(offsets, p, "right") - 1] = True
                p = raw.find(mark, p + 1)
        strange = np.flatnonzero(odd)
        parts = self.whole([raw[offsets[i]:offsets[i + 1]].decode(errors="replace") for i in strange])
        if len(strange):
            data = data[~np.repeat(odd, np.diff(offsets))]
            offsets = np.concatenate([[0], np.cumsum(np.where(odd, 0, np.diff(offsets)))])
        ids, bound = np.zeros(0, np.uint32), np.zeros(n + 1, np.int64)
        if len(data):
            start = split(data, offsets)
            ids, sizes = self.splits.find(data, start, np.append(start[1:], len(data)))
            bound = np.concatenate([[0], np.cumsum(sizes)])[np.searchsorted(start, offsets)]
        if not len(strange):
            return ids, bound
        rows = [ids[a:b] for a, b in zip(bound[:-1], bound[1:])]
        for i, own in zip(strange, parts):
            rows[i] = own
        return np.concatenate(rows), np.concatenate([[0], np.cumsum([len(r) for r in rows])])

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        """The ids of every text of a batch of UTF-8 texts."""
        ids, bound = self.tokens(data, offsets)
        return [ids[a:b] for a, b in zip(bound[:-1], bound[1:])]


@lru_cache(maxsize=2)
def encoder(path: str, plain: bool = False) -> Encoder:
    """One encoder a worker process, with what it remembers."""
    return Encoder(path, plain)
