"""Ids of the short pieces a tokenizer's texts fall into, remembered.

A tokenizer that never merges across certain places of a text gives every
piece between two such places the same ids wherever it stands.  Pieces of up
to 15 bytes are looked up for a whole batch at once in a table addressed by a
hash of their bytes; the table holds the bytes themselves (15 and the length
in two 64-bit words), so no two pieces are ever taken for one another.  What
the table does not hold is encoded by the tokenizer's library, once a batch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from itertools import chain

import numpy as np

from lapse.llm import words as W

SHORT = 15
_BITS = 20
#: Remembered ids and long pieces at which a worker starts anew (memory bound only).
_MOST_IDS, _MOST_LONG = 4_000_000, 50_000
_KEEP = np.array([(1 << (8 * i)) - 1 for i in range(8)] + [2**64 - 1], np.uint64)


class SplitCache:
    def __init__(self, encode: Callable[[list[bytes]], Iterable[Sequence[int]]]):
        self.encode = encode
        self.forget()

    def forget(self) -> None:
        self.low, self.high = (np.zeros(1 << _BITS, np.uint64) for _ in range(2))
        self.at, self.size = (np.zeros(1 << _BITS, np.int32) for _ in range(2))
        self.ids, self.used = np.zeros(1 << 18, np.uint32), 0
        self.long: dict[bytes, tuple[int, int]] = {}

    def _add(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Encode pieces; where their ids stand, and how many there are."""
        new = list(self.encode(pieces))
        size = np.fromiter(map(len, new), np.int64, len(new))
        total = int(size.sum())
        while self.used + total > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[self.used:self.used + total] = np.fromiter(chain.from_iterable(new), np.uint32, total)
        at = self.used + np.cumsum(size) - size
        self.used += total
        return at, size

    def find(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces ``data[start:end]``: all of them one after the
        other, and the number of each piece's ids."""
        if self.used > _MOST_IDS or len(self.long) > _MOST_LONG:
            self.forget()
        padded = np.concatenate([data, np.zeros(16, np.uint8)])
        words = np.ndarray((len(data) + 9,), "<u8", padded, strides=(1,))
        length = end - start
        short = length <= SHORT
        low = words[start] & _KEEP[np.minimum(length, 8)]
        high = words[np.minimum(start + 8, len(data))] & _KEEP[np.clip(length - 8, 0, 7)]
        high |= np.minimum(length, SHORT + 1).astype(np.uint64) << np.uint64(56)
        slot = (W.mix(low ^ (high * np.uint64(0x9E3779B97F4A7C15))) >> np.uint64(64 - _BITS)).astype(np.int64)
        known = short & (self.low[slot] == low) & (self.high[slot] == high)
        at, size = self.at[slot].astype(np.int64), self.size[slot].astype(np.int64)
        miss = np.flatnonzero(~known)
        if len(miss):
            raw = data.tobytes()
            order: dict[bytes, int] = {}
            which = np.fromiter((order.setdefault(raw[a:b], len(order)) for a, b in
                                 zip(start[miss].tolist(), end[miss].tolist())), np.int64, len(miss))
            spans = list(order)
            place, count = np.zeros(len(spans), np.int64), np.zeros(len(spans), np.int64)
            new = []
            for i, s in enumerate(spans):
                if len(s) > SHORT and s in self.long:
                    place[i], count[i] = self.long[s]
                else:
                    new.append(i)
            if new:
                place[new], count[new] = self._add([spans[i] for i in new])
                self.long.update({spans[i]: (int(place[i]), int(count[i])) for i in new if len(spans[i]) > SHORT})
            at[miss], size[miss] = place[which], count[which]
            fresh = miss[short[miss]]
            to = slot[fresh]
            self.low[to], self.high[to], self.at[to], self.size[to] = low[fresh], high[fresh], at[fresh], size[fresh]
        to = np.cumsum(size) - size
        return self.ids[np.repeat(at - to, size) + np.arange(int(size.sum()))], size
