"""Ids of a public sentence-piece tokenizer for whole batches of texts.

A merge makes a piece of the vocabulary, so no merge reaches across a place
where the byte before and the byte after stand next to each other in no piece.
Texts are cut at these places with numpy; every distinct new part is encoded
by the tokenizer's library once (:mod:`split_cache`).
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import sentencepiece
from sentencepiece import sentencepiece_model_pb2

from lapse.llm.split_cache import SplitCache

_SPACE = "▁"


class PieceEncoder:
    """Ids of texts that already begin with the space the tokenizer adds.
    ``lossy`` is the id of a part that its pieces do not give back."""

    def __init__(self, path: str):
        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        model.normalizer_spec.add_dummy_prefix = False
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
        count = self.library.get_piece_size()
        self.bytes = [self._bytes(i) for i in range(count)] + [b""]
        self.lossy = count
        self.joined = np.zeros((256, 256), bool)
        self.joined[:, 0x80:0xC0] = True  # inside a character
        for piece in self.bytes:
            self.joined[list(piece[:-1]), list(piece[1:])] = True
        self.parts = SplitCache(self._encode)

    def _bytes(self, i: int) -> bytes:
        piece = self.library.id_to_piece(i)
        if self.library.is_byte(i):
            return bytes([int(piece[3:5], 16)])
        special = self.library.is_control(i) or self.library.is_unknown(i)
        return b"" if special else piece.replace(_SPACE, " ").encode()

    def _encode(self, parts: list[bytes]) -> list[list[int]]:
        found = self.library.encode([p.decode(errors="replace") for p in parts], num_threads=1)
        return [ids if b"".join([self.bytes[i] for i in ids]) == p else [self.lossy] for ids, p in zip(found, parts)]

    def tokens(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of a batch of UTF-8 texts, one after the other, and where
        each text's begin (and the last one's end)."""
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        cut = np.ones(len(data) + 1, bool)
        cut[1:-1] = ~self.joined[data[:-1], data[1:]]
        cut[offsets] = True
        start = np.flatnonzero(cut[:-1])
        ids, sizes = self.parts.find(data, start, np.append(start[1:], len(data)))
        return ids, np.concatenate([[0], np.cumsum(sizes)])[np.searchsorted(start, offsets)]


@lru_cache(maxsize=2)
def piece_encoder(path: str) -> PieceEncoder:
    """One encoder a worker process, with what it remembers."""
    return PieceEncoder(path)
