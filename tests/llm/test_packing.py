import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from lapse.llm.byte_level import Encoder
from lapse.llm.packing import VOCABULARY, pack, pieces

PATH = public_tokenizers.path(VOCABULARY)


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def check(rows, texts, tokenizer):
    by, seen = defaultdict(list), set()
    for r in rows:
        by[r.doc_id].append(r)
        assert r.length & (r.length - 1) == 0 and r.length <= 1024 and r.offset == 0
        seen.add(r.sequence_id)
    assert seen == set(range(len(rows)))
    assert set(by) == set(texts)
    for d, own in by.items():
        ids = np.array(tokenizer.encode(texts[d] or "", add_special_tokens=False).ids + [0], "<u4")
        at = 0
        for r in sorted(own, key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(ids[at:at + r.length].tobytes())
            at += r.length
        assert at == len(ids)


def test_whole_table(documents, tokenizer):
    check(pack(documents, PATH).collect(), {r.doc_id: r.text for r in documents.collect()}, tokenizer)


def test_encoder_equals_the_library(tokenizer):
    r = random.Random(2)
    encoder = Encoder(PATH)
    alphabet = "aA zZ  \n\t\r\x0b\x0c\x1c\x1f\x85\xa0''sstdrevml09.,!?éßñÉ½²ªº\xad 日本😀̀<|>"
    texts = ["".join(r.choice(alphabet) for _ in range(r.randint(0, 40))) for _ in range(3000)]
    texts += ["a<|endoftext|>b", "I'm we've  they'll\n\n  x'S 's", "x" * 5000, " " * 999, "1" * 400 + " ½²"]
    texts += ["".join(chr(r.randrange(0x250)) for _ in range(30)) for _ in range(2000)]
    texts += ["it's", "'s", "x 's", "\n's", "we'", "we'l", "!'s", "''s", "a'rex", "a've've", "\xa0's \x85"]
    raw = [t.encode() for t in texts]
    off = np.concatenate([[0], np.cumsum([len(x) for x in raw])])
    for again in range(2):
        got = encoder.encode(np.frombuffer(b"".join(raw), np.uint8), off)
        for t, ids in zip(texts, got):
            assert ids.tolist() == tokenizer.encode(t, add_special_tokens=False).ids, repr(t)


def test_pieces():
    n = np.array([1, 2, 1023, 1024, 1025, 5000])
    doc, start, size = pieces(n, 1024)
    for d, total in enumerate(n):
        s, x = start[doc == d], size[doc == d]
        assert x.sum() == total and s.tolist() == [x[:i].sum() for i in range(len(x))]
        assert all(v & (v - 1) == 0 for v in x.tolist()) and (np.diff(x) <= 0).all() and x.max() <= 1024
    assert len(doc) == 1 + 1 + 10 + 1 + 2 + 4 + bin(5000 % 1024).count("1")


def test_ids_of_the_pieces(documents, tokenizer):
    for r in pack(documents.limit(50), PATH, with_ids=True).collect():
        assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 and len(r.ids) == r.length


def test_odd_rows(odd, empty, tokenizer):
    got = pack(odd, PATH).where("doc_id is null or doc_id <> 5").collect()
    texts = {r.doc_id: r.text for r in odd.collect() if r.doc_id != 5}
    by = {r.doc_id for r in got}
    assert by == set(texts)
    assert [r.length for r in got if r.doc_id == 3] == [1] and pack(odd, PATH).where("doc_id = 5").count() % 2 == 0
    assert pack(empty, PATH).count() == 0
