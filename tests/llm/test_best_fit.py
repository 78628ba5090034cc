import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from lapse.llm.best_fit import VOCABULARY, Bins, pack

PATH = public_tokenizers.path(VOCABULARY)


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def check(rows, texts, tokenizer, length=1024):
    """Every id in one piece, cut only as allowed, sequences without gaps."""
    by, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        by[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert set(by) == set(texts)
    total = 0
    for d, own in by.items():
        ids = np.array(tokenizer.encode(texts[d] or "", add_special_tokens=False).ids + [2], "<u4")
        own.sort(key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(-(-len(ids) // length)))
        at = 0
        for r in own:
            assert r.start == at and r.ids_crc32 == zlib.crc32(ids[at:at + r.length].tobytes())
            assert r.length == length if r.piece else r.length <= length
            at += r.length
        assert at == len(ids)
        total += at
    for own in sequences.values():
        own.sort(key=lambda r: r.offset)
        assert [r.offset for r in own] == np.cumsum([0] + [r.length for r in own[:-1]]).tolist()
        assert sum(r.length for r in own) <= length
    return len(sequences), total


def test_whole_table(documents, tokenizer):
    texts = {r.doc_id: r.text for r in documents.collect()}
    used, total = check(pack(documents, PATH).collect(), texts, tokenizer)
    assert used <= 1.02 * (total / 1024) + 1
    used, total = check(pack(documents.repartition(20), PATH).collect(), texts, tokenizer)
    assert used <= 1.02 * (total / 1024) + 1
    # with few open sequences: worse, still whole
    few, _ = check(pack(documents, PATH, open_bins=2).collect(), texts, tokenizer)
    assert few >= used
    check(pack(documents, PATH, length=64, open_bins=8).collect(), texts, tokenizer, 64)


def test_bins_equal_a_search_of_all_open_sequences():
    r = random.Random(5)
    for most in (1, 2, 7, 40):
        bins, plain = Bins(100, most), []
        for i in range(3000):
            size = r.choice([1, 100, r.randint(1, 100), r.randint(30, 60)])
            got = bins.put((i, size), size)
            want = []
            fits = [f for f, _ in plain if f >= size]
            if fits:
                k = max(j for j, (f, _) in enumerate(plain) if f == min(fits))
                free, own = plain.pop(k)
            else:
                if len(plain) == most:
                    least = min(f for f, _ in plain)
                    want.append(plain.pop(max(j for j, (f, _) in enumerate(plain) if f == least))[1])
                free, own = 100, []
            own = own + [(i, size)]
            if free == size:
                want.append(own)
            else:
                plain.append((free - size, own))
            assert got == want
            assert bins.count == len(plain) <= most
        assert sorted(bins.rest()) == sorted(own for _, own in plain)


def test_odd_rows(odd, empty, tokenizer):
    got = pack(odd, PATH).collect()
    assert len([r for r in got if r.piece == 0]) == odd.count()
    assert sorted(r.length for r in got if r.doc_id in (2, 3)) == [1, 1]
    rest = odd.where("doc_id is null or doc_id <> 5")
    check(pack(rest, PATH).collect(), {r.doc_id: r.text for r in rest.collect()}, tokenizer)
    assert pack(empty, PATH).count() == 0
