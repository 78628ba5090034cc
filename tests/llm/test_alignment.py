import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from lapse.llm import alignment as A
from lapse.llm.byte_level import alphabet
from lapse.llm.piece_level import PieceEncoder

A_PATH, B_PATH = public_tokenizers.path(A.A_MODEL), public_tokenizers.path(A.B_MODEL)


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(A_PATH)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B_PATH)
    byte = {c: i for i, c in enumerate(alphabet())}

    def tokens(text):
        ia = a.encode(" " + text, add_special_tokens=False).ids
        ta = [bytes(byte[c] for c in a.id_to_token(i)) for i in ia]
        ib = b.encode(text)
        tb = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()
              for i, p in ((i, b.id_to_piece(i)) for i in ib)]
        if b"".join(ta) != (" " + text).encode() or b"".join(tb) != (" " + text).encode():
            return [], [], [], []
        return ia, np.cumsum([len(t) for t in ta]).tolist(), ib, np.cumsum([len(t) for t in tb]).tolist()

    return tokens


def brute(rows, tokens):
    per, held = [], Counter()
    for doc, text in rows:
        ia, ea, ib, eb = tokens(text) if text else ([], [], [], [])
        groups, links, low = [], [], 0
        for end in sorted(set(ea) & set(eb)):
            ga = [i for i, e in zip(ia, ea) if low < e <= end]
            gb = [i for i, e in zip(ib, eb) if low < e <= end]
            groups.append((ga, gb))
            links += [(x, y) for x in ga for y in gb]
            low = end
        held.update(set(links))
        per.append((doc, ia, ib, groups, links))
    best = {}
    for (x, _), n in held.items():
        best[x] = max(n, best.get(x, 0))
    out = []
    for doc, ia, ib, groups, links in per:
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((doc, len(ia), len(ib), len(groups), len(links), sum(held[p] == best[p[0]] for p in links),
                    sum(held[p] for p in links), hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    return out


def rows_of(df, **options):
    return sorted((tuple(r) for r in A.alignments(df, A_PATH, B_PATH, **options).collect()), key=repr)


def test_whole_table(spark, libraries):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = sorted(brute([(r.doc_id, r.text) for r in docs.collect()], libraries), key=repr)
    assert rows_of(docs) == want
    assert rows_of(docs.repartition(5), block=20_000) == want  # many blocks: the same counts


ODD_TEXTS = ["a  b", "  lead", "trail  ", "a\tb\n\nc", "ﬁ ½ é é", "▁x", "日本 \U0001f600\U0001f600", "x\x00y",
             "<s>hi</s><unk><|endoftext|>", "<0x41>", " 　y", "\r\n", " ", "\n", "1234567", "'s 're x's", "aaaa" * 300,
             " " * 700, "я" * 900, "▁", "�", "€€ 5", "\t" * 300 + " " * 300]


def test_odd_texts(spark, odd, empty, libraries):
    r = random.Random(1)
    alphabet = "aAe zZ  \n\t''sdtreé½ß▁日\U0001f60009.,!<|>"
    texts = ODD_TEXTS + ["".join(r.choice(alphabet) for _ in range(r.randint(1, 60))) for _ in range(300)]
    rows = list(enumerate(texts)) + [(None, None), (None, "text"), (900, ""), (7, "twice"), (7, "twice")]
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, block int, keys string")
    assert rows_of(df) == sorted(brute(rows, libraries), key=repr)
    assert rows_of(odd) == sorted(brute([(x.doc_id, x.text) for x in odd.collect()], libraries), key=repr)
    assert rows_of(empty) == []


def test_large_groups_keep_all_links():
    r = np.random.default_rng(3)
    a, b = r.integers(0, 50, 400), r.integers(0, 60, 500)
    doc = np.repeat([0, 1], 200)
    got, n = A.linked(a, b, doc, np.repeat([0, 1], 250), doc)
    want = Counter()
    for d in (0, 1):
        want.update((d << 31) | int(x) << 15 | int(y) for x in a[200 * d:200 * d + 200] for y in b[250 * d:250 * d + 250])
    assert dict(zip(got.tolist(), n.tolist())) == want and (np.diff(got) > 0).all()


def test_pieces_equal_the_library():
    own, library = PieceEncoder(B_PATH), sentencepiece.SentencePieceProcessor(model_file=B_PATH)
    r = random.Random(4)
    texts = [t for t in ODD_TEXTS if "▁" not in t]
    texts += ["".join(chr(r.choice([r.randrange(32, 127), r.randrange(0x250), r.randrange(0x3040, 0x30FF)]))
                      for _ in range(30)) for _ in range(2000)]
    raw = [(" " + t).encode() for t in texts]
    off = np.concatenate([[0], np.cumsum([len(x) for x in raw])])
    ids, bound = own.tokens(np.frombuffer(b"".join(raw), np.uint8), off)
    for t, i, j in zip(texts, bound[:-1], bound[1:]):
        assert ids[i:j].tolist() == library.encode(t), repr(t)
