import random
import re

import pytest

from lapse.llm.decontamination import clean, contaminated, distances, edit_distance

WORD = re.compile("[0-9A-Za-z\u0080-\U0010ffff]+")


def normal(text):
    return " ".join(WORD.findall(text or "")).translate({c: c + 32 for c in range(65, 91)})


def plain_distance(pattern, text):
    """Least edit distance of the pattern to a part of the text."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
        row = new
    return min(row)


def test_edit_distance_equals_the_plain_dynamic_programme():
    r = random.Random(1)
    for _ in range(200):
        p, t = ("".join(r.choice("abc") for _ in range(r.randint(1, n))) for n in (70, 90))
        d, end = edit_distance(p.encode(), t.encode())
        assert d == plain_distance(p, t) and plain_distance(p, t[:end]) == d


def test_exact_leaks_of_whole_table_and_no_made_up_ones(spark, documents):
    bench = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    items = {r.item_id: normal(r.text) for r in bench.collect()}
    text = {r.doc_id: r.text for r in documents.collect()}
    plain = {d: normal(t) for d, t in text.items()}
    want = {(d, i) for d, t in plain.items() for i, s in items.items() if f" {s} " in f" {t} "}
    got = contaminated(documents, bench).collect()
    assert want <= {(r.doc_id, r.item_id) for r in got} and len(want) > 10
    for r in got:
        span = normal(text[r.doc_id][r.start:r.stop])
        assert r.distance <= 0.2 * len(items[r.item_id].encode())
        assert plain_distance(items[r.item_id].encode(), span.encode()) == r.distance
    gone = {r.doc_id for r in got}
    assert {r.doc_id for r in clean(documents, bench).collect()} == set(text) - gone


@pytest.mark.parametrize("share,least", [(0.05, 0.97), (0.1, 0.9), (0.15, 0.8)])
def test_recall_of_edited_items(spark, share, least):
    r = random.Random(7)
    word = lambda: "".join(r.choice("abcdefghijklmnop") for _ in range(r.choice([2, 3, 5, 6, 7, 9])))
    items = [(i, " ".join(word() for _ in range(40))) for i in range(80)]

    def edit(text):
        out = []
        for w in text.split(" "):
            kind = r.randrange(4) if r.random() < share else 9
            out += {0: [], 1: [word()], 2: [w, word()], 3: [w[::-1]]}.get(kind, [w])
        return " ".join(out)

    docs = [(i, " ".join([*(word() for _ in range(60)), edit(t), *(word() for _ in range(60))])) for i, t in items]
    docs += [(1000 + i, " ".join(word() for _ in range(160))) for i in range(80)]
    inside = {d for d, t in docs[:80] if plain_distance(items[d][1], t) <= 0.2 * len(items[d][1])}
    got = contaminated(spark.createDataFrame(docs, "doc_id long, text string"),
                       spark.createDataFrame(items, "item_id long, text string"), block_chars=6000).collect()
    found = {r.doc_id for r in got if r.doc_id == r.item_id}
    assert found <= inside and len(found) >= least * len(inside) and len(inside) > 40
    assert all(r.doc_id == r.item_id for r in got)


def test_odd_rows(spark, odd, empty):
    schema = "item_id long, text string, n string"
    bench = spark.createDataFrame([(1, None, "a"), (2, "", "b"), (None, "x", None), (3, "?!", ""), (4, "short", ""),
                                   (5, "One two, three four: five six SEVEN", ""), (6, "z" * 30, ""),
                                   (7, "text without a number one two three", "")], schema)
    got = {(r.doc_id, r.item_id, r.distance) for r in contaminated(odd, bench).collect()}
    assert got == {(1, 5, 0), (5, 5, 0), (None, 7, 0)}
    assert contaminated(empty, bench).count() == 0 and contaminated(odd, bench.where("false")).count() == 0
    assert clean(odd, bench).count() == odd.count() - 4
    one = spark.createDataFrame([(1, "before " + "z" * 30 + " after")], "doc_id long, text string")
    assert contaminated(one, bench).count() == 1


@pytest.mark.parametrize("share,least", [(0.1, 0.98), (0.15, 0.98), (0.19, 0.98)])
def test_recall_of_items_with_scattered_character_edits(spark, share, least):
    r = random.Random(13)
    bench = spark.read.parquet("/root/testdata/sf0.1/benchmark.parquet")
    items = [(x.item_id, normal(x.text)) for x in bench.collect()]
    items = [(i, t) for i, t in items if len(t.encode()) >= 80]

    def edit(text):
        out = list(text)
        for p in r.sample(range(len(out)), int(share * len(out))):
            out[p] = r.choice(["", r.choice("abcdefghij"), out[p] + r.choice("abcdefghij")])
        return "".join(out)

    docs = [(i, f"some words before {edit(t)} and some after") for i, t in items]
    got = contaminated(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect()
    own = {x.doc_id for x in got if x.doc_id == x.item_id}
    text, limit = dict(items), lambda t: int(0.19999 * len(t.encode()))
    inside = {d for d, t in docs if edit_distance(text[d].encode(), normal(t).encode())[0] <= limit(text[d])}
    assert len(inside) > 150 and len(own & inside) >= least * len(inside)


def test_items_at_exactly_the_limit_are_found(spark):
    r = random.Random(3)
    text = "".join(r.choice("abcdefghij") for _ in range(100))
    changed = "z" * 20 + text[20:]
    assert plain_distance(text, changed) == 20
    docs = spark.createDataFrame([(1, changed), (2, "zz" + changed[1:].replace(text[20], "z", 1))], "doc_id long, text string")
    got = contaminated(docs, spark.createDataFrame([(7, text)], "item_id long, text string")).collect()
    assert [(x.doc_id, x.item_id, x.distance) for x in got] == [(1, 7, 20)]


def test_distances_of_many_equal_those_of_one():
    import numpy as np
    r = random.Random(4)
    p, t = ([bytes(r.choice(b"abc") for _ in range(r.randint(least, 300))) for _ in range(80)] for least in (1, 0))
    off = np.cumsum([0] + [len(x) for x in t])
    which = np.array([r.randrange(80) for _ in range(80)])
    got = distances(p, which, np.frombuffer(b"".join(t), np.uint8), off[:-1], off[1:])
    assert got.tolist() == [edit_distance(p[w], x)[0] for w, x in zip(which, t)]


@pytest.mark.parametrize("size", [24, 40, 70, 150])
@pytest.mark.parametrize("share,even", [(0.05, False), (0.1, True), (0.15, False), (0.2, True), (0.2, False)])
def test_recall_by_item_size_with_random_and_even_edits(spark, size, share, even):
    """On copies edited otherwise than those that set walks and votes."""
    r = random.Random(size)
    text = lambda n: "".join(r.choice("abcdefghij klmnop") for _ in range(n))
    items = [(i, normal(text(size + 10))[:size].strip()) for i in range(150)]
    items = [(i, t) for i, t in items if len(t) >= 20]

    def edit(t):
        n = int(share * len(t))
        for p in reversed([k * len(t) // n for k in range(n)] if even else sorted(r.sample(range(len(t)), n))):
            t = t[:p] + r.choice(["", "q", t[p] + "u"]) + t[p + 1:]
        return t

    docs = [(i, f"{normal(text(90))} {edit(t)} {normal(text(90))}") for i, t in items]
    got = contaminated(spark.createDataFrame(docs, "doc_id long, text string"),
                       spark.createDataFrame(items, "item_id long, text string")).collect()
    own = {x.doc_id for x in got if x.doc_id == x.item_id}
    words = dict(items)
    inside = {d for d, t in docs if edit_distance(words[d].encode(), normal(t).encode())[0] <= len(words[d]) // 5}
    assert own <= inside and len(inside) > 50 and len(own) >= 0.95 * len(inside)


def test_all_items_of_a_class_set_its_walks_and_votes(monkeypatch):
    from lapse.llm import decontamination as D
    r = random.Random(5)
    items = ["".join(r.choice("abcdefgh ") for _ in range(40)).encode() for _ in range(130)]
    edited, edit = set(), D._edited
    monkeypatch.setattr(D, "_edited", lambda text, *a: edited.add(text) or edit(text, *a))
    D.plan(items, 0.8, 0.98)
    assert edited == set(items)
