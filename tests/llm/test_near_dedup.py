import re

from lapse.llm.near_dedup import near_duplicates, one_of_each

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def shingles(text, size=5):
    w = WORD.findall((text or "").translate(UPPER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1)))


def brute_force(rows, share=(85, 100)):
    sets = {d: shingles(t) for d, t in rows}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    by = {}
    for d, s in sets.items():
        for x in s:
            by.setdefault(x, set()).add(d)
    seen = set()
    for d, s in sets.items():
        for e in set().union(*(by[x] for x in s)) if s else ():
            if d < e and (d, e) not in seen:
                seen.add((d, e))
                i, u = len(s & sets[e]), len(s | sets[e])
                if share[1] * i >= share[0] * u:
                    a, b = sorted((find(d), find(e)))
                    root[b] = a
    return {d: (len(s), find(d)) for d, s in sets.items()}


def test_matches_brute_force_on_whole_table(documents):
    want = brute_force([(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()])
    got = near_duplicates(documents).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    assert sum(not r.kept for r in got) > 50


def test_group_of_many_near_copies_is_linked_by_blocks(spark):
    # each text differs from its neighbours only: no hub is linked to all
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(words[3 * i: 3 * i + 60])) for i in range(100)]
    rows += [(1000 + i, " ".join(f"v{i}x{j}" for j in range(30))) for i in range(20)]
    want = brute_force(rows)
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want


def test_odd_rows(odd, empty):
    got = sorted((r.doc_id or 0, r.n_shingles, r.component_id, r.kept) for r in near_duplicates(odd).collect()
                 if r.doc_id != 7 and r.doc_id is not None)
    assert got == [(1, 3, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 0, 4, True), (5, 3, 1, False),
                   (5, 3, 1, False), (6, 1, 6, True), (8, 1, 6, False)]
    none = [r for r in near_duplicates(odd).collect() if r.doc_id is None]
    assert [(r.component_id, r.kept) for r in none] == [(None, True)]
    assert near_duplicates(empty).count() == 0


def spread(n, *changed):
    """A text of ``n`` words, some of them changed."""
    return " ".join(f"c{i}" if i in changed else f"w{i}" for i in range(n))


def test_texts_of_one_doc_id_are_one_node(spark):
    a, b, c = spread(80), " ".join(f"x{i}" for i in range(60)), " ".join(f"y{i}" for i in range(60))
    rows = [(1, a), (2, a), (2, b), (3, b), (4, c), (5, spread(80, 79)), (6, c), (7, c), (7, b), (9, "alone"), (9, "")]
    got = {(r.doc_id, r.component_id, r.kept) for r in near_duplicates(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(1, 1, True), *((d, 1, False) for d in (2, 3, 4, 5, 6, 7)), (9, 9, True)}


def test_one_of_each_keeps_every_text_of_a_repeated_doc_id(spark):
    a, b = spread(80), " ".join(f"x{i}" for i in range(60))
    schema = "doc_id long, text string, gone string, key string, number string, node string"
    rows = [(1, a), (2, a), (2, b), (2, b), (3, b), (4, spread(80, 79)), (5, None), (5, None), (None, a)]
    df = spark.createDataFrame([(*r, "g", "k", "n", "o") for r in rows], schema)
    got = sorted(((str(r.doc_id), r.text) for r in one_of_each(df, (4, 5)).collect()), key=str)
    assert got == sorted([("1", a), ("2", b), ("5", None), ("None", a)], key=str)
    unique = df.where("doc_id in (1, 3, 4)")
    assert sorted(r.doc_id for r in one_of_each(unique, (4, 5)).collect()) == [1, 3]
    assert one_of_each(df, (4, 5)).columns == df.columns
