import hashlib
import zlib

import pytest

from lapse.llm.merkle import every_third, manifest

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def digest(s):
    return hashlib.sha256(s.encode()).hexdigest()


def leaf(r, text):
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}"
                          for v in (r.doc_id, r.source, r.lang, r.n_chars, text)))


def tree(nodes):
    """The root, and for every leaf the (left, right) siblings of each level."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for p, i in zip(paths, at):
            run, k = nodes[i // 8 * 8:i // 8 * 8 + 8], i % 8
            p.append(("".join(run[:k]), "".join(run[k + 1:])))
        at = [i // 8 for i in at]
        nodes = [digest("".join(nodes[i:i + 8])) for i in range(0, len(nodes), 8)]
    return nodes[0], paths


def brute(rows):
    by = {}
    for r in rows:
        by.setdefault(r.lang, []).append(r)
    langs = sorted(by, key=lambda x: (x is not None, (x or "").encode()))
    for x in langs:
        by[x].sort(key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf(r, r.text)))
    low = {x: tree([leaf(r, r.text) for r in by[x]]) for x in langs}
    root, up = tree([low[x][0] for x in langs])
    out = []
    for x, above in zip(langs, up):
        for r, path in zip(by[x], low[x][1]):
            path = path + above
            own = leaf(r, r.text)
            node = own
            if r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 0:
                node = leaf(r, r.text and r.text.translate(LOW))
            for a, b in path:
                node = digest(a + node + b)
            out.append((r.doc_id, own, low[x][0], root, digest("".join(a + b for a, b in path)), node, node == root))
    return out


def rows_of(df):
    return sorted((tuple(r) for r in manifest(df, every_third()).drop("path").collect()), key=repr)


def test_whole_table(documents):
    assert rows_of(documents) == sorted(brute(documents.collect()), key=repr)


@pytest.mark.parametrize("n", [1, 2, 8, 9, 64, 65, 512, 513, 4097])
def test_sizes_around_the_powers_of_the_fan_out(spark, n):
    rows = [(i * 3, f"Text {i}", "en", None, i) for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert rows_of(df) == sorted(brute(df.collect()), key=repr)


def test_many_languages(spark):
    rows = [(i, "A" * (i % 5), f"l{i % 700}" if i % 9 else None, "s", i) for i in range(1500)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert rows_of(df) == sorted(brute(df.collect()), key=repr)


def test_odd_rows(spark):
    rows = [(None, "Text", "en", "a", 4), (None, None, None, None, None), (1, "", "", "", 0), (2, "É:-1" * 9000, "en", "-", 7),
            (2, "É:-1" * 9000, "en", "-", 7), (2, "other", "en", "b", 5), (-3, "MINUS", "fr", None, 5)]
    df = spark.createDataFrame([(*r, "x", "y", 0) for r in rows], "doc_id long, text string, lang string, source string, "
                               "n_chars long, place string, kids string, levels int").repartition(3)
    assert rows_of(df) == sorted(brute(df.collect()), key=repr)
    assert manifest(df).where("not verified").count() == 0
    assert manifest(df.where("false")).count() == 0
