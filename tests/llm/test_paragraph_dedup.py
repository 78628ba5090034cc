import random
import re

from lapse.llm.paragraph_dedup import repeated_passages, without

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def units(text):
    """(place, first char, last char, words) of all paragraphs."""
    out, run = [], []
    text = text or ""
    marks = list(WORD.finditer(text))
    for i, m in enumerate(marks):
        run.append(m)
        end = i + 1 == len(marks) or m.group()[-1] in ".!?" or "\n" in text[m.end():marks[i + 1].start()]
        if end:
            out.append((len(out), run[0].start(), run[-1].end(), [x.group().translate(UPPER) for x in run]))
            run = []
    return out


def brute_force(rows, least=8, run_words=20):
    sets, by = {}, {}
    for d, t in rows:
        for p, a, b, w in units(t):
            if len(w) >= least:
                sets[d, p] = frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4))
                for s in sets[d, p]:
                    by.setdefault(s, set()).add((d, p))
    root = {k: k for k in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, s in sets.items():
        for o in set().union(*(by[x] for x in s)):
            if o > k and 5 * len(s & sets[o]) >= 4 * len(s | sets[o]):
                a, b = sorted((find(k), find(o)))
                root[b] = a
    first = {}
    windows = {}
    for d, t in sorted(rows):
        flat, at = [], []
        for p, _, _, w in units(t):
            at.append(len(flat))
            flat += w
        for p, _, _, w in units(t):
            if len(w) < least:
                for side, i in ((0, at[p]), (1, at[p] + len(w) - least)):
                    if 0 <= i <= len(flat) - least:
                        windows[d, p, side] = side, tuple(flat[i:i + least])
                        first.setdefault((side, tuple(flat[i:i + least])), (d, p))

    def keeper(d, p):
        if (d, p) in sets:
            return find((d, p))
        earlier = [first[windows[d, p, s]] for s in (0, 1) if (d, p, s) in windows]
        return min([e for e in earlier if e != (d, p)], default=(d, p))

    out = set()
    for d, t in rows:
        run = []
        for p, a, b, w in units(t) + [(None, 0, 0, [])]:
            if p is not None and keeper(d, p) != (d, p):
                run.append((a, b, len(w), keeper(d, p)[0]))
                continue
            if run and sum(x[2] for x in run) >= run_words:
                out.add((d, run[0][0], run[-1][1], sum(x[2] for x in run), len(run), run[0][3]))
            run = []
    return out


def test_recall_against_brute_force_on_whole_table(documents):
    want = brute_force([(r.doc_id, r.text) for r in documents.collect()])
    got = {tuple(r) for r in repeated_passages(documents).drop("text_key").collect()}
    # bands miss a pair at the threshold with probability 0.017; nothing may be made up
    lost = {(w[0], x) for w in want for x in range(w[1], w[2])} - {(g[0], x) for g in got for x in range(g[1], g[2])}
    extra = {(g[0], x) for g in got for x in range(g[1], g[2])} - {(w[0], x) for w in want for x in range(w[1], w[2])}
    total = sum(w[2] - w[1] for w in want)
    assert len(want) > 50 and not extra and len(lost) <= 0.01 * total


def test_planted_passage_inside_lines_is_cut(spark):
    r = random.Random(1)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(r.randint(2, 9)))
    sentence = lambda n: " ".join(word() for _ in range(n)).capitalize() + "."
    passage = " ".join(sentence(n) for n in (14, 3, 20, 1, 17))
    rows = [(i, " ".join(sentence(r.randint(4, 20)) for _ in range(6))) for i in range(40)]
    rows = [(i, f"{t} {passage} {sentence(9)}" if i in (5, 9, 30) else t) for i, t in rows]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in repeated_passages(df).collect()}
    assert sorted(got) == [9, 30] and {r.kept_doc_id for r in got.values()} == {5}
    text = dict(rows)
    assert all(text[d][r.start:r.stop] == passage for d, r in got.items())
    left = {r.doc_id: r.text for r in without(df, repeated_passages(df)).collect()}
    assert all(left[d] == (text[d].replace(passage, "") if d in (9, 30) else text[d]) for d in text)


def cut(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return [r.text for r in without(df, repeated_passages(df)).orderBy("doc_id", "text").collect()]


def test_unique_short_lines_between_repeated_ones_stay(spark):
    r = random.Random(5)
    line = lambda n: " ".join("".join(r.choice("abcdefghij") for _ in range(6)) for _ in range(n))
    header, footer = f"{line(30)}\n", f"{line(30)}"
    body = "".join(f"{line(3)}\n" for _ in range(300))
    assert cut(spark, [(1, header + footer), (2, header + body + footer)]) == [header + footer, "\n" + body]


def test_repeated_short_lines_go(spark):
    r = random.Random(6)
    line = lambda n: " ".join("".join(r.choice("abcdefghij") for _ in range(6)) for _ in range(n))
    passage = "\n".join(line(5) for _ in range(30))
    one, two, three = f"{line(4)}\n{passage}\n{line(5)}", f"{line(3)}\n", f"\n{line(12)}"
    assert cut(spark, [(1, one), (2, two + passage + three), (3, passage)]) == [one, two + three, ""]


def test_planted_passages_are_found_and_nothing_unique_is_lost(spark):
    """Passages of 50 to 120 words of sentences and lines of any length."""
    r = random.Random(7)
    word = lambda: "".join(r.choice("abcdefghijkl") for _ in range(r.randint(3, 8)))
    ends = (". ", "? ", "\n", ".\n")
    sentences = lambda n, low, high: [" ".join(word() for _ in range(r.randint(low, high))) + r.choice(ends)
                                      for _ in range(n)]
    rows, planted, own = [], 0, {}
    for g in range(40):
        low, high = ((1, 6), (2, 12), (8, 25))[g % 3]
        passage = sentences(60, low, high)
        n = next(i for i in range(60) if len("".join(passage[:i]).split()) >= 50)
        passage = "".join(passage[:n])
        for c in range(3):
            before, after = "".join(sentences(4, 1, 15)), "".join(sentences(4, 1, 15)).strip()
            rows.append((g * 3 + c, before + passage + after))
            own[g * 3 + c] = (before, passage, after, c)
    r.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    left = {x.doc_id: x.text for x in without(df, repeated_passages(df)).collect()}
    found = 0
    for d, (before, passage, after, c) in own.items():
        assert left[d].startswith(before.rstrip()) and left[d].endswith(after)
        if c:
            found += len(left[d]) <= len(before) + len(after) + 1
        else:
            assert left[d] == before + passage + after
    assert found >= 0.95 * 80


def test_texts_of_one_doc_id_are_cut_each_for_itself(spark):
    r = random.Random(8)
    line = lambda n: " ".join("".join(r.choice("abcdefghij") for _ in range(6)) for _ in range(n)) + "."
    shared, one, two = line(40), line(30), line(50)
    assert cut(spark, [(1, shared), (2, f"{one} {shared}"), (2, two), (2, two)]) == [
        shared, *sorted([f"{one} ", two, two])]


def test_clashing_names(spark):
    text = " ".join(f"w{i}" for i in range(40)) + "."
    schema = "doc_id long, text string, own string, key string, cuts string, version string, start string"
    df = spark.createDataFrame([(1, text, *"abcde"), (2, text, *"fghij")], schema)
    assert [tuple(r) for r in without(df, repeated_passages(df)).orderBy("doc_id").collect()] == [
        (1, text, *"abcde"), (2, "", *"fghij")]


def test_odd_rows(odd, empty):
    assert {r.doc_id for r in repeated_passages(odd).collect()} <= {7}
    assert repeated_passages(empty).count() == 0
    assert without(odd, repeated_passages(odd)).count() == odd.count()
