import random
import re

from lapse.llm.license_rules import GATE, rules
from lapse.llm.licenses import BASE, scan

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def base(text):
    words = WORD.findall((text or "").translate(LOWER))
    places, labels = [], set()
    for phrase, label in BASE.items():
        p = phrase.split(" ")
        found = [i for i in range(len(words)) if words[i:i + len(p)] == p]
        places += found
        labels |= {label} if found else set()
    return (len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels)))


def expected_labels(text):
    """Base labels and those of rules that suppression leaves, by brute force."""
    norm = " " + " ".join(WORD.findall((text or "").translate(LOWER))) + " "
    found = [(m.start(), m.end(), p, label) for label, p, keyword, pattern in rules() if keyword in norm
             for m in re.finditer(pattern, norm)] if any(g in norm for g in GATE) else []
    left = [d for d in found if not any(
        e != d and e[0] <= d[0] and d[1] <= e[1] and e[2] >= d[2] and (
            (e[0], e[1]) != (d[0], d[1]) or e[2] > d[2] or e[3] < d[3]) for e in found)]
    return ",".join(sorted({d[3] for d in left} | set(filter(None, base(text)[4].split(",")))))


def check(df):
    rows = {r.doc_id: r for r in scan(df).collect()}
    for r in df.collect():
        got = rows[r.doc_id]
        assert (got.n_words, got.n_base, got.first_word, got.last_word, got.base_labels) == base(r.text), r.text[:300]
        assert got.labels == expected_labels(r.text), r.text[:300]
        assert 0 <= got.score <= 1 and (got.score > 0) == bool(got.labels)
    return rows


def test_whole_table(documents):
    rows = check(documents)
    assert sum(bool(r.labels) for r in rows.values()) > 20 and sum(r.n_base for r in rows.values()) > 5


def test_mixed_license_texts(spark):
    r = random.Random(5)
    parts = ["under the MIT License", "Apache License, Version 2.0", "CC-BY-NC 4.0", "cc by nc", "GNU GPL v3 or later",
             "under the MIT license under the mit license", "GNU Lesser General Public License version 2.1",
             "SPDX-License-Identifier: BSD-3-Clause", "All rights reserved.", "Mozilla Public License 2.0", "É", "İ K ſ",
             "Permission is hereby granted, free of charge, to any person obtaining a copy of this software", "x\x00y",
             "This work is licensed under the GNU General Public License, version 3.", "word", "CC0 1.0 Universal", "\n",
             "Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License", "日本 licence"]
    rows = [(i, " ".join(r.choice(parts) for _ in range(r.randint(0, 12)))) for i in range(250)]
    rows += [(1000, "under the mit license " * 3000), (1001, "gpl v3 " * 900 + "lgpl 2.1 or later " * 300)]
    check(spark.createDataFrame(rows, "doc_id long, text string"))


def test_rules_and_native_plan(documents, odd, empty):
    assert len(rules()) >= 300 and len({x[0] for x in rules()}) > 60
    assert all(re.compile(p) for _, _, _, p in rules())
    df = scan(odd)
    assert df.count() == odd.count() and scan(empty).count() == 0
    assert all((r.n_words, r.labels, r.score) == (0, "", 0.0) for r in df.where("doc_id in (2, 3, 4)").collect())
    plan = scan(documents)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "Exchange"))


def some_match(tree, r):
    """A random string that a parsed expression matches."""
    out = ""
    for op, arg in tree:
        name = str(op)
        if name == "LITERAL":
            out += chr(arg)
        elif name in ("MAX_REPEAT", "MIN_REPEAT"):
            out += "".join(some_match(arg[2], r) for _ in range(r.randint(arg[0], min(arg[1], arg[0] + 2))))
        elif name == "SUBPATTERN":
            out += some_match(arg[3], r)
        elif name == "BRANCH":
            out += some_match(r.choice(arg[1]), r)
        elif name == "IN":
            kind, value = r.choice(arg)
            out += chr(value) if str(kind) == "LITERAL" else "7" if "NOT" not in str(value) else "x"
        else:
            assert name == "ASSERT", name
    return out


def test_every_match_passes_gate_and_keyword():
    r = random.Random(4)
    for label, _, keyword, pattern in rules():
        tree = re._parser.parse(pattern)
        for _ in range(60):
            text = f" {some_match(tree, r)} "
            assert re.search(pattern, text), (label, text)
            assert keyword in text and any(g in text for g in GATE), (label, keyword, text)


def test_names_and_identifiers_without_another_gate_word(spark):
    texts = ["Distributed as BSD-3-Clause.", "MPL-2.0", "GFDL 1.3", "Open Database License", "Academic Free License 3.0",
             "Open Software License 3.0", "Open Data Commons Attribution License", "Under the GPL."]
    got = {x.doc_id: x for x in scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    want = ["bsd-3", "mpl-2", "gfdl-1.3", "odbl-1", "afl-3", "osl-3", "odc-by-1", "gpl"]
    assert [label in str(got[i]) for i, label in enumerate(want)] == [True] * len(want), got
