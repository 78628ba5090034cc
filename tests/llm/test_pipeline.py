import random

import corpus_pipeline
from lapse.llm.decontamination import contaminated
from lapse.llm.near_dedup import near_duplicates
from lapse.llm.quality import quality_scores

SF = "/root/testdata/sf0.01"


def test_stages_act_on_what_is_left(spark, documents, tmp_path):
    docs = documents
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    left = {}
    for name, step in corpus_pipeline.STAGES:
        step(spark, docs, SF).write.parquet(str(tmp_path / name))
        left[name] = (docs, spark.read.parquet(str(tmp_path / name)))
        docs = left[name][1]
        if name != "packing":
            assert docs.columns == documents.columns
    before, after = left["quality"]
    assert ids(after) == sorted(r.doc_id for r in quality_scores(before, labels).collect() if r.predicted == 1)
    before, after = left["near_dedup"]
    assert ids(after) == sorted(r.doc_id for r in near_duplicates(before, share=corpus_pipeline.SHARE).collect() if r.kept)
    before, after = left["substring_dedup"]
    text = {r.doc_id: r.text for r in before.collect()}
    new = {r.doc_id: r.text for r in after.collect()}
    assert set(text) == set(new) and sum(text[d] != new[d] for d in text) > 5
    assert all(r.n_chars == len(r.text) for r in after.collect())
    before, after = left["decontamination"]
    assert ids(after) == sorted(set(ids(before)) - {r.doc_id for r in contaminated(before, bench).collect()})
    before, after = left["packing"]
    assert {r.doc_id for r in after.collect()} == set(ids(before))


def test_planted_cases(spark, documents, tmp_path):
    """Copies, benchmark passages and repeated passages go; clean documents stay as they are."""
    r = random.Random(11)
    texts = [x.text for x in documents.collect()]
    pool = sorted({w for t in texts[:400] for w in t.replace("\n", " ").split(" ") if w.isalpha() and len(w) > 2})
    sentence = lambda: " ".join(r.choice(pool) for _ in range(r.randint(6, 16))).capitalize() + "."
    make = lambda n: " ".join(sentence() for _ in range(n))
    bench = [x.text for x in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    own = {i: make(25) for i in range(100_000, 100_040)}
    passage = make(7)
    planted = dict(own)
    for i in range(100_000, 100_005):
        planted[i + 1000] = own[i]  # exact copies
        w = own[i].split(" ")
        w[40] = "changed"
        planted[i + 2000] = " ".join(w)  # near copies
    for i in (100_010, 100_011, 100_012):
        planted[i] = own[i] + " " + passage + " " + make(1)
    for i in (100_020, 100_021):
        planted[i] = own[i][:200] + " " + bench[i % 7] + " " + own[i][200:]
    rows = [(i, t, "en", "src1", len(t)) for i, t in planted.items()]
    docs = documents.unionByName(spark.createDataFrame(rows, documents.schema))
    for name, step in corpus_pipeline.STAGES[:-1]:
        step(spark, docs, SF).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
    left = {x.doc_id: x.text for x in docs.collect() if x.doc_id >= 100_000}
    lost = set(own) - set(left) - {100_020, 100_021}
    assert len(lost) <= 1, lost
    assert not any(i >= 101_000 for i in left) and 100_020 not in left and 100_021 not in left
    assert sum(passage in t for t in left.values()) == 1
    clean = [i for i in own if i in left and i not in (100_010, 100_011, 100_012)]
    assert all(left[i] == own[i] for i in clean)


def test_near_dedup_links_from_four_fifths_on(spark):
    own = [f"w{i}" for i in range(304)]  # 300 shingles
    other = own[:100] + ["new"] + own[101:200] + ["new"] + own[201:300] + ["new"] + own[301:]
    for i in (20, 50, 150):
        other[i] = "new"
    sets = [{tuple(w[i:i + 5]) for i in range(len(w) - 4)} for w in (own, other)]
    assert 0.8 <= len(sets[0] & sets[1]) / len(sets[0] | sets[1]) < 0.85
    docs = spark.createDataFrame([(1, " ".join(own)), (2, " ".join(other))], "doc_id long, text string")
    assert [x.doc_id for x in corpus_pipeline.near_dedup(spark, docs, SF).collect()] == [1]
