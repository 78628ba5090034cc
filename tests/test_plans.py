"""Entry points: dataset creation (sampling once), export, training runs, evaluation."""
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from fixture_paths import SF_MID
from lapse.conf import resolve
from lapse.plans.datasets import build_datasets, export_splits, fixture_sources
from lapse.plans.evaluation import evaluate
from lapse.plans.training import train_run
from lapse.sources.io import read_cv_results, read_examples, read_metrics, run_folder


@pytest.fixture(scope="module")
def datasets(spark):
    src = fixture_sources(spark, SF_MID)
    return build_datasets(src, "fixture_labelled")


def test_sample_once_and_windows(datasets):
    assert list(datasets) == ["26_1d", "12_1d"]
    big, small = datasets["26_1d"], datasets["12_1d"]
    assert big.users.count() == small.users.count()
    n_small = len(small.settings.windows.training_slots())
    assert n_small == (12 - 3) * 3
    assert small.arrays.where(F.size("times") != n_small).count() == 0
    assert small.slots.agg(F.min("time")).first()[0] >= small.settings.windows.first_start


def test_export_roundtrip(spark, datasets):
    out = tempfile.mkdtemp(prefix="lapse-export-")
    paths = export_splits(datasets["26_1d"], out)
    assert set(paths) == {"tr", "te", "val", "trus"}
    back = read_examples(spark, paths["tr"])
    tr = datasets["26_1d"].splits()["train"]
    assert back.count() == tr.count()
    assert set(back.columns) >= {"user_id", "churn", "times", "secs_played"}


def test_train_and_evaluate(spark, datasets):
    root = tempfile.mkdtemp(prefix="lapse-runs-")
    ds = datasets["26_1d"]
    for model, grid in (("rf", {"n_estimators": [5]}), ("lr", {"C": [1.0], "penalty": ["l2"], "class_weight": [None]})):
        s = resolve("fixture_labelled", "26_1d", model)
        preds, cv, metrics = train_run(ds.arrays, model, s, grid=grid, out=root)
        assert preds.count() == ds.arrays.count()
        assert 0 <= metrics["roc_auc"] <= 1
    assert os.path.isdir(run_folder(root, "predictions", "fixture_labelled", "26_1d", "rf"))
    tables = evaluate(spark, root, "fixture_labelled", "roc")
    summ = tables["summary"].collect()
    assert {(r["model"], r["label"]) for r in summ} == {(m, l) for m in ("rf", "lr") for l in ("Churned", "Retained")}
    assert all(r["run_label"] for r in summ)
    assert tables["roc"].count() > 0 and tables["confusion"].count() == 8
    # the first predictions of a run in input order, where a plot asks for them
    import copy
    from lapse.conf import EXPERIMENTS
    cat = copy.deepcopy(EXPERIMENTS)
    cat["fixture_labelled"]["plots"]["precrec"] = {"at_k": 7}
    first = evaluate(spark, root, "fixture_labelled", "precrec", catalogue=cat)["confusion"]
    assert {r["s"] for r in first.groupBy("model").agg(F.sum("n").alias("s")).collect()} == {7}
    cv = read_cv_results(spark, root)
    assert {"split0_test_score", "split1_train_score", "std_fit_time", "std_test_score"} <= set(cv.columns)
    assert cv.where("rank_test_score = 1").count() >= 4
    assert {(r.model, r.metric) for r in read_metrics(spark, root).collect()} == {
        (m, k) for m in ("rf", "lr") for k in ("roc_auc", "pr_auc")}
    from lapse.operators.metrics import series
    ser = series(tables["summary"], "f1", "dataset", ["model"]).collect()
    assert len(ser) == 4


def test_svd_run(spark, datasets):
    s = resolve("fixture_labelled", "26_1d", "rf").with_(dimred=4)
    preds, _, _ = train_run(datasets["26_1d"].arrays, "rf", s, grid={"n_estimators": [5]})
    assert preds.count() == datasets["26_1d"].arrays.count()
