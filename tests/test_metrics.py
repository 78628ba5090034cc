"""Curves and areas on seven scored rows with ties (FIXTURES.md 5.5)."""
import pytest

from lapse.operators import metrics as M

ROWS = [("u1", 1, 0.9), ("u2", 0, 0.8), ("u3", 1, 0.8), ("u4", 0, 0.6), ("u5", 1, 0.4), ("u6", 0, 0.4),
        ("u7", 0, 0.1)]


@pytest.fixture(scope="module")
def preds(spark):
    return spark.createDataFrame([(u, l, s, i) for i, (u, l, s) in enumerate(ROWS)],
                                 "user_id string, label int, score double, row_id long")


def test_auc(preds):
    r = M.auc_summary(preds).first()
    assert r["roc_auc"] == pytest.approx(0.75)
    assert r["pr_auc"] == pytest.approx(7 / 9)
    assert M.auc_summary(preds, ap="step").first()["pr_auc"] == pytest.approx(13 / 18)


def test_roc_points(preds):
    pts = sorted((r["fpr"], r["tpr"]) for r in M.roc_points(preds).collect())
    flat = [x for p in pts for x in p]
    assert flat == pytest.approx([0, 1 / 3, 0.25, 2 / 3, 0.5, 2 / 3, 0.75, 1.0, 1.0, 1.0])


def test_pr_points_stop_at_full_recall(preds):
    pts = sorted((r["recall"], r["precision"]) for r in M.pr_points(preds).collect())
    flat = [x for p in pts for x in p]
    assert flat == pytest.approx([1 / 3, 1.0, 2 / 3, 0.5, 2 / 3, 2 / 3, 1.0, 0.5])


def test_confusion_and_report(preds):
    cells = {(r["label"], r["predicted"]): r["n"] for r in M.confusion(preds).collect()}
    assert cells == {(0, 0): 2, (0, 1): 2, (1, 0): 1, (1, 1): 2}
    rep = {r["class"]: r for r in M.class_report(preds).collect()}
    assert rep[1]["precision"] == pytest.approx(0.5) and rep[1]["recall"] == pytest.approx(2 / 3)
    assert rep[1]["f1"] == pytest.approx(2 * 0.5 * (2 / 3) / (0.5 + 2 / 3))
    assert rep[0]["support"] == 4
    assert M.accuracy(preds).first()["accuracy"] == pytest.approx(4 / 7)


def test_retained_class_view(preds):
    both = {r["class"]: r for r in M.auc_summary(M.both_classes(preds), ["class"]).collect()}
    assert both[0]["roc_auc"] == pytest.approx(0.75)


def test_head_k(preds):
    assert [r["user_id"] for r in M.head_k(preds, 3).orderBy("row_id").collect()] == ["u1", "u2", "u3"]
    top = {r["user_id"] for r in M.head_k(preds, 2, by="score").collect()}
    assert top == {"u1", "u2"}


def test_summary(preds):
    s = {r["label"]: r for r in M.summary(preds.withColumn("model", preds.user_id.substr(0, 0)), ["model"]).collect()}
    assert set(s) == {"Churned", "Retained"}


def test_five_number(spark):
    df = spark.createDataFrame([(float(x),) for x in [1, 2, 3, 4, 5]], "v double")
    r = M.five_number(df, "v").first()
    assert (r["min"], r["q1"], r["median"], r["q3"], r["max"]) == (1.0, 2.0, 3.0, 4.0, 5.0)
