"""Entry 3: evaluation of written runs (read_runs -> curves, summary, series).

All runs of an experiment are read as one frame keyed by (experiment,
dataset, model); every table below is one grouped job over all runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapse.conf import EXPERIMENTS, at_k, pretty_label
from lapse.operators import metrics as M
from lapse.sources.io import read_runs

RUN_KEYS = ["experiment", "dataset", "model"]


def run_labels(spark: SparkSession, experiment: str, plot: str, catalogue: dict | None = None) -> DataFrame:
    """Display label per (dataset, model) of an experiment (a few rows)."""
    cat = (catalogue or EXPERIMENTS)[experiment]
    rows = [(experiment, d, m, pretty_label(experiment, d, m, plot, catalogue))
            for d in cat["datasets"] if d != "global" for m in cat["models"] if m != "global"]
    return spark.createDataFrame(rows, "experiment string, dataset string, model string, run_label string")


def evaluate(spark: SparkSession, root: str, experiment: str, plot: str = "precrec",
             catalogue: dict | None = None) -> dict[str, DataFrame]:
    """Curves, confusion matrices and the comparison table of all runs."""
    preds = read_runs(spark, root, experiment)
    k = at_k(experiment, plot, catalogue)
    if k:
        preds = M.head_k(preds, k, RUN_KEYS)
    labels = run_labels(spark, experiment, plot, catalogue)
    both = M.both_classes(preds)
    keys = RUN_KEYS + ["class"]
    out = {
        "roc": M.roc_points(both, keys),
        "precrec": M.pr_points(both, keys),
        "confusion": M.confusion(preds, RUN_KEYS),
        "report": M.class_report(preds, RUN_KEYS),
        "summary": M.summary(preds, RUN_KEYS),
    }
    return {name: df.join(F.broadcast(labels), RUN_KEYS, "left") for name, df in out.items()}
