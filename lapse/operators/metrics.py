"""Evaluation tables as Spark jobs.

Predictions are a DataFrame with ``label`` (0/1) and ``score`` (probability
of churn), plus any key columns (run id, experiment, dataset, model).  All
metrics are computed per key group in one pass over all runs.

Curves: rows are aggregated per distinct score, running totals by
descending score come from :func:`running_totals` (range partitions, no
single-task window).  Areas need no neighbour lookups: the previous point of
a threshold is its own running total minus its own counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lapse.operators.ranking import running_totals


def for_class(preds: DataFrame, cls: int) -> DataFrame:
    """View the predictions from one class: the retained class (0) uses
    1 - label and 1 - score."""
    if cls == 1:
        return preds
    return preds.withColumns({"label": 1 - F.col("label"), "score": 1.0 - F.col("score")})


def both_classes(preds: DataFrame) -> DataFrame:
    """Predictions stacked for both classes with a ``class`` key column."""
    return (for_class(preds, 1).withColumn("class", F.lit(1))
            .unionByName(for_class(preds, 0).withColumn("class", F.lit(0))))


def curve_counts(preds: DataFrame, keys: list[str] = ()) -> DataFrame:
    """Per key group and distinct score (descending): ``pos``, ``neg`` at the
    score, cumulative ``tp``, ``fp`` at threshold = score, and totals ``P``,
    ``N`` of the group (F4)."""
    keys = list(keys)
    per_score = preds.groupBy(*keys, "score").agg(
        F.sum(F.when(F.col("label") == 1, 1).otherwise(0)).cast("bigint").alias("pos"),
        F.sum(F.when(F.col("label") == 1, 0).otherwise(1)).cast("bigint").alias("neg"))
    cum = running_totals(per_score, keys, [F.col("score").desc()], ["pos", "neg"], totals="_all_")
    return cum.withColumnsRenamed({"cum_pos": "tp", "cum_neg": "fp", "_all_pos": "P", "_all_neg": "N"})


def roc_points(preds: DataFrame, keys: list[str] = ()) -> DataFrame:
    """One ROC point per distinct score: threshold, fpr, tpr."""
    c = curve_counts(preds, keys)
    return c.select(*keys, F.col("score").alias("threshold"),
                    F.try_divide(F.col("fp"), F.col("N")).alias("fpr"),
                    F.try_divide(F.col("tp"), F.col("P")).alias("tpr"))


def pr_points(preds: DataFrame, keys: list[str] = ()) -> DataFrame:
    """Precision-recall points for the thresholds up to the first one that
    reaches full recall (the (recall 0, precision 1) end point is implied)."""
    c = curve_counts(preds, keys)
    return c.where(F.col("tp") - F.col("pos") < F.col("P")).select(
        *keys, F.col("score").alias("threshold"),
        F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        F.try_divide(F.col("tp"), F.col("P")).alias("recall"))


def auc_summary(preds: DataFrame, keys: list[str] = (), ap: str = "trapezoid") -> DataFrame:
    """ROC AUC and PR AUC per key group.

    ROC AUC = sum over distinct scores of (neg/N) * (tp - pos/2) / P.
    PR AUC (``ap="trapezoid"``, the default of the pinned library version):
    trapezoids between consecutive points, starting at (recall 0,
    precision 1); ``ap="step"`` gives sum (pos/P) * precision.
    """
    keys = list(keys)
    c = curve_counts(preds, keys)
    prec = F.col("tp") / (F.col("tp") + F.col("fp"))
    ptp = F.col("tp") - F.col("pos")
    pfp = F.col("fp") - F.col("neg")
    prev_prec = F.when(ptp + pfp > 0, ptp / (ptp + pfp)).otherwise(F.lit(1.0))
    roc_term = F.try_divide(F.col("neg") * (F.col("tp") - F.col("pos") / 2.0), F.col("N") * F.col("P"))
    if ap == "step":
        pr_term = F.try_divide(F.col("pos") * prec, F.col("P"))
    else:
        pr_term = F.when(ptp < F.col("P"),
                         F.try_divide(F.col("pos") * (prec + prev_prec) / 2.0, F.col("P").cast("double")))
    return c.groupBy(*keys).agg(F.sum(roc_term).alias("roc_auc"), F.sum(pr_term).alias("pr_auc"))


def predicted(preds: DataFrame, threshold: float = 0.5) -> F.Column:
    """Scores above the threshold are class 1 (``<= 0.5`` -> 0)."""
    return F.when(F.col("score") > F.lit(threshold), F.lit(1)).otherwise(F.lit(0))


def confusion(preds: DataFrame, keys: list[str] = (), threshold: float = 0.5) -> DataFrame:
    """Confusion counts per (label, predicted) with the row-normalised share
    (E7); all four cells are present, zeros included."""
    keys = list(keys)
    p = preds.withColumn("predicted", predicted(preds, threshold))
    cells = p.groupBy(*keys).agg(*[
        F.sum(F.when((F.col("label") == a) & (F.col("predicted") == b), 1).otherwise(0)).cast("bigint")
        .alias(f"c{a}{b}") for a in (0, 1) for b in (0, 1)])
    cells = cells.select(*keys, F.explode(F.array(*[
        F.struct(F.lit(a).alias("label"), F.lit(b).alias("predicted"), F.col(f"c{a}{b}").alias("n"),
                 F.try_divide(F.col(f"c{a}{b}").cast("double"), F.col(f"c{a}0") + F.col(f"c{a}1")).alias("share"))
        for a in (0, 1) for b in (0, 1)])).alias("cell"))
    return cells.select(*keys, "cell.*")


def class_report(preds: DataFrame, keys: list[str] = (), threshold: float = 0.5) -> DataFrame:
    """Precision, recall, F1 and support per class at the threshold."""
    keys = list(keys)
    p = preds.withColumn("predicted", predicted(preds, threshold))

    def count(cond):
        return F.sum(F.when(cond, 1).otherwise(0))

    # both classes from one pass over the predictions
    per_class = F.explode(F.array(*[F.struct(
        F.lit(cls).alias("class"), F.col(f"tp{cls}").alias("tp"), F.col(f"pp{cls}").alias("pp"),
        F.col(f"support{cls}").alias("support")) for cls in (0, 1)]))
    r = p.groupBy(*keys).agg(*[c for cls in (0, 1) for c in (
        count((F.col("label") == cls) & (F.col("predicted") == cls)).alias(f"tp{cls}"),
        count(F.col("predicted") == cls).alias(f"pp{cls}"), count(F.col("label") == cls).alias(f"support{cls}"))])
    r = r.select(*keys, per_class.alias("c")).select(*keys, "c.*")
    prec = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("pp")), F.lit(0.0))
    rec = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("support")), F.lit(0.0))
    r = r.withColumns({"precision": prec, "recall": rec})
    f1 = F.when(F.col("precision") + F.col("recall") > 0,
                2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))).otherwise(0.0)
    return r.select(*keys, "class", "precision", "recall", f1.alias("f1"),
                    F.col("support").cast("bigint").alias("support"))


def accuracy(preds: DataFrame, keys: list[str] = (), threshold: float = 0.5) -> DataFrame:
    """Share of correct predictions at the threshold."""
    ok = (predicted(preds, threshold) == F.col("label")).cast("double")
    return preds.groupBy(*keys).agg(F.avg(ok).alias("accuracy"), F.count(F.lit(1)).alias("n"))


def class_share(preds: DataFrame, keys: list[str] = ()) -> DataFrame:
    """Share of churners per group."""
    return preds.groupBy(*keys).agg(F.avg(F.col("label").cast("double")).alias("churn_share"),
                                    F.count(F.lit(1)).alias("users"))


def head_k(preds: DataFrame, k: int, keys: list[str] = (), by: str = "row_id") -> DataFrame:
    """First ``k`` predictions of every group: by input position (``row_id``,
    numbered from 0 in every group, as the original) or by descending score
    (``by="score"``).  Positions are a filter; scores are cut to ``k`` rows a
    group in every task before the groups meet."""
    if by != "score":
        return preds.where(F.col("row_id") < k)
    order = [F.col("score").desc(), F.col("row_id")]
    if not keys:
        return preds.orderBy(*order).limit(k)
    own = Window.partitionBy(*keys).orderBy(*order)
    return preds.withColumn("_pos", F.row_number().over(own)).where(F.col("_pos") <= k).drop("_pos")


def summary(preds: DataFrame, keys: list[str] = ()) -> DataFrame:
    """Run comparison: per key group and class, F1, precision, recall at 0.5
    and PR AUC, ROC AUC (L14).  One job over all runs."""
    keys = list(keys)
    both = both_classes(preds).withColumnRenamed("class", "_view")
    k2 = keys + ["_view"]
    rep = class_report(both, k2).where(F.col("class") == F.lit(1)).drop("class", "support")
    aucs = auc_summary(both, k2)
    lab = F.when(F.col("_view") == 1, F.lit("Churned")).otherwise(F.lit("Retained"))
    return rep.join(aucs, k2, "inner").withColumn("label", lab).select(
        *keys, "label", F.col("_view").alias("class"), "f1", "pr_auc", "precision", "recall", "roc_auc")


def series(summary_df: DataFrame, metric: str, x: str, keys: list[str] = ()) -> DataFrame:
    """One metric against a setting (dataset, ratio, components) per key."""
    return summary_df.select(*keys, x, "label", F.col(metric).alias("value")).orderBy(*keys, "label", x)


def quantiles(df: DataFrame, col: str, probabilities: dict[str, float], keys: list[str] = ()) -> DataFrame:
    """Exact quantiles of a column per group, interpolated between neighbours,
    as columns named by ``probabilities``; null values do not count.

    Selection by rank: equal values are counted together, running totals over
    written range buckets give every value the positions it covers, and the
    value at a position is picked by an aggregate.  No task holds a group's
    values, however many there are."""
    keys = list(keys)
    counted = df.groupBy(*keys, F.col(col).cast("double").alias("_v")).agg(
        F.sum(F.when(F.col(col).isNull(), 0).otherwise(1)).cast("bigint").alias("_n"))
    ranked = running_totals(counted, keys, [F.col("_v").asc_nulls_first()], ["_n"], totals="_all")
    before = F.col("cum__n") - F.col("_n")
    out = {}
    for name, p in probabilities.items():
        at = (F.col("_all_n") - 1) * F.lit(float(p))

        def value(position, at=at):
            return F.max(F.when((before <= position) & (position < F.col("cum__n")), F.col("_v")))

        low, high = F.floor(at), F.ceil(at)
        out[name] = F.when(F.max(high) == F.max(low), value(low)).otherwise(
            (F.max(high) - F.max(at)) * value(low) + (F.max(at) - F.max(low)) * value(high))
    return ranked.groupBy(*keys).agg(*[c.alias(n) for n, c in out.items()])


def five_number(df: DataFrame, col: str, keys: list[str] = ()) -> DataFrame:
    """Exact min, quartiles, median and max of a column per group (box-plot
    input, e.g. ``mean_test_score`` of the searches; E9)."""
    return quantiles(df, col, {"min": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "max": 1.0}, keys)
