"""Named queries over the driver's tables, and their SQL oracles.

Each query is ``(spark, sf_dir) -> DataFrame`` and reads the whole tables.
Doubles are rounded to 6 decimals in both engines so that results compare
by value.  ``BASE`` has three prediction days; the label, evaluation and model
queries use ``LABELLED``, one prediction day, in which both churn classes occur
with every event kept (FIXTURES.md section 4).
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from lapse.conf import Settings, resolve
from lapse.operators import explore as X
from lapse.operators import folds as FO
from lapse.operators import labels as L
from lapse.operators import metrics as M
from lapse.operators import prepare as P
from lapse.operators.parse import parse_context
from lapse.operators.sample import add_user_info, filter_raw, sample_users
from lapse.operators.slots import slot_features, top_combination
from lapse.operators.steps import add_iat, add_running_sums, rewindow
from lapse.operators.ranking import with_positions
from lapse.plans import oracle as O
from lapse.plans.model_oracle import gnb_sql
from lapse.schema import MODEL_FEATURES, PARSED_COLS, SUM_COLS
from lapse.session import checkpoint_dir, configure, materialize, register
from lapse.sources.fixtures import load_fixture
from lapse.sources.io import (export_json, read_cv_results, read_examples, read_metrics, read_runs,
                              write_run)

BASE = "26_3d"
SMALL = "12_3d"
LABELLED = "26_1d"
SMALL_LABELLED = "12_1d"
SEED = 42


def settings(dataset: str = BASE, **kw) -> Settings:
    return resolve("fixture_labelled" if dataset.endswith("_1d") else "fixture", dataset, **kw)


# ---------------------------------------------------------------- helpers

def rounded(df: DataFrame, digits: int = O.ROUND) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (DoubleType, FloatType)):
            cols.append((F.round(F.col(f.name).cast("double"), digits) + F.lit(0.0)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


class Ctx:
    """Lazily built frames of one (sf_dir, dataset) pair."""

    def __init__(self, spark: SparkSession, sf_dir: str, dataset: str = BASE):
        configure(spark)
        self.spark = spark
        self.sf_dir = sf_dir
        self.s = settings(dataset)
        t = load_fixture(spark, sf_dir)
        self.plays, self.contexts, self.snapshots = t["plays"], t["contexts"], t["snapshots"]

        self._staged: dict = {}

    def _stage(self, key: str, build) -> DataFrame:
        """Frames reused by several jobs of one query are checkpointed once."""
        if key not in self._staged:
            self._staged[key] = materialize(build())
        return self._staged[key]

    def users_sampled(self) -> DataFrame:
        return sample_users(self.plays, self.contexts, self.snapshots, self.s)

    def users(self, staged: bool = False) -> DataFrame:
        if staged:
            return self._stage("users", self.users)
        return add_user_info(self.users_sampled(), self.snapshots, self.s)

    def raw(self) -> DataFrame:
        return filter_raw(self.plays, self.contexts, self.users(staged=True), self.s)

    def parsed(self) -> DataFrame:
        return parse_context(self.raw())

    def slots(self, fanout: str = "reference") -> DataFrame:
        return slot_features(self._parsed_once(), self.s.with_(fanout=fanout))

    def staged_parsed(self) -> DataFrame:
        return self._stage("parsed", self.parsed)

    def _parsed_once(self) -> DataFrame:
        """The parsed pull for a single reader, which need not wait for a stage."""
        return self._staged["parsed"] if "parsed" in self._staged else self.parsed()

    def staged_slots(self) -> DataFrame:
        return self._stage("slots", lambda: slot_features(self._parsed_once(), self.s))

    def labels(self) -> DataFrame:
        return L.label_churn(self.users(staged=True), self.staged_slots(), self.s)

    def training(self) -> DataFrame:
        return L.training_slots(self.staged_slots(), self.s)

    def filled(self) -> DataFrame:
        return L.zero_fill(self.training(), self.labels(), self.s)

    def normed(self) -> DataFrame:
        f = self.filled()
        return P.normalize(f, P.fit_scaler(f), self.s.zero_std)

    def arrays(self) -> DataFrame:
        tr = self.training()
        return P.to_user_arrays(P.normalize(tr, P.fit_scaler(tr), self.s.zero_std), self.labels(), self.s)

    def predictions(self) -> DataFrame:
        """Baseline churn score: the share of training slots without plays."""
        a = self.arrays()
        score = F.size(F.filter("filled", lambda b: b)) / F.size("filled")
        # staged: numbering reads its input twice, first to find the ranges
        p = self._stage("scores", lambda: a.select("user_id", F.col("churn").alias("label"), score.alias("score")))
        return self._stage("preds", lambda: with_positions(p, [], ["user_id"], name="row_id"))


def _checksums(arrays: DataFrame) -> DataFrame:
    """Per user: slot count, first/last slot and a position-weighted sum of
    every feature array (order-sensitive)."""
    cols = [F.col("user_id"), F.col("churn").cast("bigint").alias("churn"),
            F.size("times").cast("bigint").alias("n_slots"),
            F.element_at("times", 1).alias("first_time"), F.element_at("times", -1).alias("last_time")]
    for f in MODEL_FEATURES:
        weighted = F.zip_with(F.col(f), F.sequence(F.lit(1), F.size(f)), lambda x, i: x * i)
        cols.append(F.aggregate(weighted, F.lit(0.0), lambda a, v: a + v).alias(f"w_{f}"))
    return arrays.select(*cols)


def _checksums_sql(ctes: list[str]) -> str:
    sums = ", ".join(O.rnd(f"SUM(pos * {f})") + f" AS w_{f}" for f in MODEL_FEATURES)
    ctes = ctes + ["ranked AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY time) AS pos FROM normed)"]
    return O.with_sql(ctes, "SELECT r.user_id, CAST(l.churn AS BIGINT) AS churn, COUNT(*) AS n_slots, "
                      "MIN(r.time) AS first_time, MAX(r.time) AS last_time, " + sums +
                      " FROM ranked r JOIN labels l ON r.user_id = l.user_id GROUP BY r.user_id, l.churn")


# ------------------------------------------------------------- queries

def q_active_user_sample(spark, sf):
    return Ctx(spark, sf).users_sampled()


def q_user_info(spark, sf):
    u = Ctx(spark, sf).users()
    return u.withColumn("days_since_registration", F.col("days_since_registration").cast("bigint"))


def q_raw_streams(spark, sf):
    return rounded(Ctx(spark, sf).raw())


def q_parsed_contexts(spark, sf):
    return rounded(Ctx(spark, sf).parsed())


def q_rewindowed_streams(spark, sf):
    c = Ctx(spark, sf)
    return rounded(rewindow(c.parsed(), settings(SMALL)))


def q_inter_arrival(spark, sf):
    c = Ctx(spark, sf)
    return add_iat(c.staged_parsed(), c.s).select("user_id", "timestampp", "secs_played", "play_context_decrypted", "iat")


def q_running_sums(spark, sf):
    c = Ctx(spark, sf)
    return add_running_sums(c.staged_parsed(), c.s).select("user_id", "timestampp", "secs_played",
                                                    "play_context_decrypted", *SUM_COLS)


def q_slot_features_reference(spark, sf):
    return rounded(Ctx(spark, sf).slots("reference"))


def q_slot_features_nofanout(spark, sf):
    return rounded(Ctx(spark, sf).slots("none"))


def q_top_combination(spark, sf):
    c = Ctx(spark, sf)
    return rounded(top_combination(c.staged_parsed(), c.s))


def q_churn_labels(spark, sf):
    lab = Ctx(spark, sf, LABELLED).labels()
    return lab.select("user_id", F.col("days_since_registration").cast("bigint").alias("days_since_registration"),
                      "product", "reporting_country", F.col("churn").cast("bigint").alias("churn"))


def q_training_slots(spark, sf):
    return rounded(Ctx(spark, sf).training())


def q_zero_filled(spark, sf):
    return rounded(Ctx(spark, sf).filled())


def q_normalized(spark, sf):
    return rounded(Ctx(spark, sf).normed().drop("backfill"))


def q_user_arrays(spark, sf):
    return rounded(_checksums(Ctx(spark, sf).arrays()))


def q_split_assignment(spark, sf):
    c = Ctx(spark, sf)
    return P.split(c.labels().select("user_id", F.col("churn").cast("bigint").alias("churn")), c.s.testsize)


def q_undersampled_train(spark, sf):
    c = Ctx(spark, sf, LABELLED)
    train = P.split_tables(c.arrays(), c.s.testsize)["train"]
    return P.undersample_table(train, c.s.retainedshare).select(
        "user_id", F.col("churn").cast("bigint").alias("churn"))


def q_single_period(spark, sf):
    c = Ctx(spark, sf, LABELLED)
    sp = P.to_single_period(c.arrays())
    feats = P.select_features(c.arrays())
    arr = vector_to_array("features")
    return rounded(sp.select("user_id", F.col("churn").cast("bigint").alias("churn"),
                             *[arr[i].alias(f) for i, f in enumerate(feats)]))


def q_multi_period(spark, sf):
    c = Ctx(spark, sf, LABELLED)
    feats = P.select_features(c.arrays())
    mp = P.to_multi_period(c.arrays())
    ex = mp.select("user_id", F.posexplode("sequence").alias("slot_index", "v"))
    return rounded(ex.select("user_id", F.col("slot_index").cast("bigint").alias("slot_index"),
                             *[F.col("v")[i].alias(f) for i, f in enumerate(feats)]))


def q_json_roundtrip(spark, sf):
    c = Ctx(spark, sf, LABELLED)
    path = os.path.join(checkpoint_dir(spark), "json_roundtrip", uuid.uuid4().hex)
    export_json(c.arrays(), path)
    return rounded(_checksums(read_examples(spark, path, MODEL_FEATURES)))


def q_fold_assignment(spark, sf):
    c = Ctx(spark, sf, LABELLED)
    lab = c.labels().select("user_id", F.col("churn").cast("bigint").alias("label"))
    return FO.assign_folds(lab, 2, stratify=True, seed=SEED)


def q_undersample_fold(spark, sf):
    c = Ctx(spark, sf, LABELLED)
    lab = c.labels().select("user_id", F.col("churn").cast("bigint").alias("label"))
    folds = FO.assign_folds(lab, 2, stratify=True, seed=SEED)
    parts = [FO.undersample(folds.where(F.col("fold") != k), 1.0, seed=SEED).withColumn("outer_fold", F.lit(k))
             for k in (0, 1)]
    return parts[0].unionByName(parts[1]).select("outer_fold", "user_id", "label")


def _preds(spark, sf) -> DataFrame:
    return Ctx(spark, sf, LABELLED).predictions()


def q_confusion(spark, sf):
    return rounded(M.confusion(_preds(spark, sf)))


def q_class_report(spark, sf):
    return rounded(M.class_report(_preds(spark, sf)))


def q_roc_points(spark, sf):
    return rounded(M.roc_points(M.both_classes(_preds(spark, sf)), ["class"]))


def q_pr_points(spark, sf):
    return rounded(M.pr_points(M.both_classes(_preds(spark, sf)), ["class"]))


def q_auc_summary(spark, sf):
    return rounded(M.auc_summary(M.both_classes(_preds(spark, sf)), ["class"]))


def q_class_share(spark, sf):
    return rounded(M.class_share(_preds(spark, sf)))


def q_head_k(spark, sf):
    return rounded(M.head_k(_preds(spark, sf), 10))


def q_churn_by_country(spark, sf):
    return rounded(X.churn_by(Ctx(spark, sf, LABELLED).labels(), "reporting_country"))


def q_churn_by_product(spark, sf):
    return rounded(X.churn_by(Ctx(spark, sf, LABELLED).labels(), "product"))


def q_tenure_histogram(spark, sf):
    return X.tenure_histogram(Ctx(spark, sf, LABELLED).labels(), width=10)


def q_feature_trend(spark, sf):
    c = Ctx(spark, sf, LABELLED)
    return rounded(X.feature_trend(c.filled(), c.labels(), ["secs_played", "total_streams", "iat"]))


def q_class_counts(spark, sf):
    return X.class_counts(Ctx(spark, sf, LABELLED).labels())


def q_accuracy(spark, sf):
    return rounded(M.accuracy(_preds(spark, sf)))


def q_user_sample(spark, sf):
    lab = Ctx(spark, sf).labels()
    return X.user_sample(lab, 0.05).select("user_id", F.col("churn").cast("bigint").alias("churn"))


def _rewindowed(spark, sf, dataset, small_dataset):
    c = Ctx(spark, sf, dataset)
    small = settings(small_dataset)
    parsed = rewindow(c.staged_parsed(), small)
    return c, small, slot_features(parsed, small)


def q_rewindowed_slot_features(spark, sf):
    _, _, slots = _rewindowed(spark, sf, BASE, SMALL)
    return rounded(slots)


def q_rewindowed_labels(spark, sf):
    c, small, slots = _rewindowed(spark, sf, LABELLED, SMALL_LABELLED)
    lab = L.label_churn(c.users(staged=True), slots, small)
    return lab.select("user_id", F.col("churn").cast("bigint").alias("churn"))


COUNTRY_LIST = tuple(f"NATION_{i}" for i in range(1, 25, 3))
SUBSET = ("iat", "secs_played", "skip_ratio", "total_streams", "unique_top_types")


def q_hash_sampled_users(spark, sf):
    c = Ctx(spark, sf)
    return sample_users(c.plays, c.contexts, c.snapshots, c.s.with_(shareusers=0.2))


def q_country_sampled_users(spark, sf):
    c = Ctx(spark, sf)
    return sample_users(c.plays, c.contexts, c.snapshots, c.s.with_(countries=COUNTRY_LIST))


def q_dated_snapshot_users(spark, sf):
    """Users against daily snapshots: on odd days the product of the day has a
    suffix and users of odd ids are missing."""
    c = Ctx(spark, sf)
    days = F.explode(F.array(*[F.lit(d) for d in sorted({d for d, _ in c.s.windows.activity_days()} | {c.s.windows.info_date})]))
    odd = F.dayofmonth("date") % 2 == 1
    snaps = c.snapshots.withColumn("date", days).where(~odd | (F.col("user_id").cast("bigint") % 2 == 0))
    snaps = snaps.withColumn("product", F.when(odd, F.concat("product", F.lit("+"))).otherwise(F.col("product")))
    u = add_user_info(sample_users(c.plays, c.contexts, snaps, c.s), snaps, c.s)
    return u.withColumn("days_since_registration", F.col("days_since_registration").cast("bigint"))


def q_feature_subset(spark, sf):
    arrays = Ctx(spark, sf, LABELLED).arrays()
    feats = P.select_features(arrays, SUBSET)
    arr = vector_to_array("features")
    return rounded(P.to_single_period(arrays, SUBSET).select(
        "user_id", F.col("churn").cast("bigint").alias("churn"), *[arr[i].alias(f) for i, f in enumerate(feats)]))


def q_array_values(spark, sf):
    """Every slot of every user's arrays, with its time and fill flag."""
    a = Ctx(spark, sf, LABELLED).arrays()
    each = a.select("user_id", F.posexplode(F.arrays_zip("times", "filled", *MODEL_FEATURES)).alias("slot_index", "v"))
    return rounded(each.select("user_id", F.col("slot_index").cast("bigint").alias("slot_index"),
                               F.col("v.times").alias("time"), F.col("v.filled").alias("filled"),
                               *[F.col(f"v.{f}").alias(f) for f in MODEL_FEATURES]))


def _written_runs(spark, sf) -> str:
    """Two written runs of one experiment: the baseline scores and their squares."""
    preds = _preds(spark, sf)
    root = os.path.join(checkpoint_dir(spark), "runs", uuid.uuid4().hex)
    register(root)
    for model, score in (("plain", F.col("score")), ("square", F.col("score") * F.col("score"))):
        scored = preds.withColumn("score", score)
        r = M.accuracy(scored).first()
        cv = spark.createDataFrame([(0, "{}", float(r["accuracy"]), 1)],
                                   "setting int, params string, mean_test_score double, rank_test_score int")
        write_run(scored, cv, {"accuracy": float(r["accuracy"]), "n": float(r["n"])}, root, "fixture_labelled",
                  LABELLED, model)
    return root


def q_run_head_k(spark, sf):
    """The first 20 predictions of each written run, in input order."""
    runs = read_runs(spark, _written_runs(spark, sf))
    return rounded(M.head_k(runs, 20, ["model"]).select("model", "dataset", "user_id", "label", "score", "row_id"))


def q_run_metrics_read(spark, sf):
    """Metrics and search results of the written runs side by side."""
    root = _written_runs(spark, sf)
    m = read_metrics(spark, root).groupBy("model").pivot("metric", ["accuracy", "n"]).agg(F.max("value"))
    cv = read_cv_results(spark, root).select("model", "mean_test_score")
    return rounded(m.join(cv, "model"))


def q_run_class_scores(spark, sf):
    """One model's written predictions of one class."""
    runs = read_runs(spark, _written_runs(spark, sf), "fixture_labelled", LABELLED, "square")
    return rounded(runs.where(F.col("label") == 1).select("experiment", "dataset", "model", "user_id", "score", "row_id"))


def q_scored_summary(spark, sf):
    return rounded(M.summary(_preds(spark, sf)))


def q_summary_series(spark, sf):
    s = M.summary(_preds(spark, sf).withColumn("group", F.pmod(F.col("row_id"), F.lit(2)).cast("bigint")), ["group"])
    return rounded(M.series(s, "roc_auc", "group"))


def q_score_five_number(spark, sf):
    return rounded(M.five_number(_preds(spark, sf), "score", ["label"]))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}


# ---------------------------------------------------------------- SQL

def _ctes(dataset: str, upto: str, s: Settings | None = None, pull: Settings | None = None) -> list[str]:
    s = s or settings(dataset)
    order = ["sample", "raw", "steps", "slots", "labels", "filled", "normed"]
    ctes = O.base_ctes() + O.sample_ctes(pull or s)
    if order.index(upto) >= 1:
        ctes += O.raw_ctes(s, pull)
    if order.index(upto) >= 2:
        ctes.append(O.steps_cte(s))
    if order.index(upto) >= 3:
        ctes += O.slot_features_ctes(s, fanout=s.fanout == "reference")
    if order.index(upto) >= 4:
        ctes += O.label_ctes(s)
    if order.index(upto) >= 5:
        ctes += O.zero_fill_ctes(s)
    if order.index(upto) >= 6:
        ctes += O.normalized_cte(s.zero_std)
    return ctes


def _slot_cols() -> list[str]:
    from lapse.schema import ANY_COLS, COUNT_COLS, MEAN_STD_COLS
    dbl = [c for m in MEAN_STD_COLS for c in (m, f"{m}_std")] + ["skip_ratio", "latitude", "longitude"]
    ints = ["unique_top_types"] + SUM_COLS + COUNT_COLS
    out = ["user_id", "CAST(time AS BIGINT) AS time"]
    out += [O.rnd(c) + f" AS {c}" for c in dbl]
    out += [f"CAST({c} AS BIGINT) AS {c}" for c in ints]
    out += ["top_type", "platform", "client_type", "backfill"]
    return out


def _parsed_select(src: str = "parsed") -> str:
    cols = []
    for c in PARSED_COLS:
        cols.append(O.rnd(c) + f" AS {c}" if c in ("latitude", "longitude") else c)
    return f"SELECT {', '.join(cols)} FROM {src}"


def _preds_ctes() -> list[str]:
    s = settings(LABELLED)
    n = len(s.windows.training_slots())
    return _ctes(LABELLED, "labels") + [
        "preds AS (SELECT l.user_id, l.churn AS label, "
        f"1.0 - CAST(COUNT(t.user_id) AS DOUBLE) / {n} AS score, "
        "ROW_NUMBER() OVER (ORDER BY l.user_id) - 1 AS row_id "
        "FROM labels l LEFT JOIN training t ON l.user_id = t.user_id GROUP BY l.user_id, l.churn)",
        "both_cls AS (SELECT user_id, label, score, 1 AS class FROM preds UNION ALL "
        "SELECT user_id, 1 - label AS label, 1.0 - score AS score, 0 AS class FROM preds)",
        "per_score AS (SELECT class, score, SUM(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS pos, "
        "SUM(CASE WHEN label = 1 THEN 0 ELSE 1 END) AS neg FROM both_cls GROUP BY class, score)",
        "curve AS (SELECT class, score, pos, neg, "
        "SUM(pos) OVER (PARTITION BY class ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp, "
        "SUM(neg) OVER (PARTITION BY class ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fp, "
        "SUM(pos) OVER (PARTITION BY class) AS P, SUM(neg) OVER (PARTITION BY class) AS N FROM per_score)",
    ]


def _sql_confusion() -> str:
    return O.with_sql(_preds_ctes(), """
        SELECT a.label, a.predicted, CAST(COUNT(p.user_id) AS BIGINT) AS n,
               {share} AS share
        FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) a(label, predicted)
        LEFT JOIN (SELECT user_id, label, CASE WHEN score > 0.5 THEN 1 ELSE 0 END AS predicted FROM preds) p
          ON p.label = a.label AND p.predicted = a.predicted
        LEFT JOIN (SELECT label, COUNT(*) AS tot FROM preds GROUP BY label) t ON t.label = a.label
        GROUP BY a.label, a.predicted, t.tot""".replace(
        "{share}", O.rnd("CASE WHEN t.tot > 0 THEN CAST(COUNT(p.user_id) AS DOUBLE) / t.tot END")))


def _sql_class_report() -> str:
    body = []
    for cls in (0, 1):
        body.append(f"""SELECT {cls} AS class,
            SUM(CASE WHEN label = {cls} AND pred = {cls} THEN 1 ELSE 0 END) AS tp,
            SUM(CASE WHEN pred = {cls} THEN 1 ELSE 0 END) AS pp,
            SUM(CASE WHEN label = {cls} THEN 1 ELSE 0 END) AS support
            FROM (SELECT label, CASE WHEN score > 0.5 THEN 1 ELSE 0 END AS pred FROM preds) x""")
    ctes = _preds_ctes() + ["rep AS (" + " UNION ALL ".join(body) + ")",
                            "rep2 AS (SELECT class, support, "
                            "COALESCE(CAST(tp AS DOUBLE) / NULLIF(pp, 0), 0.0) AS precision, "
                            "COALESCE(CAST(tp AS DOUBLE) / NULLIF(support, 0), 0.0) AS recall FROM rep)"]
    f1 = "CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END"
    return O.with_sql(ctes, f"SELECT class, {O.rnd('precision')} AS precision, {O.rnd('recall')} AS recall, "
                            f"{O.rnd(f1)} AS f1, CAST(support AS BIGINT) AS support FROM rep2")


def _sql_auc() -> str:
    prec = "CAST(tp AS DOUBLE) / (tp + fp)"
    prev = "CASE WHEN (tp - pos) + (fp - neg) > 0 THEN CAST(tp - pos AS DOUBLE) / ((tp - pos) + (fp - neg)) ELSE 1.0 END"
    roc = "CAST(neg AS DOUBLE) * (tp - pos / 2.0) / (CAST(N AS DOUBLE) * P)"
    pr = f"CASE WHEN tp - pos < P THEN pos * ({prec} + {prev}) / 2.0 / P END"
    return O.with_sql(_preds_ctes(), f"SELECT class, {O.rnd(f'SUM({roc})')} AS roc_auc, "
                                     f"{O.rnd(f'SUM({pr})')} AS pr_auc FROM curve GROUP BY class")


def _sql_user_checksums(dataset: str) -> str:
    return _checksums_sql(_ctes(dataset, "normed"))


def _sql_single_period() -> str:
    feats = sorted(MODEL_FEATURES)
    cols = ", ".join(O.rnd(f"AVG({f})") + f" AS {f}" for f in feats)
    return O.with_sql(_ctes(LABELLED, "normed"),
                      f"SELECT n.user_id, CAST(l.churn AS BIGINT) AS churn, {cols} FROM normed n "
                      "JOIN labels l ON n.user_id = l.user_id GROUP BY n.user_id, l.churn")


def _sql_multi_period() -> str:
    feats = sorted(MODEL_FEATURES)
    cols = ", ".join(O.rnd(f) + f" AS {f}" for f in feats)
    return O.with_sql(_ctes(LABELLED, "normed"),
                      "SELECT n.user_id, CAST(ROW_NUMBER() OVER (PARTITION BY n.user_id ORDER BY n.time) - 1 AS BIGINT) "
                      f"AS slot_index, {cols} FROM normed n JOIN labels l ON n.user_id = l.user_id")


def _fold_ctes() -> list[str]:
    h = O.sql_hash_value(f"user_id", "split", seed=SEED)
    return _ctes(LABELLED, "labels") + [
        "lab AS (SELECT user_id, CAST(churn AS BIGINT) AS label FROM labels)",
        f"folds AS (SELECT user_id, label, CAST((ROW_NUMBER() OVER (PARTITION BY label ORDER BY {h}, user_id) - 1) % 2 AS INTEGER) AS fold FROM lab)",
    ]


def _sql_undersample_fold() -> str:
    h = O.sql_hash_value("user_id", "undersample", seed=SEED)
    parts = []
    for k in (0, 1):
        cnt = f"(SELECT label, COUNT(*) AS cnt FROM folds WHERE fold != {k} GROUP BY label)"
        parts.append(f"""
        SELECT {k} AS outer_fold, user_id, label FROM (
          SELECT t.*, ROW_NUMBER() OVER (PARTITION BY label ORDER BY {h}, user_id) - 1 AS pos
          FROM folds t WHERE t.fold != {k}) x
        WHERE label = (SELECT arg_min(label, cnt) FROM {cnt})
           OR pos < CAST(floor((SELECT MIN(cnt) FROM {cnt}) / 1.0) AS BIGINT)""")
    return O.with_sql(_fold_ctes(), " UNION ALL ".join(parts))


def oracle_sql() -> dict[str, str]:
    s = settings()
    s_small = settings(SMALL)
    raw_cols = ("user_id, skipped, secs_played, timestampp, client_type, product_type, platform, hardware, "
                + O.rnd("latitude") + " AS latitude, " + O.rnd("longitude") + " AS longitude, "
                "timestr, play_context_decrypted")
    slot_cols = ", ".join(_slot_cols())
    sq = {}
    sq["active_user_sample"] = O.with_sql(_ctes(BASE, "sample"), "SELECT user_id FROM users_sampled")
    sq["user_info"] = O.with_sql(_ctes(BASE, "sample"),
                                 "SELECT user_id, CAST(days_since_registration AS BIGINT) AS days_since_registration, "
                                 "product, reporting_country FROM users")
    sq["raw_streams"] = O.with_sql(_ctes(BASE, "raw"), f"SELECT {raw_cols} FROM raw")
    sq["parsed_contexts"] = O.with_sql(_ctes(BASE, "raw"), _parsed_select())
    sq["rewindowed_streams"] = O.with_sql(_ctes(BASE, "raw", s=s_small, pull=s), _parsed_select())
    sq["inter_arrival"] = O.with_sql(_ctes(BASE, "steps"),
                                     "SELECT user_id, timestampp, secs_played, play_context_decrypted, "
                                     "CAST(iat AS BIGINT) AS iat FROM steps")
    sq["running_sums"] = O.with_sql(_ctes(BASE, "steps"),
                                    "SELECT user_id, timestampp, secs_played, play_context_decrypted, "
                                    + ", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in SUM_COLS) + " FROM steps")
    sq["slot_features_reference"] = O.with_sql(_ctes(BASE, "slots"), f"SELECT {slot_cols} FROM slotf")
    sq["slot_features_nofanout"] = O.with_sql(_ctes(BASE, "slots", s=s.with_(fanout="none")),
                                              f"SELECT {slot_cols} FROM slotf")
    sq["top_combination"] = O.with_sql(
        _ctes(BASE, "slots"),
        "SELECT user_id, CAST(slot AS BIGINT) AS time, top_type, platform, client_type, "
        f"{O.rnd('latitude')} AS latitude, {O.rnd('longitude')} AS longitude, plays FROM ("
        "SELECT user_id, slot, top_type, platform, client_type, latitude, longitude, plays, "
        "RANK() OVER (PARTITION BY user_id, slot ORDER BY plays DESC) AS rk FROM ("
        "SELECT user_id, slot, top_type, platform, client_type, "
        "CASE WHEN latitude != 999.9 THEN latitude END AS latitude, "
        "CASE WHEN longitude != 999.9 THEN longitude END AS longitude, COUNT(*) AS plays "
        "FROM rowslot GROUP BY 1, 2, 3, 4, 5, 6, 7)) WHERE rk = 1")
    sq["churn_labels"] = O.with_sql(_ctes(LABELLED, "labels"),
                                    "SELECT user_id, CAST(days_since_registration AS BIGINT) AS days_since_registration, "
                                    "product, reporting_country, CAST(churn AS BIGINT) AS churn FROM labels")
    sq["training_slots"] = O.with_sql(_ctes(BASE, "labels"), f"SELECT {slot_cols} FROM training")
    sq["zero_filled"] = O.with_sql(_ctes(BASE, "filled"), f"SELECT {slot_cols} FROM filled")
    sq["normalized"] = O.with_sql(_ctes(BASE, "normed"),
                                  "SELECT user_id, CAST(time AS BIGINT) AS time, "
                                  + ", ".join(O.rnd(f) + f" AS {f}" for f in MODEL_FEATURES) + " FROM normed")
    sq["user_arrays"] = _sql_user_checksums(BASE)
    h_split = O.sql_hash_value("user_id", "split")
    nb = int(1 / s.testsize)
    sq["split_assignment"] = O.with_sql(
        _ctes(BASE, "labels"),
        f"SELECT user_id, CAST(churn AS BIGINT) AS churn, CASE WHEN {h_split} % {nb} = 0 THEN 'test' "
        f"WHEN {h_split} % {nb} = 1 THEN 'val' ELSE 'train' END AS split FROM labels")
    h_us = O.sql_hash_value("user_id", "undersample")
    sq["undersampled_train"] = O.with_sql(
        _ctes(LABELLED, "labels") + [f"tr AS (SELECT * FROM labels WHERE {h_split} % {nb} NOT IN (0, 1))"],
        f"SELECT user_id, CAST(churn AS BIGINT) AS churn FROM tr WHERE churn = 0 AND {h_us} % "
        f"CAST(floor(1.0 / (SELECT SUM(churn) / COUNT(churn) FROM tr) + 0.5) AS BIGINT) < {s.retainedshare} "
        "UNION ALL SELECT user_id, CAST(churn AS BIGINT) AS churn FROM tr WHERE churn = 1")
    sq["single_period"] = _sql_single_period()
    sq["multi_period"] = _sql_multi_period()
    sq["json_roundtrip"] = _sql_user_checksums(LABELLED)
    sq["fold_assignment"] = O.with_sql(_fold_ctes(), "SELECT user_id, label, fold FROM folds")
    sq["undersample_fold"] = _sql_undersample_fold()
    sq["confusion"] = _sql_confusion()
    sq["class_report"] = _sql_class_report()
    sq["roc_points"] = O.with_sql(_preds_ctes(), f"SELECT class, {O.rnd('score')} AS threshold, "
                                                 f"{O.rnd('CAST(fp AS DOUBLE) / N')} AS fpr, "
                                                 f"{O.rnd('CAST(tp AS DOUBLE) / P')} AS tpr FROM curve")
    sq["pr_points"] = O.with_sql(_preds_ctes(), f"SELECT class, {O.rnd('score')} AS threshold, "
                                                f"{O.rnd('CAST(tp AS DOUBLE) / (tp + fp)')} AS precision, "
                                                f"{O.rnd('CAST(tp AS DOUBLE) / P')} AS recall FROM curve "
                                                "WHERE tp - pos < P")
    sq["auc_summary"] = _sql_auc()
    sq["class_share"] = O.with_sql(_preds_ctes(), f"SELECT {O.rnd('AVG(CAST(label AS DOUBLE))')} AS churn_share, "
                                                  "COUNT(*) AS users FROM preds")
    sq["head_k"] = O.with_sql(_preds_ctes(), f"SELECT user_id, label, {O.rnd('score')} AS score, row_id "
                                             "FROM preds WHERE row_id < 10")
    for col, name in (("reporting_country", "churn_by_country"), ("product", "churn_by_product")):
        sq[name] = O.with_sql(_ctes(LABELLED, "labels"),
                              f"SELECT {col}, COUNT(*) AS users, CAST(SUM(churn) AS BIGINT) AS churners, "
                              f"{O.rnd('AVG(CAST(churn AS DOUBLE))')} AS churn_share FROM labels GROUP BY {col}")
    sq["tenure_histogram"] = O.with_sql(
        _ctes(LABELLED, "labels"),
        "SELECT CAST(churn AS BIGINT) AS churn, CAST(floor(days_since_registration / 10.0) * 10 AS BIGINT) AS bucket_start, "
        "COUNT(*) AS users FROM labels GROUP BY 1, 2")
    trend = ["secs_played", "total_streams", "iat"]
    sq["feature_trend"] = O.with_sql(
        _ctes(LABELLED, "filled"),
        "SELECT CAST(l.churn AS BIGINT) AS churn, CAST(f.time AS BIGINT) AS time, "
        + ", ".join(O.rnd(f"AVG(f.{c})") + f" AS {c}" for c in trend)
        + " FROM filled f JOIN labels l ON f.user_id = l.user_id GROUP BY l.churn, f.time")
    sq["class_counts"] = O.with_sql(_ctes(LABELLED, "labels"),
                                    "SELECT CAST(churn AS BIGINT) AS churn, COUNT(*) AS users FROM labels GROUP BY churn")
    sq["accuracy"] = O.with_sql(_preds_ctes(),
                                f"SELECT {O.rnd('AVG(CASE WHEN (CASE WHEN score > 0.5 THEN 1 ELSE 0 END) = label THEN 1.0 ELSE 0.0 END)')} "
                                "AS accuracy, COUNT(*) AS n FROM preds")
    sq["user_sample"] = O.with_sql(_ctes(BASE, "labels"),
                                   f"SELECT user_id, CAST(churn AS BIGINT) AS churn FROM labels "
                                   f"WHERE {O.sql_hash_value('user_id', 'sample')} % 20 = 0")
    sq["rewindowed_slot_features"] = O.with_sql(_ctes(BASE, "slots", s=s_small, pull=s),
                                                f"SELECT {slot_cols} FROM slotf")
    sq["rewindowed_labels"] = O.with_sql(_ctes(LABELLED, "labels", s=settings(SMALL_LABELLED), pull=settings(LABELLED)),
                                         "SELECT user_id, CAST(churn AS BIGINT) AS churn FROM labels")
    for name, kw in (("hash_sampled_users", {"shareusers": 0.2}), ("country_sampled_users", {"countries": COUNTRY_LIST})):
        sq[name] = O.with_sql(O.base_ctes() + O.sample_ctes(s.with_(**kw)), "SELECT user_id FROM users_sampled")
    sq["dated_snapshot_users"] = O.with_sql(O.base_ctes() + O.dated_sample_ctes(s), "SELECT user_id, "
                                            "CAST(days_since_registration AS BIGINT) AS days_since_registration, "
                                            "product, reporting_country FROM users")
    sq["feature_subset"] = O.with_sql(
        _ctes(LABELLED, "normed"), "SELECT n.user_id, CAST(l.churn AS BIGINT) AS churn, "
        + ", ".join(O.rnd(f"AVG({f})") + f" AS {f}" for f in SUBSET)
        + " FROM normed n JOIN labels l ON n.user_id = l.user_id GROUP BY n.user_id, l.churn")
    sq["array_values"] = O.with_sql(
        _ctes(LABELLED, "normed"), "SELECT n.user_id, CAST(ROW_NUMBER() OVER (PARTITION BY n.user_id ORDER BY n.time) - 1 "
        "AS BIGINT) AS slot_index, CAST(n.time AS BIGINT) AS time, f.backfill AS filled, "
        + ", ".join(O.rnd(f"n.{f}") + f" AS {f}" for f in MODEL_FEATURES)
        + " FROM normed n JOIN filled f ON n.user_id = f.user_id AND n.time = f.time")
    runs = _preds_ctes() + ["runs AS (SELECT model, user_id, label, CASE WHEN model = 'plain' THEN score ELSE score * score "
                            "END AS score, row_id FROM preds, (VALUES ('plain'), ('square')) m(model))"]
    sq["run_head_k"] = O.with_sql(runs, f"SELECT model, '{LABELLED}' AS dataset, user_id, label, {O.rnd('score')} AS score, "
                                        "row_id FROM runs WHERE row_id < 20")
    sq["run_class_scores"] = O.with_sql(runs, f"SELECT 'fixture_labelled' AS experiment, '{LABELLED}' AS dataset, model, "
                                              f"user_id, {O.rnd('score')} AS score, row_id FROM runs "
                                              "WHERE model = 'square' AND label = 1")
    acc = O.rnd("AVG(CASE WHEN (CASE WHEN score > 0.5 THEN 1 ELSE 0 END) = label THEN 1.0 ELSE 0.0 END)")
    sq["run_metrics_read"] = O.with_sql(runs, f"SELECT model, {acc} AS accuracy, CAST(COUNT(*) AS DOUBLE) AS n, "
                                              f"{acc} AS mean_test_score FROM runs GROUP BY model")
    sq["scored_summary"] = _sql_summary("f1, pr_auc, precision, recall, roc_auc")
    sq["summary_series"] = _sql_summary("roc_auc", group="row_id % 2")
    sq["score_five_number"] = O.with_sql(_preds_ctes(), "SELECT label, " + ", ".join(
        O.rnd(f"quantile_cont(score, {q})") + f" AS {n}" for n, q in
        (("min", 0), ("q1", 0.25), ("median", 0.5), ("q3", 0.75), ("max", 1))) + " FROM preds GROUP BY label")
    s_lab = settings(LABELLED)
    sq["gnb_nested_cv"] = gnb_sql(_ctes(LABELLED, "normed") + _fold_ctes()[-2:], s_lab.classbalance, SEED)
    return sq


def _sql_summary(cols: str, group: str = "0") -> str:
    """The comparison table, or one of its columns as a series over groups."""
    prec = "CAST(tp AS DOUBLE) / (tp + fp)"
    prev = "CASE WHEN (tp - pos) + (fp - neg) > 0 THEN CAST(tp - pos AS DOUBLE) / ((tp - pos) + (fp - neg)) ELSE 1.0 END"
    order = "OVER (PARTITION BY g, class ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    ctes = _preds_ctes()[:-3] + [
        f"bc AS (SELECT {group} AS g, label, score, 1 AS class FROM preds UNION ALL "
        f"SELECT {group} AS g, 1 - label AS label, 1.0 - score AS score, 0 AS class FROM preds)",
        "ps AS (SELECT g, class, score, SUM(label) AS pos, SUM(1 - label) AS neg FROM bc GROUP BY g, class, score)",
        f"cu AS (SELECT *, SUM(pos) {order} AS tp, SUM(neg) {order} AS fp, SUM(pos) OVER (PARTITION BY g, class) AS P, "
        "SUM(neg) OVER (PARTITION BY g, class) AS N FROM ps)",
        "au AS (SELECT g, class, SUM(CAST(neg AS DOUBLE) * (tp - pos / 2.0) / (CAST(N AS DOUBLE) * P)) AS roc_auc, "
        f"SUM(CASE WHEN tp - pos < P THEN pos * ({prec} + {prev}) / 2.0 / P END) AS pr_auc FROM cu GROUP BY g, class)",
        "co AS (SELECT g, class, SUM(CASE WHEN score > 0.5 THEN label ELSE 0 END) AS t, "
        "SUM(CASE WHEN score > 0.5 THEN 1 ELSE 0 END) AS pp, SUM(label) AS su FROM bc GROUP BY g, class)",
        "pr AS (SELECT g, class, COALESCE(CAST(t AS DOUBLE) / NULLIF(pp, 0), 0.0) AS precision, "
        "COALESCE(CAST(t AS DOUBLE) / NULLIF(su, 0), 0.0) AS recall FROM co)",
        "sm AS (SELECT pr.g, pr.class, precision, recall, CASE WHEN precision + recall > 0 THEN "
        "2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1, roc_auc, pr_auc "
        "FROM pr JOIN au ON pr.g = au.g AND pr.class = au.class)"]
    label = "CASE WHEN class = 1 THEN 'Churned' ELSE 'Retained' END AS label"
    if group != "0":
        return O.with_sql(ctes, f"SELECT CAST(g AS BIGINT) AS \"group\", {label}, {O.rnd(cols)} AS value FROM sm")
    return O.with_sql(ctes, f"SELECT {label}, class, " + ", ".join(f"{O.rnd(c)} AS {c}" for c in cols.split(", ")) + " FROM sm")
