"""DuckDB SQL of the model runs that have a closed form."""

from __future__ import annotations

from lapse.functions.buckets import sql_hash_value
from lapse.operators.bayes import SMOOTHING
from lapse.operators.ml import GRIDS
from lapse.plans import oracle as O
from lapse.schema import MODEL_FEATURES


def _train_sql(k: int, ratio: float, seed: int) -> str:
    """Undersampled training rows of outer fold ``k`` with their inner fold."""
    count = f"(SELECT label, COUNT(*) AS n FROM folds WHERE fold != {k} GROUP BY label)"
    keep = f"pos < CAST(floor((SELECT MIN(n) FROM {count}) / {float(ratio)}) AS BIGINT)" if ratio else "true"
    return f"""
    SELECT {k} AS k, user_id, label, {sql_hash_value('user_id', 'split', seed=seed + 1)} % 2 AS part FROM (
      SELECT t.*, ROW_NUMBER() OVER (PARTITION BY label ORDER BY {sql_hash_value('user_id', 'undersample', seed=seed)}, user_id) - 1 AS pos
      FROM folds t WHERE t.fold != {k}) WHERE label = (SELECT arg_min(label, n) FROM {count}) OR {keep}"""


def gnb_sql(ctes: list[str], ratio: float, seed: int) -> str:
    """Nested cross-validation of Gaussian naive Bayes.  ``ctes`` end with
    ``normed`` (slot rows), ``lab`` and ``folds``."""
    feats = sorted(MODEL_FEATURES)
    priors = ", ".join(f"({i}, {'NULL' if p is None else f'ln({p[1]}::DOUBLE / {p[0]})'})"
                       for i, p in enumerate(GRIDS["gnb"]["priors"]))
    score = "CASE WHEN z < -700 THEN 0.0 ELSE 1 / (1 + exp(-z)) END"
    return O.with_sql(ctes + [
        "wide AS MATERIALIZED (SELECT user_id, " + ", ".join(f"AVG({f}) AS {f}" for f in feats) + " FROM normed GROUP BY user_id)",
        f"long AS MATERIALIZED (SELECT user_id, i, v FROM (UNPIVOT wide ON {', '.join(feats)} INTO NAME i VALUE v))",
        "train AS MATERIALIZED (" + " UNION ALL ".join(_train_sql(k, ratio, seed) for k in (0, 1)) + ")",
        # fit j = 0, 1 leaves that inner fold out, 2 is the refit on all
        "fitted AS (SELECT k, j, user_id, label FROM train, (VALUES (0), (1), (2)) f(j) WHERE part != j)",
        "share AS (SELECT k, j, ln(SUM(label)::DOUBLE / SUM(1 - label)) AS odds FROM fitted GROUP BY k, j)",
        "each AS (SELECT k, j, label, i, AVG(v) AS m, VAR_POP(v) AS s FROM fitted JOIN long USING (user_id) GROUP BY ALL)",
        f"floors AS (SELECT k, j, {SMOOTHING} * MAX(s) AS s FROM (SELECT k, j, i, VAR_POP(v) AS s FROM fitted "
        "JOIN long USING (user_id) GROUP BY ALL) GROUP BY k, j)",
        "par AS (SELECT a.k, a.j, a.i, a.m AS m0, b.m AS m1, a.s + f.s AS s0, b.s + f.s AS s1 FROM each a "
        "JOIN each b ON a.k = b.k AND a.j = b.j AND a.i = b.i AND a.label = 0 AND b.label = 1 "
        "JOIN floors f ON f.k = a.k AND f.j = a.j)",
        "rows AS (SELECT k, j, user_id, label, part FROM train, (VALUES (0), (1)) f(j) UNION ALL "
        "SELECT fold AS k, 2 AS j, user_id, label, NULL AS part FROM folds)",
        "evidence AS MATERIALIZED (SELECT k, j, user_id, label, part, SUM(0.5 * ln(s0 / s1) + (v - m0) * (v - m0) / (2 * s0) "
        "- (v - m1) * (v - m1) / (2 * s1)) AS e FROM rows JOIN long USING (user_id) JOIN par USING (k, j, i) GROUP BY ALL)",
        f"prior(setting, odds) AS (VALUES {priors})",
        "scored AS (SELECT k, j, user_id, label, part, setting, e + COALESCE(prior.odds, share.odds) AS z "
        "FROM evidence JOIN share USING (k, j), prior)",
        f"tested AS (SELECT k, j, setting, SUM(CASE WHEN ({score} > 0.5) = (label = 1) THEN 1 ELSE 0 END)::DOUBLE / COUNT(*) AS a "
        "FROM scored WHERE part = j GROUP BY k, j, setting)",
        "best AS (SELECT k, setting FROM (SELECT k, setting, ROW_NUMBER() OVER (PARTITION BY k ORDER BY SUM(a) DESC, setting) AS r "
        "FROM tested GROUP BY k, setting) WHERE r = 1)",
        "numbered AS (SELECT user_id, ROW_NUMBER() OVER (ORDER BY user_id) - 1 AS row_id FROM lab)"],
        f"SELECT user_id, CAST(label AS INTEGER) AS label, {O.rnd(score)} AS score, CAST(k AS INTEGER) AS fold, row_id "
        "FROM scored JOIN best USING (k, setting) JOIN numbered USING (user_id) WHERE j = 2")
