"""Spark queries against their DuckDB oracles on the smallest fixture."""
import sys

import duckdb
import pytest

from fixture_paths import SF_SMALL

sys.path.insert(0, ".")
import tools_check  # noqa: E402
import __spark_entry__ as E  # noqa: E402

FAST = ["active_user_sample", "user_info", "raw_streams", "parsed_contexts", "rewindowed_streams",
        "inter_arrival", "running_sums", "slot_features_reference", "slot_features_nofanout",
        "top_combination", "churn_labels", "training_slots", "zero_filled", "normalized", "user_arrays",
        "split_assignment", "fold_assignment", "undersample_fold", "auc_summary", "pr_points", "confusion",
        "single_period", "churn_by_country", "tenure_histogram"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("events", "customer", "nation"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert tools_check.digest(rows, df.columns)[0] == tools_check.digest(orows, ocols)[0]


def test_every_query_registered():
    q, s = E.queries(), E.oracle_sql()
    assert set(s) <= set(q)
    assert len(q) >= 40


def test_entry(spark):
    df = E.entry(spark)
    assert "total_streams" in df.columns and df.count() > 0
