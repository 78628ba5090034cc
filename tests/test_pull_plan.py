"""What the pull and the slot aggregation read, evaluate and write on their way."""

import datetime as dt

from fixture_paths import SF_MID
from lapse.operators.sample import drop_search
from lapse.operators.slots import slot_features
from lapse.plans.queries import Ctx
from lapse.sources.fixtures import CONTEXT_NAMES, contexts_from_events


def _events(spark):
    t = dt.datetime(2024, 1, 5, 10, 0, 0, 123)
    props = ['{"k": 11}', '{"k": 12}', '{"k": 0}', '{"k": -1}', '{"j": 3}', "not json", None]
    return spark.createDataFrame([(i, t, i, "view", 1.0, p) for i, p in enumerate(props)],
                                 "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string")


def test_contexts_read_their_number_once(spark):
    plan = drop_search(contexts_from_events(_events(spark)))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("get_json_object") == 2, plan  # the pushed filter's and the projection's


def test_contexts_of_odd_props(spark):
    got = {r["user_id"]: r["play_context_decrypted"] for r in contexts_from_events(_events(spark)).collect()}
    assert got == {"0": "app:search:11", "1": "app:other:12", "2": f"app:{CONTEXT_NAMES[0]}:0", "3": "app:other:-1",
                   "4": None, "5": None, "6": None}
    assert {r["user_id"] for r in drop_search(contexts_from_events(_events(spark))).collect()} == {"1", "2", "3"}


def test_pull_is_not_staged_for_one_reader(spark):
    c = Ctx(spark, SF_MID)
    c.staged_slots()
    assert "parsed" not in c._staged


def test_contexts_do_not_travel_to_the_slots(spark):
    plan = slot_features(Ctx(spark, SF_MID).staged_parsed(), Ctx(spark, SF_MID).s)._jdf.queryExecution().optimizedPlan().toString()
    assert "play_context_decrypted" not in plan.split("Relation [")[0], plan
