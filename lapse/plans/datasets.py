"""Entry 1: dataset creation (sample -> parse -> features -> labels -> prepare).

All steps compose lazily into one lineage; the stage boundaries of the
original (one warehouse table per step, one query per slot) disappear.  The
only shuffles of the event rows are the context join, the (user, slot)
partitioning of the step/slot features and the per-user grouping.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from lapse.conf import Settings, dataset_order, resolve
from lapse.operators import labels as L
from lapse.operators import prepare as P
from lapse.operators.parse import parse_context
from lapse.operators.sample import add_user_info, filter_raw, sample_users
from lapse.operators.slots import slot_features
from lapse.operators.steps import rewindow
from lapse.session import materialize
from lapse.sources.fixtures import load_fixture
from lapse.sources.io import export_json


@dataclass
class Sources:
    plays: DataFrame
    contexts: DataFrame
    snapshots: DataFrame


def fixture_sources(spark: SparkSession, sf_dir: str) -> Sources:
    t = load_fixture(spark, sf_dir)
    return Sources(t["plays"], t["contexts"], t["snapshots"])


def users_of(src: Sources, s: Settings) -> DataFrame:
    """Sampled users with their info (I1 + I2)."""
    return add_user_info(sample_users(src.plays, src.contexts, src.snapshots, s), src.snapshots, s)


def parsed_streams(src: Sources, users: DataFrame, s: Settings, base: Settings | None = None) -> DataFrame:
    """Raw pull + parse (I3 + I4); a dataset other than the base one is cut
    from the base pull (I5)."""
    pull = base or s
    parsed = parse_context(filter_raw(src.plays, src.contexts, users, pull))
    if base is not None and base.dataset != s.dataset:
        parsed = rewindow(parsed, s)
    return parsed


def slot_table(parsed: DataFrame, s: Settings) -> DataFrame:
    """Parsed streams -> slot features over all slots (I6 + I7)."""
    return slot_features(parsed, s)


@dataclass
class Dataset:
    settings: Settings
    users: DataFrame      # sampled users with info
    slots: DataFrame      # slot features, all slots
    labels: DataFrame     # users + churn
    training: DataFrame   # slot features cut to the training slots
    arrays: DataFrame     # one row per user, normalised, zero-filled by position
    scaler: P.ScalerStats | None = None

    def splits(self) -> dict[str, DataFrame]:
        return P.split_tables(self.arrays, self.settings.testsize, self.settings.hash_family)


def build_dataset(src: Sources, s: Settings, users: DataFrame | None = None,
                  base: Settings | None = None, fit: bool = True,
                  pulled: DataFrame | None = None) -> Dataset:
    """Build one dataset.  ``users`` reuses a sample taken for a longer
    dataset; ``base`` is that dataset's settings and ``pulled`` its parsed
    pull (re-windowed here).  The parsed pull is written once (the
    original's ``_p`` table): the slot aggregation and the combination
    count both read it, and every smaller dataset is cut from it.

    The sampled users and the slot features are written once under the
    shared checkpoint folder (both feed several jobs: the raw pull, labels,
    the scaler fit and the arrays).  ``fit=True`` runs the scaler
    aggregation; the arrays stay lazy.
    """
    users = users if users is not None else materialize(users_of(src, s))
    if pulled is None:
        pulled = materialize(parsed_streams(src, users, base or s))
    parsed = rewindow(pulled, s) if base is not None and base.dataset != s.dataset else pulled
    slots = materialize(slot_table(parsed, s))
    labels = L.label_churn(users, slots, s)
    training = L.training_slots(slots, s)
    scaler = P.fit_scaler(training) if fit else None
    norm = P.normalize(training, scaler, s.zero_std) if scaler else training
    arrays = P.to_user_arrays(norm, labels, s)
    return Dataset(s, users, slots, labels, training, arrays, scaler)


def build_datasets(src: Sources, experiment: str, catalogue: dict | None = None, **overrides) -> dict[str, Dataset]:
    """All datasets of an experiment; users are sampled once, with the
    dataset of the longest window, and reused by the others."""
    order = dataset_order(experiment, catalogue)
    base = resolve(experiment, order[0], catalogue=catalogue, **overrides)
    users = materialize(users_of(src, base))
    pulled = materialize(parsed_streams(src, users, base))
    out = {}
    for name in order:
        s = resolve(experiment, name, catalogue=catalogue, **overrides)
        out[name] = build_dataset(src, s, users=users, base=base, pulled=pulled)
    return out


def export_splits(ds: Dataset, path: str) -> dict[str, str]:
    """JSON-lines export of the train, undersampled train, test and val
    tables (A6); returns the written paths."""
    from lapse.operators.prepare import undersample_table
    sp = ds.splits()
    tables = {"tr": materialize(sp["train"]), "te": sp["test"], "val": sp["val"]}
    tables["trus"] = undersample_table(tables["tr"], ds.settings.retainedshare, ds.settings.hash_family)
    out = {}
    for name, df in tables.items():
        p = f"{path.rstrip('/')}/features_{ds.settings.experiment}_{ds.settings.dataset}_{name}"
        export_json(df, p)
        out[name] = p
    return out
