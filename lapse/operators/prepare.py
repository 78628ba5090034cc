"""Normalise, one row per user, split, undersample, model inputs."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, LongType, StructField, StructType

from lapse.conf import Settings
from lapse.functions.buckets import hash_bucket
from lapse.functions.timefn import round_half_away
from lapse.schema import MODEL_FEATURES, SECS_IN_DAY


@dataclass(frozen=True)
class ScalerStats:
    """Population mean and standard deviation per feature."""

    mean: dict
    std: dict


def fit_scaler(slots: DataFrame, features: list[str] | None = None, fit_on: str = "all",
               testsize: float = 0.1, family: str = "sha") -> ScalerStats:
    """Statistics over the real (``backfill = false``) rows.  One aggregation
    job; its single result row (2 numbers per feature) comes to the driver.
    ``fit_on="train"`` uses the users of the training split only (P7); the
    default uses all users, as the original does.  Tasks find their moments in
    numpy; the moments of all tasks are merged by feature."""
    if fit_on not in ("all", "train"):
        raise ValueError(f"unknown fit_on {fit_on!r}")
    feats = list(features or MODEL_FEATURES)
    real = slots.where(~F.col("backfill")) if "backfill" in slots.columns else slots
    if fit_on == "train":
        real = split(real, testsize, family).where(F.col("split") == "train")
    parts = (real.select(*[F.col(f).cast("double").alias(f) for f in feats])
             .mapInArrow(_moments, "feature int, n long, mean double, m2 double"))
    per = parts.groupBy("feature").agg(F.sort_array(F.collect_list(F.struct("mean", "m2", "n"))).alias("p"))
    per = per.select("feature", F.aggregate(F.slice("p", 2, F.size("p")), F.get("p", 0), _merged).alias("t"))
    rows = {r["feature"]: r for r in per.select("feature", "t.mean", F.sqrt(F.col("t.m2") / F.col("t.n")).alias("std"))
            .collect()}
    found = [rows.get(i, {"mean": None, "std": None}) for i in range(len(feats))]
    return ScalerStats({f: r["mean"] for f, r in zip(feats, found)}, {f: r["std"] for f, r in zip(feats, found)})


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One task's number of values, mean and sum of squared differences from it
    of every column.  Differences are taken from the batch's first value, so
    that a constant column has exactly none."""
    out: dict[int, tuple[int, float, float]] = {}
    for batch in batches:
        for i, c in enumerate(batch.columns):
            v = c.drop_null().to_numpy(zero_copy_only=False)
            if not len(v):
                continue
            with np.errstate(all="ignore"):
                n, d = len(v), v - v[0]
                shift = d.mean()
                mean, m2 = v[0] + shift, np.square(d - shift).sum()
                if i in out:
                    n0, mean0, m0 = out[i]
                    delta, n = mean - mean0, n0 + n
                    mean, m2 = mean0 + delta * len(v) / n, m0 + m2 + delta * delta * n0 * len(v) / n
            out[i] = n, float(mean), float(m2)
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(out), pa.int32()), *[pa.array([x[k] for x in out.values()], t)
                                            for k, t in enumerate((pa.int64(), pa.float64(), pa.float64()))]],
        names=["feature", "n", "mean", "m2"])


def _merged(a, b):
    """The moments of two parts together (Chan et al.)."""
    delta, n = b["mean"] - a["mean"], a["n"] + b["n"]
    return F.struct((a["mean"] + delta * b["n"] / n).alias("mean"),
                    (a["m2"] + b["m2"] + delta * delta * a["n"] * b["n"] / n).alias("m2"), n.alias("n"))


def normalize(slots: DataFrame, stats: ScalerStats, zero_std: str = "zero") -> DataFrame:
    """z-score real rows with the fitted statistics; filled rows keep their
    raw zeros (I11, P4).  A constant column (std 0 or NULL) gives 0.0
    (``zero_std="zero"``) or NULL (``"null"``)."""
    has_flag = "backfill" in slots.columns
    cols = [F.col("user_id"), F.col("time")]
    for f, m in stats.mean.items():
        sd = stats.std[f]
        if sd is None or sd == 0 or m is None:
            z = F.lit(0.0) if zero_std == "zero" else F.lit(None).cast("double")
        else:
            z = (F.col(f) - F.lit(float(m))) / F.lit(float(sd))
        if has_flag:
            z = F.when(F.col("backfill"), F.col(f).cast("double")).otherwise(z)
        cols.append(z.alias(f))
    if has_flag:
        cols.append(F.col("backfill"))
    return slots.select(*cols)


def to_user_arrays(norm: DataFrame, labels: DataFrame, s: Settings | None = None,
                   features: list[str] | None = None, fill: bool = True) -> DataFrame:
    """One row per labelled user: ``user_id, churn, times`` and one array per
    feature, ordered by time (I12, E4, G1).

    Slots and labels are brought together by user in one shuffle, sorted by
    time, and the users of an Arrow batch are cut out of it column by column.
    With ``fill=True`` and settings given, missing training slots are filled by
    position with zeros (and flagged in ``filled``) on the way, which equals
    zero-filling before normalising because filled rows keep raw zeros; the long
    users x slots table is then never built.  Users without any slot get
    all-zero arrays, as after zero fill.
    """
    feats = list(features or [c for c in norm.columns if c in set(MODEL_FEATURES)])
    flag = F.col("backfill") if "backfill" in norm.columns else F.lit(False)
    slots = norm.where("user_id is not null").select(
        "user_id", F.lit(None).cast(labels.schema["churn"].dataType).alias("churn"), F.lit(False).alias("_label"),
        F.col("time").cast("long").alias("time"), *[F.col(f).cast("double").alias(f) for f in feats],
        flag.alias("backfill"))
    users = labels.select(
        "user_id", "churn", F.lit(True).alias("_label"), F.lit(None).cast("long").alias("time"),
        *[F.lit(None).cast("double").alias(f) for f in feats], F.lit(None).cast("boolean").alias("backfill"))
    rows = (users.union(slots).repartition("user_id")
            .sortWithinPartitions("user_id", F.col("_label").desc(), "time", *feats, "backfill"))
    schema = StructType([labels.schema["user_id"], labels.schema["churn"], StructField("times", ArrayType(LongType())),
                         *[StructField(f, ArrayType(DoubleType())) for f in feats],
                         StructField("filled", ArrayType(BooleanType()))])
    grid = None
    if fill and s is not None:
        grid = (s.windows.training_slots(), s.windows.first_start, s.windows.width, s.windows.timesplits)
    return rows.mapInArrow(_user_arrays(len(feats), fill, grid), schema)


#: Users whose arrays are sent on together.
_USERS = 512


def _user_arrays(n_feats: int, fill: bool, grid: tuple | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            t = pa.Table.from_batches([batch])
            t = t if rest is None else pa.concat_tables([rest, t])
            t = t.combine_chunks()
            new = _first_rows(t.column(0))
            cut = int(new[-1]) if len(new) else 0  # the last user may go on in the next batch
            yield from _cut_arrays(t.slice(0, cut), new[:-1], n_feats, fill, grid)
            rest = t.slice(cut)
        if rest is not None and len(rest):
            rest = rest.combine_chunks()
            yield from _cut_arrays(rest, _first_rows(rest.column(0)), n_feats, fill, grid)

    return run


def _first_rows(ids: pa.ChunkedArray) -> np.ndarray:
    """Where each user begins; rows without an id are a user together."""
    if not len(ids):
        return np.zeros(0, np.int64)
    names = pc.fill_null(pc.not_equal(ids.slice(1), ids.slice(0, len(ids) - 1)), True).to_numpy(zero_copy_only=False)
    null = ids.is_null().to_numpy()
    return np.flatnonzero(np.append(True, names.astype(bool) & ~(null[1:] & null[:-1])))


def _cut_arrays(t: pa.Table, first: np.ndarray, n_feats: int, fill: bool, grid: tuple | None) -> Iterator[pa.RecordBatch]:
    """The arrays of whole users, whose rows (labels, then slots) begin at ``first``."""
    label = t.column(2).to_numpy().astype(np.int64)
    for a in range(0, len(first), _USERS):
        begin = first[a:a + _USERS]
        until = int(first[a + _USERS]) if a + _USERS < len(first) else len(t)
        n_labels = np.add.reduceat(label[begin[0]:until], begin - begin[0])
        size = np.diff(np.append(begin, until)) - n_labels
        wanted = np.flatnonzero((n_labels > 0) & ((size > 0) | fill))
        if len(wanted):
            yield _arrays_of(t.slice(begin[0], until - begin[0]), (begin - begin[0])[wanted], n_labels[wanted],
                             size[wanted], n_feats, grid)


def _spread(n: np.ndarray, start: np.ndarray) -> np.ndarray:
    """``start[i]``, ``start[i] + 1``, ... (``n[i]`` of them), for all ``i``."""
    return np.arange(n.sum()) + np.repeat(start - np.cumsum(n) + n, n)


def _arrays_of(t: pa.Table, begin: np.ndarray, n_labels: np.ndarray, size: np.ndarray, n_feats: int,
               grid: tuple | None) -> pa.RecordBatch:
    source = _spread(size, begin + n_labels)  # the slots' rows
    ends = np.cumsum(size)
    time = t.column(3).combine_chunks().take(pa.array(source))
    null = (size == 0) & (grid is None)
    if grid is None:
        total, place = size, np.arange(len(source))
    else:
        slots, start, width, splits = grid
        null[np.repeat(np.arange(len(begin)), size)[time.is_null().to_numpy(zero_copy_only=False)]] = True
        past = time.fill_null(start).to_numpy() - start
        at = past // SECS_IN_DAY * splits + np.minimum(past % SECS_IN_DAY // width, splits - 1)
        before = np.append(-1, at[:-1])[:len(at)]
        before[(ends - size)[size > 0]] = -1
        gap = np.maximum(at - before - 1, 0)
        last = np.full(len(size), -1)
        last[size > 0] = at[ends[size > 0] - 1]
        # a slot stands behind all gaps up to it, those of its own user only
        upto = np.append(0, np.cumsum(gap + 1))
        inside = upto[ends] - upto[ends - size]
        total = inside + np.maximum(len(slots) - last - 1, 0)
        total[null] = 0
        keep = np.repeat(~null, size)
        place = (upto[1:] - 1 - np.repeat(upto[ends - size], size) + np.repeat(np.cumsum(total) - total, size))[keep]
        source = source[keep]
    index = np.full(total.sum(), len(t))
    index[place] = source
    index = pa.array(index)
    offsets = pa.array(np.append(0, np.cumsum(total)), pa.int32())
    mask = pa.array(null) if null.any() else None

    def lists(values: pa.Array) -> pa.Array:
        return pa.ListArray.from_arrays(offsets, values, mask=mask)

    if grid is None:
        times = lists(time)
    else:
        n = np.arange(total.sum()) - np.repeat(np.cumsum(total) - total, total)
        times = lists(pa.array(np.append(slots, 0)[np.minimum(n, len(slots))], pa.int64(), mask=n >= len(slots)))
    out = [times]
    for k in range(4, 4 + n_feats):
        out.append(lists(pa.concat_arrays([*t.column(k).chunks, pa.array([0.0])]).take(index)))
    out.append(lists(pa.concat_arrays([*t.column(4 + n_feats).chunks, pa.array([True])]).take(index)))
    # one row per label, nearly always one per user
    rows = pa.array(_spread(n_labels, begin))
    if (n_labels != 1).any():
        user = pa.array(np.repeat(np.arange(len(begin)), n_labels))
        out = [c.take(user) for c in out]
    out = [t.column(k).combine_chunks().take(rows) for k in (0, 1)] + out
    names = [*t.schema.names[:2], "times", *t.schema.names[4:4 + n_feats], "filled"]
    return pa.RecordBatch.from_arrays(out, names=names)


def split(df: DataFrame, testsize: float, family: str = "sha") -> DataFrame:
    """Add ``split``: bucket ``hash(user_id) mod int(1/testsize)``; 0 = test,
    1 = val, the rest train (I13).  ``valsize`` is not read, as in the original."""
    b = hash_bucket("user_id", int(1 / testsize), "split", family)
    return df.withColumn("split", F.when(b == 0, F.lit("test")).when(b == 1, F.lit("val"))
                         .otherwise(F.lit("train")))


def split_tables(df: DataFrame, testsize: float, family: str = "sha") -> dict[str, DataFrame]:
    d = split(df, testsize, family)
    return {k: d.where(F.col("split") == k).drop("split") for k in ("train", "val", "test")}


def undersample_table(train: DataFrame, retainedshare: float, family: str = "sha") -> DataFrame:
    """All churners plus the retained users whose bucket in
    ``round(1 / churn share)`` is below ``retainedshare`` (I14).  The churn
    share is one scalar aggregate computed first."""
    share = train.agg(F.avg(F.col("churn").cast("double")).alias("p")).first()["p"]
    if not share:
        return train.where(F.col("churn") == 1)
    n = int(round_half_away_py(1.0 / share))
    keep = (F.col("churn") == 1) | ((F.col("churn") == 0)
                                    & (hash_bucket("user_id", n, "undersample", family) < F.lit(retainedshare)))
    return train.where(keep)


def round_half_away_py(x: float) -> int:
    import math
    return int(math.floor(x + 0.5)) if x >= 0 else -int(math.floor(-x + 0.5))


def select_features(df: DataFrame, names: list[str] | tuple = ()) -> list[str]:
    """Feature columns to use, sorted by name (the original reads JSON keys in
    sorted order); an empty list means all (B12)."""
    skip = {"user_id", "churn", "times", "filled", "split", "fold", "row_id"}
    cols = [c for c in df.columns if c not in skip]
    if names:
        cols = [c for c in cols if c in set(names)]
    return sorted(cols)


def to_single_period(arrays: DataFrame, features: list[str] | tuple = (),
                     ignore_filled: bool = False) -> DataFrame:
    """Per-user mean of every feature over all slots, filled ones included
    (I15, P5) -> ``features`` vector.  ``ignore_filled=True`` averages real
    slots only."""
    feats = select_features(arrays, features)
    means = []
    for f in feats:
        if ignore_filled:
            pairs = F.arrays_zip(F.col(f).alias("v"), F.col("filled").alias("b"))
            kept = F.filter(pairs, lambda p: ~p["b"])
            tot = F.aggregate(kept, F.lit(0.0), lambda a, p: a + p["v"])
            means.append(F.when(F.size(kept) > 0, tot / F.size(kept)).otherwise(F.lit(0.0)))
        else:
            tot = F.aggregate(F.col(f), F.lit(0.0), lambda a, v: a + v)
            means.append(tot / F.size(f))
    keep = [c for c in ("user_id", "churn", "split", "fold", "row_id") if c in arrays.columns]
    return arrays.select(*keep, array_to_vector(F.array(*means)).alias("features"))


def to_multi_period(arrays: DataFrame, features: list[str] | tuple = ()) -> DataFrame:
    """Users x slots x features: ``sequence`` = array (per slot) of feature
    arrays, and ``features`` = the same flattened slot-major into one vector
    for models without recurrence (I16)."""
    feats = select_features(arrays, features)
    zipped = F.arrays_zip(*[F.col(f) for f in feats])
    seq = F.transform(zipped, lambda e: F.array(*[e[f] for f in feats]))
    keep = [c for c in ("user_id", "churn", "split", "fold", "row_id") if c in arrays.columns]
    return arrays.select(*keep, seq.alias("sequence"),
                         array_to_vector(F.flatten(seq)).alias("features"))


__all__ = ["ScalerStats", "fit_scaler", "normalize", "to_user_arrays", "split", "split_tables",
           "undersample_table", "select_features", "to_single_period", "to_multi_period",
           "round_half_away"]
