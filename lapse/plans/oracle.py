"""DuckDB SQL for the named queries (the correctness oracle).

The SQL follows the original pipeline's formulation, not the Spark plans:
one sub-query per activity day joined by UNION, slots attached by a range
join against the generated slot list, the literal many-to-many join of
rows and combinations for the slot aggregates, per-user window functions
for ``iat`` and running sums, NOT IN / IN sub-queries for labels and
zero fill.  Tables are the pre-registered views of the driver.
"""

from __future__ import annotations

import datetime as dt

from lapse.conf import Settings
from lapse.functions.buckets import sql_hash_value
from lapse.functions.contexts import sql_parse_context
from lapse.schema import (ANY_COLS, COUNT_COLS, MEAN_STD_COLS, MODEL_FEATURES, SEARCH_PATTERN,
                          SECS_COLS, SECS_IN_DAY, SUM_COLS, TOP_TYPES)
from lapse.sources.fixtures import CLIENTS, CONTEXT_NAMES, PLATFORMS, REGISTRATION_BASE

ROUND = 6


def rnd(expr: str, digits: int = ROUND) -> str:
    return f"(round(CAST({expr} AS DOUBLE), {digits}) + 0.0)"


def _pick(expr: str, values: list[str]) -> str:
    cases = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {expr} {cases} END"


def _d(d: dt.date) -> str:
    return f"DATE '{d.isoformat()}'"


def base_ctes() -> list[str]:
    """plays, contexts and snapshots derived from the driver tables."""
    return [
        f"ev AS (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)",
        "plays AS (SELECT CAST(user_id AS VARCHAR) AS user_id, "
        "strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS time, "
        "CAST(floor(value * 1000 + 0.5) AS BIGINT) AS ms_played, (event_id % 4 = 0) AS skipped, "
        f"{_pick('k % 2', CLIENTS)} AS client_type, event_type AS product_type, "
        f"{_pick('k % 3', PLATFORMS)} AS platform, 'device-' || CAST(k % 4 AS VARCHAR) AS hardware, "
        "CASE WHEN k % 10 = 0 THEN NULL ELSE k - 50.0 END AS latitude, "
        "CASE WHEN k % 10 = 0 THEN NULL ELSE 2.0 * k - 100 END AS longitude, "
        "CAST(ts AS DATE) AS date FROM ev)",
        "contexts AS (SELECT CAST(user_id AS VARCHAR) AS user_id, "
        "strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS time, "
        f"'app:' || {_pick('k % 13', CONTEXT_NAMES)} || ':' || CAST(k AS VARCHAR) AS play_context_decrypted, "
        "CAST(ts AS DATE) AS date FROM ev)",
        "snap AS (SELECT CAST(c_custkey AS VARCHAR) AS user_id, "
        f"strftime(DATE '{REGISTRATION_BASE}' - CAST(c_custkey % 120 AS INTEGER), '%Y-%m-%d') AS registration_date, "
        "c_mktsegment AS product, n_name AS reporting_country "
        "FROM customer JOIN nation ON c_nationkey = n_nationkey)",
    ]


def _epoch(col: str) -> str:
    return f"CAST(floor(epoch(CAST({col} AS TIMESTAMP))) AS BIGINT)"


def sample_ctes(s: Settings) -> list[str]:
    """users_sampled (I1) and users."""
    w = s.windows
    share = int(1 / s.shareusers)
    parts = []
    for day, start in w.activity_days():
        conds = [
            f"p.date = {_d(day)}",
            f"p.ms_played > {s.significant_ms}",
            "p.platform IN (" + ", ".join(f"'{x}'" for x in s.platforms) + ")",
            f"{sql_hash_value('p.user_id', 'sample')} % {share} = 0",
            f"date_diff('day', CAST(u.registration_date AS DATE), {_d(day)}) > {s.obsdays}",
            f"{_epoch('p.time')} >= {start}",
            f"{_epoch('p.time')} < {start + SECS_IN_DAY}",
            f"c.play_context_decrypted NOT LIKE '{SEARCH_PATTERN}'",
        ]
        if s.countries is not None:
            conds.append("u.reporting_country IN (" + ", ".join(f"'{x}'" for x in s.countries) + ")")
        parts.append(
            "SELECT DISTINCT p.user_id FROM plays p "
            "JOIN contexts c ON p.user_id = c.user_id AND p.time = c.time AND p.date = c.date "
            "JOIN snap u ON p.user_id = u.user_id WHERE " + " AND ".join(conds))
    info = w.info_date
    return [
        "users_sampled AS (" + " UNION ".join(parts) + ")",
        "users AS (SELECT us.user_id, "
        f"date_diff('day', CAST(u.registration_date AS DATE), {_d(info)}) AS days_since_registration, "
        "u.product, u.reporting_country FROM users_sampled us JOIN snap u ON us.user_id = u.user_id)",
    ]


def dated_sample_ctes(s: Settings) -> list[str]:
    """Sample and info against daily snapshots: odd days lack odd users and
    carry a product suffix."""
    days = sorted({d for d, _ in s.windows.activity_days()} | {s.windows.info_date})
    listed = ", ".join(f"({_d(d)})" for d in days)
    sample, users = sample_ctes(s)
    odd = "CAST(date_part('day', v.date) AS INTEGER) % 2 = 1"
    snaps = ("snap2 AS (SELECT u.user_id, u.registration_date, v.date, u.reporting_country, "
             f"CASE WHEN {odd} THEN u.product || '+' ELSE u.product END AS product "
             f"FROM snap u, (VALUES {listed}) v(date) WHERE NOT ({odd}) OR CAST(u.user_id AS BIGINT) % 2 = 0)")
    sample = sample.replace("JOIN snap u ON p.user_id = u.user_id", "JOIN snap2 u ON p.user_id = u.user_id AND p.date = u.date")
    users = users.replace("JOIN snap u ON us.user_id = u.user_id",
                          f"JOIN snap2 u ON us.user_id = u.user_id AND u.date = {_d(s.windows.info_date)}")
    return [snaps, sample, users]


def raw_ctes(s: Settings, pull: Settings | None = None) -> list[str]:
    """raw (I3) and parsed (I4) for the pull settings; ``s`` re-windows."""
    pull = pull or s
    dates = pull.windows.raw_dates()
    top, sub = sql_parse_context("play_context_decrypted")
    ctes = [
        "raw AS (SELECT p.user_id, p.skipped, CAST((p.ms_played + 500) // 1000 AS BIGINT) AS secs_played, "
        f"{_epoch('p.time')} AS timestampp, p.client_type, p.product_type, p.platform, p.hardware, "
        "p.latitude, p.longitude, p.time AS timestr, c.play_context_decrypted "
        "FROM plays p JOIN contexts c ON p.user_id = c.user_id AND p.time = c.time AND p.date = c.date "
        f"WHERE p.date BETWEEN {_d(min(dates))} AND {_d(max(dates))} "
        "AND p.user_id IN (SELECT user_id FROM users) AND p.ms_played > 0 "
        f"AND c.play_context_decrypted NOT LIKE '{SEARCH_PATTERN}')",
        "parsed0 AS (SELECT user_id, COALESCE(timestampp, 0) AS timestampp, COALESCE(skipped, false) AS skipped, "
        "COALESCE(secs_played, 0) AS secs_played, play_context_decrypted, "
        f"{top} AS top_type, {sub} AS sub_type, platform, "
        "COALESCE(CAST(latitude AS DOUBLE), 999.9) AS latitude, "
        "COALESCE(CAST(longitude AS DOUBLE), 999.9) AS longitude, client_type FROM raw)",
    ]
    if pull.dataset != s.dataset:
        lo, hi = s.windows.rewindow_bounds
        ctes.append(f"parsed AS (SELECT * FROM parsed0 WHERE timestampp >= {lo} AND timestampp <= {hi})")
    else:
        ctes.append("parsed AS (SELECT * FROM parsed0)")
    return ctes


def _case_secs(c: str, src: str = "") -> str:
    if c == "secs_played":
        return f"{src}secs_played"
    t = next(t for t in TOP_TYPES if f"secs_played_{t.lower()}" == c)
    return f"CASE WHEN {src}top_type = '{t}' THEN {src}secs_played ELSE 0 END"


ORDER = "timestampp, secs_played, play_context_decrypted"


def steps_cte(s: Settings) -> str:
    """Per-row iat and running sums over each user's whole history (F1, F2)."""
    w = s.windows
    win = f"PARTITION BY user_id ORDER BY {ORDER}"
    cols = [f"timestampp - LAG(timestampp, 1, {w.iat_start}) OVER ({win}) AS iat"]
    for c, sc in zip(SECS_COLS, SUM_COLS):
        cols.append(f"COALESCE(SUM({_case_secs(c)}) OVER ({win} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS {sc}")
    return "steps AS (SELECT *, " + ", ".join(cols) + " FROM parsed)"


def slots_list_cte(s: Settings, name: str = "slot_list", training: bool = False) -> str:
    w = s.windows
    slots = w.training_slots() if training else w.all_slots()
    rows = []
    for t in slots:
        day0 = w.first_start + ((t - w.first_start) // SECS_IN_DAY) * SECS_IN_DAY
        end = t + w.width
        if end > day0 + SECS_IN_DAY or (t - day0) // w.width == w.timesplits - 1:
            end = day0 + SECS_IN_DAY
        rows.append(f"({t}, {end})")
    return f"{name}(slot_start, slot_end) AS (VALUES " + ", ".join(rows) + ")"


def slot_features_ctes(s: Settings, fanout: bool = True) -> list[str]:
    """The original's per-slot aggregation with the literal many-to-many join
    (``fanout=True``) or without it."""
    inner = ("SELECT r.*, sl.slot_start AS slot FROM steps r JOIN slot_list sl "
             "ON r.timestampp >= sl.slot_start AND r.timestampp < sl.slot_end")
    ctes = [slots_list_cte(s), f"rowslot AS ({inner})"]
    ctes.append(
        "topf AS (SELECT user_id, slot, top_type, platform, client_type, "
        "CASE WHEN latitude != 999.9 THEN latitude ELSE NULL END AS latitude, "
        "CASE WHEN longitude != 999.9 THEN longitude ELSE NULL END AS longitude "
        "FROM rowslot GROUP BY user_id, slot, top_type, platform, client_type, latitude, longitude)")
    if fanout:
        src = "rowslot r JOIN topf t ON r.user_id = t.user_id AND r.slot = t.slot"
    else:
        src = ("rowslot r JOIN (SELECT user_id, slot, MIN(top_type) AS top_type, MIN(platform) AS platform, "
               "MIN(client_type) AS client_type, MIN(latitude) AS latitude, MIN(longitude) AS longitude "
               "FROM topf GROUP BY user_id, slot) t ON r.user_id = t.user_id AND r.slot = t.slot")
    sel = ["r.user_id AS user_id", "r.slot AS time"]
    for m in MEAN_STD_COLS:
        v = "r.iat" if m == "iat" else _case_secs(m, "r.")
        sel.append(f"AVG({v}) AS {m}")
        sel.append(f"COALESCE(STDDEV_SAMP({v}), 0) AS {m}_std")
    sel.append("COUNT(DISTINCT r.top_type) AS unique_top_types")
    sel.append("AVG(CASE WHEN r.skipped THEN 1.0 ELSE 0.0 END) AS skip_ratio")
    sel += [f"MAX(r.{c}) AS {c}" for c in SUM_COLS]
    sel.append("COUNT(*) AS total_streams")
    for t in TOP_TYPES:
        sel.append(f"SUM(CASE WHEN r.top_type = '{t}' THEN 1 ELSE 0 END) AS total_streams_{t.lower()}")
    sel += [f"MIN(t.{c}) AS {c}" for c in ANY_COLS]
    sel.append("false AS backfill")
    ctes.append("slotf AS (SELECT " + ", ".join(sel) + f" FROM {src} GROUP BY r.user_id, r.slot)")
    return ctes


def label_ctes(s: Settings) -> list[str]:
    w = s.windows
    inq = f"(SELECT user_id FROM slotf WHERE time >= {w.pred_start} AND secs_played > 0)"
    return [
        f"labels AS (SELECT *, 0 AS churn FROM users WHERE user_id IN {inq} "
        f"UNION ALL SELECT *, 1 AS churn FROM users WHERE user_id NOT IN {inq})",
        f"training AS (SELECT * FROM slotf WHERE time <= {w.max_training_slot})",
    ]


def zero_fill_ctes(s: Settings) -> list[str]:
    zero = []
    for m in MEAN_STD_COLS:
        zero += [f"0.0 AS {m}", f"0.0 AS {m}_std"]
    zero += ["0 AS unique_top_types", "0.0 AS skip_ratio"]
    zero += [f"0 AS {c}" for c in SUM_COLS] + [f"0 AS {c}" for c in COUNT_COLS]
    zero += ["'Unknown' AS top_type", "'Unknown' AS platform", "'Unknown' AS client_type",
             "CAST(NULL AS DOUBLE) AS latitude", "CAST(NULL AS DOUBLE) AS longitude"]
    cols = ["user_id", "time"] + [c for m in MEAN_STD_COLS for c in (m, f"{m}_std")] + \
        ["unique_top_types", "skip_ratio"] + SUM_COLS + COUNT_COLS + ANY_COLS + ["backfill"]
    grid = "[" + ", ".join(str(t) for t in s.windows.training_slots()) + "]"
    return [
        f"grid AS (SELECT user_id, unnest({grid}) AS slot_start FROM labels)",
        "filled AS (SELECT " + ", ".join(cols) + " FROM training UNION ALL "
        "SELECT g.user_id, g.slot_start AS time, " + ", ".join(zero) + ", true AS backfill "
        "FROM grid g "
        "WHERE NOT EXISTS (SELECT 1 FROM training f WHERE f.user_id = g.user_id AND f.time = g.slot_start))",
    ]


def normalized_cte(zero_std: str = "zero") -> list[str]:
    stats = ", ".join(f"AVG({f}) FILTER (WHERE NOT backfill) OVER () AS {f}_avg, "
                      f"STDDEV_POP({f}) FILTER (WHERE NOT backfill) OVER () AS {f}_sd" for f in MODEL_FEATURES)
    z = []
    for f in MODEL_FEATURES:
        zexpr = (f"CASE WHEN {f}_sd IS NULL OR {f}_sd = 0 THEN 0.0 "
                 f"ELSE ({f} - {f}_avg) / {f}_sd END")
        z.append(f"CASE WHEN backfill THEN CAST({f} AS DOUBLE) ELSE {zexpr} END AS {f}")
    return [
        f"with_stats AS (SELECT *, {stats} FROM filled)",
        "normed AS (SELECT user_id, time, backfill, " + ", ".join(z) + " FROM with_stats)",
    ]


def with_sql(ctes: list[str], select: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + select
