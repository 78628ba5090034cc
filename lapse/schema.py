"""Feature and value names.

Fixed values: these names and lists must equal the original pipeline's for
the datasets to be interchangeable (column names of the slot table and of
the exported training examples).
"""

# Top-level context types, in the original order.
TOP_TYPES = [
    "UserPlaylist", "UserCollection", "Catalog", "EditorialPlaylist", "Radio",
    "Mix", "SoundsOf", "PersonalizedPlaylist", "Charts", "Unknown", "Running",
]

# Sampling filters.
SAMPLE_PLATFORMS = ["android", "android-tablet"]
SAMPLE_COUNTRIES = ["BR", "US", "MX"]
SIGNIFICANT_MS = 30000
SEARCH_PATTERN = "%:search:%"
MISSING_COORD = 999.9

SECS_IN_DAY = 86400
SLOT_OFFSET_SECS = 6 * 3600  # days start at 06:00 UTC


def type_suffix(top_type: str) -> str:
    return top_type.lower()


# played-seconds columns: all plays plus one per top type
SECS_COLS = ["secs_played"] + [f"secs_played_{type_suffix(t)}" for t in TOP_TYPES]
# columns that carry a mean and a ``_std`` companion
MEAN_STD_COLS = SECS_COLS + ["iat"]
SUM_COLS = [f"sum_{c}" for c in SECS_COLS]
COUNT_COLS = ["total_streams"] + [f"total_streams_{type_suffix(t)}" for t in TOP_TYPES]
RATIO_COLS = ["skip_ratio", "unique_top_types"]
ANY_COLS = ["top_type", "platform", "client_type", "latitude", "longitude"]

# the 52 model features (13 mean/std pairs, 12 running sums, 14 counts/ratios)
MODEL_FEATURES = (
    [c for m in MEAN_STD_COLS for c in (m, f"{m}_std")]
    + SUM_COLS
    + RATIO_COLS
    + COUNT_COLS
)
assert len(MODEL_FEATURES) == 52

# the parsed-stream schema
PARSED_COLS = [
    "user_id", "timestampp", "skipped", "secs_played", "play_context_decrypted",
    "top_type", "sub_type", "platform", "latitude", "longitude", "client_type",
]
