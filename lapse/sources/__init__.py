"""Sources and sinks: daily tables, fixture adapters, JSON/CSV/parquet I/O."""

from lapse.sources.tables import read_days, read_table, snapshot_on  # noqa: F401
from lapse.sources.fixtures import plays_from_events, contexts_from_events, snapshots_from_customers, load_fixture  # noqa: F401
