"""Column expressions (JVM-side, codegen friendly). No Python UDFs."""

from lapse.functions.buckets import hash_bucket  # noqa: F401
from lapse.functions.timefn import epoch_seconds, slot_start, round_half_away  # noqa: F401
from lapse.functions.contexts import parse_context_cols, DEFAULT_RULES  # noqa: F401
