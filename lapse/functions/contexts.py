"""Play-context string -> (top_type, sub_type).

The original parses the context with a private per-row library.  Here the
parse is a rule table turned into one column expression: the context is
split on ':'; the second field, lower-cased, is looked up in the table; the
fields after it form the sub type.  Unmatched or NULL contexts give
``Unknown`` and an empty sub type.  The lookup is a literal map, so the
whole parse stays inside whole-stage codegen.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from lapse.schema import TOP_TYPES

# rule table: context type field (lower case) -> top type
DEFAULT_RULES: dict[str, str] = {t.lower(): t for t in TOP_TYPES}

UNKNOWN = "Unknown"


def parse_context_cols(ctx, rules: dict[str, str] | None = None) -> tuple[Column, Column]:
    """Return (top_type, sub_type) expressions for a context column."""
    rules = DEFAULT_RULES if rules is None else rules
    c = F.col(ctx) if isinstance(ctx, str) else ctx
    parts = F.split(c, ":", 3)
    field = F.lower(F.get(parts, 1))
    lookup = F.create_map(*[F.lit(x) for x in chain.from_iterable(rules.items())])
    matched = F.element_at(lookup, field) if rules else F.lit(None).cast("string")
    top = F.coalesce(F.when(field.isNotNull(), matched), F.lit(UNKNOWN))
    sub = F.when(field.isNotNull() & matched.isNotNull(), F.coalesce(F.get(parts, 2), F.lit(""))) \
        .otherwise(F.lit(""))
    return top, sub


def sql_parse_context(ctx: str, rules: dict[str, str] | None = None) -> tuple[str, str]:
    """DuckDB text of the same parse, for oracles."""
    rules = DEFAULT_RULES if rules is None else rules
    field = f"lower(split_part({ctx}, ':', 2))"
    cases = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in rules.items())
    top = f"COALESCE(CASE {field} {cases} END, '{UNKNOWN}')"
    rest = (f"CASE WHEN strpos(substr({ctx}, strpos({ctx}, ':') + 1), ':') > 0 "
            f"THEN substr(substr({ctx}, strpos({ctx}, ':') + 1), strpos(substr({ctx}, strpos({ctx}, ':') + 1), ':') + 1) "
            f"ELSE '' END")
    sub = f"CASE WHEN (CASE {field} {cases} END) IS NOT NULL THEN {rest} ELSE '' END"
    return top, sub
