"""Column expressions shared by the operators that use no Python on executors."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

CHUNK = 256


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _scan(values: Column, merge, first: Column) -> Column:
    """(n + 1) running results; quadratic, for short arrays."""
    return F.aggregate(values, F.array(first), lambda acc, x: F.concat(acc, F.array(merge(F.element_at(acc, -1), x))))


def before(values: Column, merge: Callable[[Column, Column], Column], first: Column) -> Column:
    """For every element the running result of the elements before it.

    ``merge`` must be associative with neutral ``first``.  The array is
    scanned in chunks whose totals are scanned in turn, so that long arrays
    do not cost the square of their length.
    """
    def scanned(values: Column) -> Column:
        parts = F.transform(F.sequence(F.lit(0), F.ceil(F.size(values) / CHUNK).cast("int") - 1),
                            lambda j: F.slice(values, j * CHUNK + 1, F.lit(CHUNK)))
        return let(parts, lambda ps: let(
            _scan(F.transform(ps, lambda p: F.aggregate(p, first, merge)), merge, first),
            lambda tops: F.flatten(F.transform(ps, lambda p, i: F.transform(
                F.slice(_scan(p, merge, first), F.lit(1), F.size(p)), lambda x: merge(F.get(tops, i), x))))))

    return let(values, lambda v: F.when(F.size(v) > 0, scanned(v)).otherwise(F.slice(F.array(first), 1, 0)))
