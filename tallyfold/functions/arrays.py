"""Arrays within a row: values that are worked out once, and the last entry of each key."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, functions as F


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once, also where ``use`` has it several times or within a lambda."""
    return F.transform(F.array(value), use)[0]


def last_of(entries: Column, fields: list[str]) -> Column:
    """The greatest one of the entries (fields, position, ...) with the same fields, in the order of these; the first field is never null."""
    follows = lambda e, n: functools.reduce(Column.__and__, [e[f].eqNullSafe(n[f]) for f in fields])
    return bound(F.sort_array(entries), lambda s: F.filter(s, lambda e, i: ~follows(e, F.get(s, i + 1))))


def same(values: Column) -> Column:
    """The value that all have that are not null."""
    return bound(values, lambda v: F.when(F.array_min(v) == F.array_max(v), F.array_min(v)))
