"""Lookups in literal code tables and in key/value lists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def code_label(code: Column, labels: dict, default) -> Column:
    """Value for ``code`` in a small literal table."""
    label = None
    for key, value in labels.items():
        label = F.when(code == key, value) if label is None else label.when(code == key, value)
    return label.otherwise(default)


def last_property(properties: Column, key: str) -> Column:
    """Value under ``key`` in an array of ``{key, value}``; the last one wins.

    Found by position from the end rather than with a lambda, which would be
    interpreted. An absent key has position 0, which points past the end and
    so gives NULL.
    """
    from_end = F.array_position(F.reverse(properties["key"]), key).cast("int")
    return F.get(properties["value"], F.array_size(properties) - from_end)


def integer_property(properties: Column, key: str) -> Column:
    """Integer under ``key``; an absent, null or empty value is 0, a malformed one an error."""
    value = last_property(properties, key)
    return F.coalesce(F.nullif(value, F.lit("")), F.lit("0")).cast("int")
