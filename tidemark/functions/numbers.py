"""Numeric expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round2(value: Column) -> Column:
    """Two decimals, ties of the scaled double to even.

    ``round`` sends ties away from zero and ``bround`` works on the decimal
    text of the double; both differ from this.
    """
    return F.rint(value * F.lit(100.0)) / F.lit(100.0)


def occupancy(bikes: Column, docks: Column) -> Column:
    """Bikes per dock in percent; a station without docks counts as one dock."""
    return round2(bikes / F.when(docks == 0, 1).otherwise(docks) * F.lit(100))


def rate_pct(part: Column, whole: Column) -> Column:
    return round2(part * F.lit(100.0) / whole)


def bucket_label(value: Column, buckets, default: str) -> Column:
    """Label of the right-closed bucket holding ``value``.

    NULL and NaN are in no bucket: NaN compares above every number.
    """
    label = None
    for above, up_to, name in buckets:
        inside = (value > above) & (value <= up_to)
        label = F.when(inside, name) if label is None else label.when(inside, name)
    return label.otherwise(default)
