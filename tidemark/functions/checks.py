"""Expressions that fail the job instead of passing bad values on.

Malformed text needs none: casts fail by themselves in ANSI mode, which
``session.require_settings`` insists on.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def required(value: Column, message: str) -> Column:
    """``value``, or an error where it is NULL."""
    return F.coalesce(value, F.raise_error(F.lit(message)))
