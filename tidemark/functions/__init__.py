"""Column expressions shared by the sources, cleaners and aggregates."""

from tidemark.functions.checks import required
from tidemark.functions.instants import utc_date, utc_hour
from tidemark.functions.lookups import code_label, integer_property, last_property
from tidemark.functions.numbers import bucket_label, occupancy, rate_pct, round2
from tidemark.functions.text import strip, title_case, trailing_number

__all__ = [
    "bucket_label",
    "code_label",
    "integer_property",
    "last_property",
    "occupancy",
    "rate_pct",
    "required",
    "round2",
    "strip",
    "title_case",
    "trailing_number",
    "utc_date",
    "utc_hour",
]
