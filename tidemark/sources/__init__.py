"""Readers of landed snapshot documents."""

from tidemark.sources.landing import (
    FLATTENERS,
    flatten_air_quality,
    flatten_bike_points,
    flatten_line_status,
    read_documents,
    read_snapshots,
)

__all__ = [
    "FLATTENERS",
    "flatten_air_quality",
    "flatten_bike_points",
    "flatten_line_status",
    "read_documents",
    "read_snapshots",
]
