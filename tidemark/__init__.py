"""Snapshot-to-gold analytics on Spark."""
