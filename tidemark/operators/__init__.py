"""Cleaners, gold aggregates, quality gates and table maintenance."""
