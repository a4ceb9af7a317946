"""Whole jobs and ready-made queries."""
