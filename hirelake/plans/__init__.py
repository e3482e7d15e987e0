"""Whole jobs: cleaned tables, aggregate tables, the report, the daily run."""
