"""Incremental upsert from an append-only snapshot folder."""
