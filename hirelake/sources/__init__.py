"""Readers and writers: snapshots, page responses, named tables, CSV."""
