"""DataFrame operators: dedup, upsert, card extraction, enrichment, profiles."""
