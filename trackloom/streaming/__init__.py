"""Structured Streaming jobs: enrichment, keyed state, hourly snapshots, serving."""
