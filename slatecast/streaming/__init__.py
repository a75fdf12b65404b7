"""Incremental forms of ingest, dedup and grading as Structured Streaming jobs."""
