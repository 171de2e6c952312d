"""Topics, ingest and scoring as Structured Streaming jobs."""
