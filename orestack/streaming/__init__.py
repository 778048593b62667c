"""Click-event ingest with Structured Streaming."""
