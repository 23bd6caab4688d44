"""Table sources, typed text ingest and sinks."""
