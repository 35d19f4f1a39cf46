"""The pipeline as Structured Streaming jobs."""
