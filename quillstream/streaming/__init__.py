"""The ingestion plan as a Structured Streaming job."""
