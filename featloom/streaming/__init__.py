"""Structured Streaming form of the ingest job."""
