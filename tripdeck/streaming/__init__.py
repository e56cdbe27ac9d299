"""Streaming: incremental ingest of newly landed monthly files into the OBT."""
