"""Sinks: partition-replacing writes, overwrite/append, round trip, CSV export."""
