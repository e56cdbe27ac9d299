"""Operators: ingest, OBT build, partitions and ledgers, features, evaluation, models."""
