"""tripdeck: trip-record analytics on Spark.

Ingest monthly trip files into partitioned raw tables, build the one-big-table of decoded and
derived trip measures, replace partitions idempotently, report run ledgers, and prepare,
fit and score linear regression models — all as DataFrame-to-DataFrame functions.
"""

__version__ = "0.1.0"
