"""Stable row hashes for reproducible sampling.

``row_hash`` is the first 15 hex digits (60 bits) of ``md5(seed|k1|k2|...)`` as a bigint. The key
text uses only renderings every engine computes identically (integers, strings, timestamps as
epoch seconds, doubles as floor(x·10^6)), so any engine that has ``md5`` gives the same number
for the same row, and a sample drawn with it can be repeated elsewhere.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

HASH_BITS = 60
HASH_SPACE = float(2 ** HASH_BITS)
NULL_TOKEN = "\\N"


# Doubles enter the key as floor(x · 10^6): one IEEE multiplication and a floor, identical in
# every engine (their decimal text forms are not).
DOUBLE_KEY_SCALE = 1_000_000.0


def key_text(col: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        col = F.unix_timestamp(col)
    elif isinstance(dtype, (T.DoubleType, T.FloatType)):
        col = F.floor(col.cast("double") * F.lit(DOUBLE_KEY_SCALE))
    return F.coalesce(col.cast("string"), F.lit(NULL_TOKEN))


def row_hash(df_schema: T.StructType, key_cols: list[str], seed: int = 42) -> Column:
    parts = [F.lit(str(seed))] + [key_text(F.col(c), df_schema[c].dataType) for c in key_cols]
    digest = F.md5(F.concat_ws("|", *parts))
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("bigint")


def unit_hash(df_schema: T.StructType, key_cols: list[str], seed: int = 42) -> Column:
    """The row hash scaled into [0, 1)."""
    return row_hash(df_schema, key_cols, seed) / F.lit(HASH_SPACE)
