"""Code decodes for vendor, rate code and payment type.

Each decode is one ``CASE WHEN`` expression; anything not listed, NULL included, is ``Other``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Labels must equal the reference's text exactly.
VENDOR_NAMES = {
    1: "Creative Mobile Technologies",
    2: "VeriFone Inc",
}
RATE_CODE_DESCRIPTIONS = {
    1: "Standard rate",
    2: "JFK",
    3: "Newark",
    4: "Nassau or Westchester",
    5: "Negotiated fare",
    6: "Group ride",
}
PAYMENT_TYPE_DESCRIPTIONS = {
    1: "Credit card",
    2: "Cash",
    3: "No charge",
    4: "Dispute",
    5: "Unknown",
    6: "Voided trip",
}
OTHER = "Other"


def decode(col: Column, labels: dict[int, str], default: str = OTHER) -> Column:
    """``CASE col WHEN k THEN v ... ELSE default END``; a NULL code falls to ``default``."""
    expr = None
    for code, label in labels.items():
        expr = (F.when(col == code, F.lit(label)) if expr is None
                else expr.when(col == code, F.lit(label)))
    return expr.otherwise(F.lit(default))


def vendor_name(col: Column) -> Column:
    return decode(col, VENDOR_NAMES)


def rate_code_desc(col: Column) -> Column:
    return decode(col, RATE_CODE_DESCRIPTIONS)


def payment_type_desc(col: Column) -> Column:
    return decode(col, PAYMENT_TYPE_DESCRIPTIONS)

