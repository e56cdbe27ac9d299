"""Column-expression builders: decodes, time parts, trip measures, stable row hashes."""

from tripdeck.functions.codes import (  # noqa: F401
    PAYMENT_TYPE_DESCRIPTIONS, RATE_CODE_DESCRIPTIONS, VENDOR_NAMES,
    decode, payment_type_desc, rate_code_desc, vendor_name,
)
from tripdeck.functions.measures import (  # noqa: F401
    avg_speed_mph, code_int, key_part, pickup_dow, pickup_hour, tip_pct, trip_duration_min,
)
from tripdeck.functions.hashing import row_hash, unit_hash  # noqa: F401
