"""Column-level helpers (JVM built-ins only, no UDFs)."""

from demandlens.functions.math import mean_of, per_unit, percent, sigmoid
from demandlens.functions.text import (
    SENTINEL,
    collapse_ws,
    is_blank,
    key_text,
    normalized_text,
    nullable_text,
    safe_date,
    truthy_flag,
    zoned_timestamp,
)

__all__ = [
    "SENTINEL", "collapse_ws", "is_blank", "key_text", "normalized_text", "nullable_text",
    "safe_date", "truthy_flag", "zoned_timestamp", "mean_of", "per_unit", "percent", "sigmoid",
]
