"""Column-level helpers built only from Spark SQL built-in functions, so they
stay inside whole-stage code generation."""

from scoreflow.functions.dates import (
    local_day_bounds,
    local_day_window,
    months_back,
    ts_literal,
    yyyymmdd_to_iso,
)
from scoreflow.functions.envelope import RESPONSE_SCHEMA, decode_response, response_status
from scoreflow.functions.hashing import order_hash, unit_hash
from scoreflow.functions.textify import to_text_column, to_text_columns

__all__ = [
    "RESPONSE_SCHEMA",
    "decode_response",
    "local_day_bounds",
    "local_day_window",
    "months_back",
    "order_hash",
    "response_status",
    "to_text_column",
    "to_text_columns",
    "ts_literal",
    "unit_hash",
    "yyyymmdd_to_iso",
]
