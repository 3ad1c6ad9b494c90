"""Column-level building blocks: tolerant casts, dates, code decoding, hashing."""

from arrivals_mart.functions.casts import (
    int_key,
    tolerant_date,
    tolerant_double,
    tolerant_int,
    tolerant_long,
)
from arrivals_mart.functions.codes import TRANSPORT_MODES, TRAVEL_PURPOSES, decode, hash_key
from arrivals_mart.functions.dates import (
    date_parts,
    epoch_ms,
    from_day_number,
    from_epoch_ms,
    month_index,
    month_start,
    to_day_number,
)

__all__ = [
    "TRANSPORT_MODES",
    "TRAVEL_PURPOSES",
    "date_parts",
    "decode",
    "epoch_ms",
    "from_day_number",
    "from_epoch_ms",
    "hash_key",
    "int_key",
    "month_index",
    "month_start",
    "to_day_number",
    "tolerant_date",
    "tolerant_double",
    "tolerant_int",
    "tolerant_long",
]
