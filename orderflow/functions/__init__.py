"""Column builders. All of them give NULL, not an error, on bad input, with ANSI mode on or off."""

from orderflow.functions.casts import to_date, to_double, to_int, to_rate, to_price
from orderflow.functions.text import (
    ends_with_any,
    event_key_decode,
    lower_trim,
    partition_date,
    replace_invalid_chars,
    starts_with_any,
    upper_trim,
)

__all__ = [
    "ends_with_any", "event_key_decode", "lower_trim", "partition_date",
    "replace_invalid_chars", "starts_with_any", "to_date", "to_double", "to_int",
    "to_price", "to_rate", "upper_trim",
]
