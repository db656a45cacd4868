"""Column-level building blocks: names, casts, labels, flags, gaps, bands, rounding."""

from degraus.functions.columns import (
    as_boolean,
    at_least_zero,
    band,
    code_label,
    decimal_comma,
    is_typed,
    missing_to_null,
    normalise_columns,
    normalise_name,
    out_of_range,
    parse_event_time,
    percentage,
    round_even,
    select_present,
    try_cast_columns,
)

__all__ = [
    "as_boolean",
    "at_least_zero",
    "band",
    "code_label",
    "decimal_comma",
    "is_typed",
    "missing_to_null",
    "normalise_columns",
    "normalise_name",
    "out_of_range",
    "parse_event_time",
    "percentage",
    "round_even",
    "select_present",
    "try_cast_columns",
]
