from streamlab.functions.columns import (
    composite_key,
    count_words,
    default_if_absent,
    drop_zero_missing,
    head_chars,
    parse_event_time,
    pct_change,
    round_decimal,
    star_count,
    star_label,
    to_decimal,
    versus,
    zero_to_null,
)

__all__ = [
    "composite_key",
    "count_words",
    "default_if_absent",
    "drop_zero_missing",
    "head_chars",
    "parse_event_time",
    "pct_change",
    "round_decimal",
    "star_count",
    "star_label",
    "to_decimal",
    "versus",
    "zero_to_null",
]
