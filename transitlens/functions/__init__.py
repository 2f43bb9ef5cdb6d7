from .columns import (
    adjacent_deltas,
    duration_text,
    heading_within,
    iso_text,
    json_pair_line,
    json_string,
    number_text,
)

__all__ = [
    "heading_within",
    "number_text",
    "json_string",
    "json_pair_line",
    "iso_text",
    "duration_text",
    "adjacent_deltas",
]
