from curbsight.functions.formats import (
    code_point_sum,
    dollars,
    number_text,
    pick,
    rounded,
    strip_whitespace,
    text_or_none,
)
from curbsight.functions.numbers import code_lookup, exact_mean, exact_sum, property_number, ratio, snap_round

__all__ = [
    "code_lookup",
    "code_point_sum",
    "dollars",
    "exact_mean",
    "exact_sum",
    "number_text",
    "pick",
    "property_number",
    "ratio",
    "rounded",
    "snap_round",
    "strip_whitespace",
    "text_or_none",
]
