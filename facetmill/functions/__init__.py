"""Column expressions; all of them stay inside whole-stage code generation."""

from .labels import LABEL_NAMES, first_result, label_id, label_name, price_bucket, row_text
from .text import (
    blank_to_null,
    corner_value,
    normalise_strings,
    price_fallback,
    strip_newlines,
    strip_parenthetical,
)

__all__ = [
    "LABEL_NAMES",
    "blank_to_null",
    "corner_value",
    "first_result",
    "label_id",
    "label_name",
    "normalise_strings",
    "price_bucket",
    "price_fallback",
    "row_text",
    "strip_newlines",
    "strip_parenthetical",
]
