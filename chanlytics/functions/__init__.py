"""Column expressions: pure, JVM-side, codegen-friendly."""

from chanlytics.functions.keys import date_key, surrogate_key
from chanlytics.functions.dates import date_attributes
from chanlytics.functions.text import (
    contains_ci, like_ci, message_length, tokens, TOKEN_PATTERN,
)

__all__ = [
    "surrogate_key", "date_key", "date_attributes", "contains_ci", "like_ci",
    "message_length", "tokens", "TOKEN_PATTERN",
]
