"""Column expressions built only from Spark's built-in functions."""

from tabsmith.functions.stats import g1_skew, is_numeric, is_integral, nan_to_null, rounded
from tabsmith.functions.text import (
    boolean_word_code,
    clean_log_line,
    first_words,
    is_boolean_word,
    looks_formatted,
    parse_formatted,
    safe_name,
    strip_code_fences,
    strip_edges,
    word_count,
)
from tabsmith.functions.dates import parse_datetime, weekday_monday0

__all__ = [
    "g1_skew", "is_numeric", "is_integral", "nan_to_null", "rounded",
    "boolean_word_code", "clean_log_line", "first_words", "is_boolean_word",
    "looks_formatted", "parse_formatted", "safe_name", "strip_code_fences",
    "strip_edges", "word_count", "parse_datetime", "weekday_monday0",
]
