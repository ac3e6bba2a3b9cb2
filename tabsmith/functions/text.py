"""String expressions: formatted numbers, words, boolean words, names, log lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tabsmith import fixed


def looks_formatted(c: Column, keep_sign: bool = False) -> Column:
    """True when the trimmed text reads as a number with currency, separators or a unit."""
    pattern = fixed.FORMATTED_SIGNED_PATTERN if keep_sign else fixed.FORMATTED_PATTERN
    return F.trim(c).rlike(pattern)


def parse_formatted(c: Column, keep_sign: bool = False) -> Column:
    """Strip all but digits and dots (and a minus when asked), then cast; what is left
    must read as one number, otherwise null.

    The shape test runs before the cast so that failing values (most values of a text
    column) never take the cast's exception path.
    """
    keep = "[^0-9.\\-]" if keep_sign else "[^0-9.]"
    shape = "^-?([0-9]+[.]?[0-9]*|[.][0-9]+)$" if keep_sign else "^([0-9]+[.]?[0-9]*|[.][0-9]+)$"
    s = F.regexp_replace(c, keep, "")
    # text without a digit cannot parse: one early-exit scan instead of replace + match
    return F.when(c.rlike("[0-9]"), F.when(s.rlike(shape), s.try_cast("double")))


def word_count(c: Column) -> Column:
    """Whitespace-separated words; empty text has none."""
    t = F.trim(c)
    return F.when(t == "", F.lit(0)).otherwise(F.size(F.split(t, "\\s+")))


def first_words(c: Column, n: int) -> Column:
    return F.array_join(F.slice(F.split(F.trim(c), "\\s+"), 1, n), " ")


def is_boolean_word(c: Column) -> Column:
    words = list(fixed.BOOLEAN_TRUE_WORDS + fixed.BOOLEAN_FALSE_WORDS)
    return F.lower(F.trim(c)).isin(words)


def boolean_word_code(c: Column) -> Column:
    w = F.lower(F.trim(c))
    return (F.when(w.isin(list(fixed.BOOLEAN_TRUE_WORDS)), F.lit(1))
            .when(w.isin(list(fixed.BOOLEAN_FALSE_WORDS)), F.lit(0)))


def strip_edges(c: Column) -> Column:
    """Whitespace trim on both ends (``trim`` alone removes only spaces)."""
    return F.regexp_replace(c, "^\\s+|\\s+$", "")


def strip_code_fences(c: Column) -> Column:
    """Remove an opening fence with an optional language tag and a closing fence."""
    s = strip_edges(c)
    s = F.regexp_replace(s, "^```[a-zA-Z0-9]*\\n", "")
    s = F.regexp_replace(s, "\\n```$", "")
    return F.coalesce(strip_edges(s), F.lit(""))


def safe_name(c: Column) -> Column:
    """Keep letters, digits, underscore and hyphen."""
    return F.regexp_replace(c, "[^\\p{L}\\p{N}_-]", "")


def clean_log_line(c: Column) -> Column:
    """Drop bracketed timestamps anywhere, then edge colons, hyphens and spaces."""
    s = F.regexp_replace(c, fixed.LOG_TIMESTAMP_PATTERN, "")
    s = strip_edges(s)
    s = F.regexp_replace(s, fixed.LOG_EDGE_PATTERN, "")
    return strip_edges(s)
