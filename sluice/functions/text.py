"""Text predicates and clean-up, all built from JVM-side expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The characters Java counts as white space.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f         "
    "      　"
)
# What a Java trim removes, code points 0 to 32.
CONTROL_AND_SPACE = "".join(chr(code) for code in range(33))


def is_blank(text: Column) -> Column:
    """True for empty or all-white-space text; null for null."""
    return F.btrim(text, F.lit(WHITESPACE)) == ""


def null_or_blank(value: Column, is_text: bool) -> Column:
    """Null, or blank when the column holds text. Other types are never blank."""
    return value.isNull() | is_blank(value) if is_text else value.isNull()


def trim_controls(text: Column) -> Column:
    return F.btrim(text, F.lit(CONTROL_AND_SPACE))


def upper_symbol(text: Column) -> Column:
    return trim_controls(F.upper(text))


def keep_number_chars(text: Column) -> Column:
    return F.regexp_replace(text, r"[^0-9.\-]", "")


def full_match(text: Column, pattern: str) -> Column:
    """``rlike`` finds anywhere; the anchors make it match the whole value."""
    return text.rlike(rf"\A(?:{pattern})\z")
