"""Text predicates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values. Request fields count as blank when every character is at or below U+0020; a patched
# device name counts as blank when every character is Unicode white space (no-break spaces are not).
CONTROL_BLANK = r"^[\x00-\x20]*\z"
UNICODE_BLANK = (r"^[\x09-\x0D\x1C-\x20\x{1680}\x{2000}-\x{2006}\x{2008}-\x{200A}"
                 r"\x{2028}\x{2029}\x{205F}\x{3000}]*\z")


def is_blank(text: Column) -> Column:
    """Null, empty, or only characters up to U+0020."""
    return text.isNull() | text.rlike(CONTROL_BLANK)


def is_unicode_blank(text: Column) -> Column:
    """Empty or only Unicode white space; null stays null, as an absent field is not blank."""
    return text.rlike(UNICODE_BLANK)


def longer_than(text: Column, limit: int) -> Column:
    """More than ``limit`` UTF-16 units, in which the size rules count. A text has no more of them than bytes, so few are encoded."""
    return F.coalesce((F.octet_length(text) > limit) & (F.octet_length(F.encode(text, "UTF-16BE")) > 2 * limit), F.lit(False))
