"""Text predicates and normalisation as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every code point that Python's str.strip / re `\s` treat as whitespace.
WHITESPACE_RANGES = [
    (0x09, 0x0D), (0x1C, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680),
    (0x2000, 0x200A), (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000),
]

WHITESPACE_CHARS = "".join(chr(c) for lo, hi in WHITESPACE_RANGES for c in range(lo, hi + 1))

# The same set written as the body of a Java character class.
WHITESPACE_CLASS = "".join(
    f"\\x{{{lo:x}}}" if lo == hi else f"\\x{{{lo:x}}}-\\x{{{hi:x}}}" for lo, hi in WHITESPACE_RANGES
)

# A word character as Python's re sees it: letters, numbers of any kind, underscore.
WORD_CLASS = r"\p{L}\p{N}_"

REPLACEMENT_CHAR = "�"


def strip(text: Column) -> Column:
    """Drop leading and trailing Unicode whitespace.

    A character-set trim only walks the two ends, where a regex would try every
    whitespace run of a long text.
    """
    return F.btrim(text, F.lit(WHITESPACE_CHARS))


def is_blank(text: Column) -> Column:
    # Trimming one end is enough, and stops at the first character that is not blank.
    return text.isNull() | (F.ltrim(text, F.lit(WHITESPACE_CHARS)) == "")


def normalise(text: Column) -> Column:
    """Duplicate key: lower case, stripped, inner whitespace runs collapsed to one space."""
    return F.regexp_replace(strip(F.lower(text)), f"[{WHITESPACE_CLASS}]+", " ")


def text_length(text: Column) -> Column:
    """Length in code points."""
    return F.char_length(text).cast("long")


def is_shouting(text: Column) -> Column:
    """Some upper-case letter, no lower- or title-case one, over 10 characters once stripped."""
    return (
        ~text.rlike(r"[\p{IsLowercase}\p{IsTitlecase}]")
        & text.rlike(r"\p{IsUppercase}")
        & (F.char_length(strip(text)) > 10)
    )


def has_excess_punctuation(text: Column) -> Column:
    return text.rlike("[!?]{3,}")


def has_replacement_char(text: Column) -> Column:
    return text.contains(REPLACEMENT_CHAR)


def text_digest(text: Column) -> Column:
    """32-byte SHA-256 of a text: what duplicate detection shuffles instead of the text."""
    return F.unhex(F.sha2(text, 256))
