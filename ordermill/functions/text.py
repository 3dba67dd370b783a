"""Text expressions: normalisation, patterns and masking."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The patterns events and addresses are judged by.
EMAIL_PATTERN = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"
PRODUCT_PATTERN = r"^UC-[A-Z]{2}-[0-9]{3}$"


def normalise(address: Column) -> Column:
    """The form under which two spellings of an address are one customer."""
    return F.lower(F.trim(address))


def matches(text: Column, pattern: str, ignore_case: bool = False, strict_end: bool = False) -> Column:
    """Anchored pattern test.

    ``$`` also matches before a final newline; ``strict_end`` refuses that.
    """
    if strict_end and pattern.endswith("$"):
        pattern = pattern[:-1] + r"\z"
    return text.rlike(("(?i)" if ignore_case else "") + pattern)


def is_blank(text: Column) -> Column:
    """NULL or empty. Whitespace is content."""
    return text.isNull() | (text == "")


def mask_email(address: Column) -> Column:
    return F.concat(F.lit("***@"), F.split_part(address, F.lit("@"), F.lit(2)))


def mask_name(name: Column) -> Column:
    return F.concat(F.left(name, F.lit(1)), F.lit("***"))


def digest(text: Column) -> Column:
    """Deterministic identifier of a natural key."""
    return F.md5(text)
