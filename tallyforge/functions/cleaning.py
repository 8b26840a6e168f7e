"""Customer cleaning and validation rules as column expressions.

Every rule gives the same result with ANSI mode on and off. ``strict=True`` selects the
intended rule where the default one is known to let bad values through.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The patterns that define a clean name and a bad phone number.
NAME_PUNCTUATION = r"[^\w\s]"
NAME_DISALLOWED = r"[^a-zA-Z\s{2,}]"  # the braces, comma and digit 2 count as allowed
NAME_DISALLOWED_STRICT = r"[^a-zA-Z\s]"
PHONE_NEGATIVE = r"^\\-"  # a backslash, then a hyphen
PHONE_NEGATIVE_STRICT = r"^-"
PHONE_ERROR_TEXT = "#error"

EMPTY_NAME = "(empty)"


def clean_name(name: Column) -> Column:
    """Drop punctuation (ASCII word characters and white space stay), then outer spaces."""
    return F.trim(F.regexp_replace(name, NAME_PUNCTUATION, ""))


def name_problem(cleaned: Column, strict: bool = False) -> Column:
    """First character a cleaned name may not contain, or an empty string.

    The strict rule also reports a name with nothing left after cleaning.
    """
    if not strict:
        return F.regexp_extract(cleaned, NAME_DISALLOWED, 0)
    found = F.regexp_extract(cleaned, NAME_DISALLOWED_STRICT, 0)
    return F.when(cleaned == "", F.lit(EMPTY_NAME)).otherwise(found)


def phone_problem(phone: Column, strict: bool = False) -> Column:
    """True for a negative number or a spreadsheet error text; NULL for a NULL phone."""
    negative = phone.rlike(PHONE_NEGATIVE_STRICT if strict else PHONE_NEGATIVE)
    return negative | F.lower(phone).contains(PHONE_ERROR_TEXT)


def address_line(address: Column, number: int) -> Column:
    """The comma-separated part at ``number`` (from 0), trimmed; NULL if there is none."""
    return F.trim(F.get(F.split(address, ","), number))
