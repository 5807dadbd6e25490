"""String column functions: names, e-mail domains, whitespace."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip_ws(c: Column) -> Column:
    """pandas ``str.strip()``: remove all leading/trailing whitespace, not only blanks."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def normalize_company_name(c: Column) -> Column:
    """The name without blanks and full stops, in lower case."""
    return F.lower(F.trim(F.replace(F.replace(c, F.lit(" "), F.lit("")), F.lit("."), F.lit(""))))


def compact_name(c: Column) -> Column:
    """pandas ``str.strip().str.lower().str.replace(' ', '')`` (duplicate-name key)."""
    return F.replace(F.lower(strip_ws(c)), F.lit(" "), F.lit(""))


def email_domain(c: Column) -> Column:
    """``LOWER(SPLIT_PART(email, '@', 2))``; '' when there is no '@'."""
    return F.lower(F.split_part(c, F.lit("@"), F.lit(2)))
