"""Text rules. The warehouse folds case two ways, so both are named here."""

import string

from pyspark.sql import Column
from pyspark.sql import functions as F


def trim_spaces(c: Column) -> Column:
    """Strip blanks only; tabs, newlines and no-break spaces stay."""
    return F.trim(c)


def ascii_lower(c: Column) -> Column:
    """Lower-case A to Z and leave every other letter alone."""
    mapped = F.translate(c, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(_is_ascii(c), F.lower(c)).otherwise(mapped)


def ascii_upper(c: Column) -> Column:
    """Upper-case a to z and leave every other letter alone."""
    mapped = F.translate(c, string.ascii_lowercase, string.ascii_uppercase)
    return F.when(_is_ascii(c), F.upper(c)).otherwise(mapped)


def _is_ascii(c: Column) -> Column:
    # One byte per character. Such texts take the fast built-in, which agrees on them.
    return F.octet_length(c) == F.length(c)


def unicode_upper(c: Column) -> Column:
    """Upper-case with full Unicode rules (sharp s becomes SS)."""
    return F.upper(c)


def or_default(c: Column, default: str) -> Column:
    """Replace null and the empty string; a text of blanks is kept."""
    return F.when(c.isNull() | (c == ""), F.lit(default)).otherwise(c)


def iso_day(c: Column) -> Column:
    """Calendar day as written: the first ten characters, whatever the offset says."""
    return F.substring(c, 1, 10)
