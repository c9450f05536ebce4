"""Number rules: prefix casts, money rounding and guarded ratios."""

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,4)"

# Longest numeric prefix after leading white space.
REAL_PREFIX = r"^\s*([+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?)"


def real_prefix(c: Column, to: str = "double") -> Column:
    """REAL cast of a text: its numeric prefix, 0 without one, NULL for NULL.

    With a decimal ``to``, a number too large for the type becomes NULL, never 0.
    """
    prefix = F.regexp_extract(c, REAL_PREFIX, 1)
    return F.when(prefix == "", F.lit(0).cast(to)).otherwise(prefix.try_cast(to))


def cents(c: Column, to: str = "decimal(28,2)") -> Column:
    """Round a decimal half up to two places."""
    return F.round(c, 2).cast(to)


def line_total(quantity: Column, unit_price: Column) -> Column:
    """Quantity times price in cents, NULL if it does not fit the money type."""
    return F.round(F.try_multiply(quantity, unit_price), 2).try_cast(MONEY)


def ratio(a: Column, b: Column, to: str = "decimal(18,2)") -> Column:
    """a / b in cents, 0 when b is not positive."""
    quotient = (a / F.when(b > 0, b)).cast("decimal(38,10)")
    return F.coalesce(F.round(quotient, 2), F.lit(0)).cast(to)


def percentage(part: Column, whole: Column) -> Column:
    """100 * part / whole with two places, 0 when the whole is empty."""
    return ratio((F.lit(100) * part).cast("decimal(24,2)"), whole, "decimal(5,2)")
