"""Numbers that arrive as text, or as JSON numbers in any spelling.

A pattern decides whether a text is a number at all; conversions give NULL
where the value does not fit, so a check and a conversion never disagree.
"""

from pyspark.sql import functions as F

from flowtally.schemas import FRACTION_TYPE

# Decimal notation, maybe with an exponent. Type suffixes, hex floats, NaN and Infinity are out.
_NUMBER = r"^\s*[-+]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][-+]?[0-9]{1,4})?\s*$"
# Epoch seconds: at most eleven digits (ten if negative), or an exponent up to 10.
_EPOCH = (
    r"^ *([+]?[0-9]{1,11}|-[0-9]{1,10})(\.[0-9]*)? *$"
    r"|^ *[+]?[0-9](\.[0-9]*)?[eE][+]?([0-9]|10) *$"
)


def whole(text):
    """Whole part of a number as bigint; NULL for other text and beyond the bigint range.

    Text that is not digits alone is read as a decimal, which takes fractions
    and exponents and no other text; what it rounds off lies below 10^-18.
    """
    return F.coalesce(text.try_cast("bigint"), text.try_cast("decimal(38,18)").try_cast("bigint"))


def fraction(text):
    """A number as decimal; NULL for other text and beyond 10^18."""
    return text.try_cast(FRACTION_TYPE)


def is_seconds(text):
    """Whether a text is a number whose milliseconds fit a bigint."""
    return text.rlike(_NUMBER) & seconds_to_millis(text).isNotNull()


def is_epoch(text):
    return text.rlike(_EPOCH)


def seconds_to_millis(text):
    """Seconds -> whole milliseconds, truncated towards zero.

    The product is taken in IEEE doubles, so "1.001" gives 1000.
    """
    return (text.try_cast("double") * F.lit(1000.0)).try_cast("bigint")


def epoch_seconds(text):
    """Epoch seconds, maybe fractional -> bigint."""
    return F.floor(text.try_cast("double")).cast("bigint")
