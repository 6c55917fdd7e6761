"""IPv4 text to number."""

from pyspark.sql import functions as F

# Exactly four octets of 0..255.
_OCTET = r"(25[0-5]|2[0-4]\d|[01]?\d?\d)"
_QUAD = rf"\A{_OCTET}(\.{_OCTET}){{3}}\z"


def octets(text):
    """Parts of a dotted quad; NULL where ``text`` is not one."""
    return F.when(text.rlike(_QUAD), F.split(text, r"\."))


def octets_number(parts):
    """0..2^32-1 from the parts. Keep ``parts`` a column of its own: it is used four times."""
    number = F.lit(0).cast("bigint")
    for i in (1, 2, 3, 4):
        number = number * 256 + F.element_at(parts, F.lit(i)).cast("bigint")
    return number
