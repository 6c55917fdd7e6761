"""Pages pulled from the upstream queue: flatten and normalise their messages."""

from pyspark.sql import functions as F

from flowtally.operators.decode import is_one_value
from flowtally.schemas import MQ_PAGE

_JSON_OPTIONS = {"mode": "PERMISSIVE", "allowSingleQuotes": "false"}
# Numbers that a parsed value would print in another way: fractions, exponents, many digits.
_SPELT_NUMBER = r"[0-9][.eE]|[0-9]{18}"


def _parsed(pages):
    return pages.select("partition", "value", F.from_json("value", MQ_PAGE, _JSON_OPTIONS).alias("page"))


def explode_pages(pages):
    """Page rows (partition, value = page JSON) -> one row per message.

    A page that cannot be read or has no message list gives one row without
    offset whose body is the page's text; :func:`split_normalised` rejects it.
    A page with an empty list gives none.
    """
    unreadable = F.array(F.struct(F.col("value").alias("body"), F.lit(None).cast("bigint").alias("offset")))
    entries = _parsed(pages).select(
        "partition", F.explode(F.coalesce("page.list", unreadable)).alias("entry"))
    return entries.select("partition", F.col("entry.offset").alias("offset"),
                          F.col("entry.body").alias("body"))


def read_pages(pages):
    """Per readable page its partition and ``nextOffset``."""
    return _parsed(pages).select("partition", F.col("page.nextOffset").alias("nextOffset"))


def next_positions(pages):
    """Per partition the position after its readable pages: the highest ``nextOffset``."""
    return _parsed(pages).groupBy("partition").agg(F.max("page.nextOffset").alias("nextOffset"))


def normalise(messages):
    """Strip every backslash, keep what is valid JSON, print it compactly.

    ``value`` is the compact text, or NULL where the stripped body is not one
    JSON value; ``body`` stays for the quarantine. Parsing the body as the only
    element of an array makes text after the value an error. The compact form
    orders keys by name, except where a number's spelling could be lost: such a
    body only loses its blanks. Whether a repeated key is an error or its last
    value counts is the session's ``spark.sql.variant.allowDuplicateKeys``.
    """
    stripped = F.translate("body", "\\", "")
    array = F.try_parse_json(F.concat(F.lit("["), stripped, F.lit("]")))
    # The generator keeps the parse from being copied into later filters.
    parsed = messages.select("*", F.explode_outer(F.array(array)).alias("_array"))
    first = F.variant_get("_array", "$[0]", "variant")
    single = F.variant_get("_array", "$[1]", "variant").isNull() & is_one_value(stripped)
    # Without backslashes a string ends at its next quote.
    blanks_out = F.regexp_replace(stripped, r'("[^"]*")|\s+', "$1")
    value = F.when(stripped.rlike(_SPELT_NUMBER), F.when(first.isNotNull(), blanks_out)).otherwise(F.to_json(first))
    return parsed.withColumn("value", F.when(single, value)).drop("_array")


def split_normalised(normalised):
    """(good messages, quarantine)."""
    fit = F.col("value").isNotNull() & F.col("offset").isNotNull()
    good = normalised.filter(fit).drop("body")
    bad = normalised.filter(~fit).drop("value").withColumn(
        "reject", F.when(F.col("offset").isNull(), "bad_page").otherwise("malformed_json"))
    return good, bad


def as_frame(good, topic):
    """Normalised messages -> common frame, keyed by topic."""
    return good.select(
        F.lit(topic).alias("key"), "value", F.lit(topic).alias("topic"), "partition", "offset",
        F.lit(None).cast("timestamp").alias("timestamp"),
    )
