"""Routing by topic and JSON decoding with a quarantine for what cannot be used."""

from pyspark.sql import functions as F

_JSON_OPTIONS = {
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": "_unreadable",
    "allowSingleQuotes": "false",
}
MESSAGE = ["key", "value", "topic", "partition", "offset", "timestamp"]
MALFORMED = "malformed_json"


def route(frame, topic):
    """Messages of one topic; messages without a topic column value go by key."""
    return frame.filter(F.coalesce("topic", "key") == topic)


def is_one_value(text):
    """False for text that breaks out of an array put around it; only text with a bracket is parsed."""
    in_object = F.try_parse_json(F.concat(F.lit('{"value":'), text, F.lit("}")))
    return F.when(text.contains("]"), in_object.isNotNull()).otherwise(True)


def decode(frame, record):
    """Parse ``value`` into the fields of ``record`` (name -> type) next to ``malformed``.

    ``malformed`` is false for one well-formed JSON object whose fields have
    the declared types. It is true for broken text, trailing text, a
    non-object, no value at all, or a field of the wrong type.

    The value is read as the only element of an array, so that text after the
    object is an error as well. Text with a closing bracket could end that array
    itself; it must be the value of an object's only field, too. The generators keep the parse a step of its
    own: filters further down read their output columns and Catalyst cannot
    copy the parse into them, so each message is parsed once.
    """
    wrapped = F.concat(F.lit('{"record":['), F.col("value"), F.lit("]}"))
    fields = ", ".join(f"{name}: {kind}" for name, kind in record.items())
    schema = f"record array<struct<{fields}>>, _unreadable string"
    parsed = frame.select("*", F.inline_outer(F.array(F.from_json(wrapped, schema, _JSON_OPTIONS))))
    usable = (
        is_one_value(F.col("value"))
        & F.col("_unreadable").isNull()
        & (F.size("record") == 1)
        & F.try_element_at("record", F.lit(1)).isNotNull()
    )
    flagged = parsed.select(
        *frame.columns,
        F.coalesce(~usable, F.lit(True)).alias("malformed"),
        F.slice("record", 1, 1).alias("record"),
    )
    return flagged.select(*frame.columns, "malformed", F.inline_outer("record"))


def quarantine(decoded, reason):
    """Messages with a ``reason``, as they came in."""
    return decoded.filter(reason.isNotNull()).select(*MESSAGE, reason.alias("reject"))


def unwrap_double_encoded(frame):
    """Undo one extra round of JSON encoding where a value is exactly one JSON string literal."""
    inner = F.from_json(F.concat(F.lit("["), F.col("value"), F.lit("]")), "array<string>")
    is_literal = (
        F.ltrim("value").startswith('"') & (F.size(inner) == 1) & is_one_value(F.col("value")))
    return frame.withColumn("value", F.when(is_literal, inner[0]).otherwise(F.col("value")))
