"""User identifiers in one canonical text form."""

from pyspark.sql import functions as F

# Stand-ins for a missing user in the two feeds.
NO_USER_HLS = "no_user_keyword"
NO_USER_RTMP = "-1"


def hls_user(raw):
    """Whole numbers lose leading zeros and blanks; other text stays as it is."""
    return F.coalesce(raw.try_cast("bigint").cast("string"), raw, F.lit(NO_USER_HLS))


def rtmp_user(raw):
    return F.coalesce(raw, F.lit(NO_USER_RTMP))
