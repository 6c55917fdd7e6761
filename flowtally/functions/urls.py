"""Request-line parsing: application, stream and slice length."""

from pyspark.sql import functions as F


def is_media(url):
    """True for playlist and segment requests, NULL-safe."""
    return F.coalesce(url.contains(".m3u8") | url.contains(".ts"), F.lit(False))


def tokens(url):
    """Tokens between runs of slashes and blanks; a leading run leaves an empty token."""
    return F.split(url, "[/ ]+")


def playlist_app(t):
    return F.try_element_at(t, F.lit(2))


def playlist_stream(t):
    """Third token up to its first dot, then up to its first double underscore."""
    name = F.try_element_at(t, F.lit(3))
    return F.substring_index(F.substring_index(name, ".", 1), "__", 1)


def segment_app(t):
    """Second token, or the third in an absolute URL; NULL with fewer than three tokens."""
    absolute = F.array_contains(t, "http:")
    return F.when(
        F.size(t) >= 3,
        F.when(absolute, F.try_element_at(t, F.lit(3))).otherwise(F.try_element_at(t, F.lit(2))),
    )


def segment_parts(t):
    """Dash-separated parts of the file name, the third token from the end."""
    return F.split(F.try_element_at(t, F.lit(-3)), "-")


def segment_stream(parts):
    return F.try_element_at(parts, F.lit(2))


def segment_slice(parts):
    """Slice length: the last part up to its first dot, still text."""
    return F.substring_index(F.try_element_at(parts, F.lit(-1)), ".", 1)
