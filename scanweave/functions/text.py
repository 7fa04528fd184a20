"""Column expressions on host names and URLs."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Optional scheme and "//", optional user part, then the host up to a port,
# path, query or fragment.
_NETLOC = r"\A(?:(?:[A-Za-z0-9+.\-]+:)?//)?(?:[^/?#]*@)?([^/?#@:]*)"

# The dots that IDNA treats like a full stop.
_IDEOGRAPHIC_DOTS = "。．｡"

# Form encoding on the left, the wanted URL text on the right.
_FORM_TO_URL = [
    ("+", "%20"),
    ("*", "%2A"),
    ("%7E", "~"),
    ("%3A", ":"),
    ("%2F", "/"),
    ("%3F", "?"),
    ("%3D", "="),
    ("%26", "&"),
]


def strip_dot(name: Column) -> Column:
    """Without one trailing dot."""
    return F.regexp_replace(name, r"\.\z", "")


def strip_dots(name: Column) -> Column:
    """Without all trailing dots and blanks."""
    return F.rtrim(name, F.lit(". "))


def ascii_dots(name: Column) -> Column:
    return F.translate(name, _IDEOGRAPHIC_DOTS, "." * len(_IDEOGRAPHIC_DOTS))


def url_host(url: Column) -> Column:
    """Host part of a URL or of anything shaped like one; '' where there is none."""
    host = F.regexp_extract(url, _NETLOC, 1)
    host = F.regexp_replace(host, r"(?U)\A\s+|\s+\z", "")
    return F.rtrim(ascii_dots(host), F.lit("."))


def quote_url(url: Column) -> Column:
    """Percent-encoded URL that keeps ``:/?=&``; '' for null. ``%`` is encoded again."""
    quoted = F.url_encode(url)
    for form, wanted in _FORM_TO_URL:
        quoted = F.replace(quoted, F.lit(form), F.lit(wanted))
    return F.coalesce(quoted, F.lit(""))
