"""URL columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Path segments that name a kind of service.
SERVER_SEGMENTS = "FeatureServer|MapServer|ImageServer|SceneServer"
# RFC 3986 appendix B: scheme, authority, path, query, fragment.
_PARTS = r"^(?:([^:/?#]+):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"


def _part(url: Column, index: int) -> Column:
    return F.regexp_extract(url, _PARTS, index)


def is_layer_url(url: Column) -> Column:
    """A layer URL ends with its numeric id."""
    return url.rlike("[0-9]+$")


def scrub_url(url: Column) -> Column:
    """Token values in the query part replaced by ``***``; the rest unchanged."""
    head = F.regexp_extract(url, r"^([^?#]*)(\?[^#]*)?(#.*)?$", 1)
    query = F.regexp_extract(url, r"^([^?#]*)(\?[^#]*)?(#.*)?$", 2)
    tail = F.regexp_extract(url, r"^([^?#]*)(\?[^#]*)?(#.*)?$", 3)
    return F.when(
        F.length(query) > 1,
        F.concat(head, F.regexp_replace(query, r"(?i)([?&])(token)=[^&#]*", "$1$2=***"), tail),
    ).otherwise(url)


def host_key(url: Column) -> Column:
    """``scheme://host`` — the unit of politeness towards a server."""
    return F.concat(F.lower(_part(url, 1)), F.lit("://"), _part(url, 2))


def service_root(url: Column) -> Column:
    """The URL up to its server-type segment, else its host key."""
    root = F.regexp_extract(_part(url, 3), rf"(?i)^(.*?/(?:{SERVER_SEGMENTS}))", 1)
    return F.concat(host_key(url), root)
