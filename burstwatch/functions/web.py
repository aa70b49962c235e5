"""URLs: stable ids, page links and domains."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from burstwatch.functions.text import strip

# Fixed value: where page titles resolve.
PAGE_BASE_URL = "https://en.wikipedia.org/wiki/"


def stable_id(url: Column) -> Column:
    return F.sha2(strip(url), 256)


def page_url(page_title: Column) -> Column:
    """Link to a page: blanks become underscores, "/" and "~" stay, the rest is escaped."""
    path = F.url_encode(F.replace(page_title, F.lit(" "), F.lit("_")))
    for encoded, wanted in (("%2F", "/"), ("%7E", "~"), ("*", "%2A")):
        path = F.replace(path, F.lit(encoded), F.lit(wanted))
    return F.when(page_title != "", F.concat(F.lit(PAGE_BASE_URL), path))


def url_domain(url: Column) -> Column:
    """The authority (user, host and port) of a URL; null when there is none."""
    authority = F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)", 1)
    return F.nullif(authority, F.lit(""))
