"""Parts of a URL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions._columns import as_column


def _without(url: Column, *schemes: str) -> Column:
    return reduce(lambda text, scheme: F.replace(text, F.lit(scheme), F.lit("")), schemes, url)


def _before(text: Column, mark: str) -> Column:
    return F.split_part(text, F.lit(mark), F.lit(1))


def url_host(url) -> Column:
    """Text between the scheme and the first '/' or '?'."""
    bare = _without(as_column(url), "android-app://", "http://", "https://")
    return _before(_before(bare, "/"), "?")


def url_path(url) -> Column:
    """Text after the first '/' up to '?'; a URL with neither gives its whole host."""
    bare = _without(as_column(url), "http://", "https://")
    slash = F.position(F.lit("/"), bare)
    after_slash = F.substring(bare, slash + 1, F.length(bare))
    tail = (
        F.when(slash > 0, after_slash)
        .when(F.position(F.lit("?"), bare) > 0, F.lit(""))
        .otherwise(bare)
    )
    return _before(tail, "?")


def url_parameter(url, name: str, strict: bool = False) -> Column:
    """Value after ``name=`` up to '&', null if empty or absent.

    By default this is a plain text search, so ``ref`` is also found inside ``xref=``
    and a fragment stays attached; ``strict`` reads the query string properly.
    """
    url = as_column(url)
    if strict:
        return F.nullif(F.try_parse_url(url, F.lit("QUERY"), F.lit(name)), F.lit(""))
    value = _before(F.split_part(url, F.lit(f"{name}="), F.lit(2)), "&")
    return F.nullif(value, F.lit(""))
