"""Row keys and identifier-safe names."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions._columns import as_column, as_list

# Keys hash to the same digest elsewhere only with this null marker and separator.
SURROGATE_NULL = "_dbt_utils_surrogate_key_null_"
SURROGATE_SEPARATOR = "-"


def surrogate_key(fields, nulls_as_empty: bool = False) -> Column:
    """MD5 over the fields as text; nulls hash as a marker, or as '' on request."""
    marker = F.lit("" if nulls_as_empty else SURROGATE_NULL)
    texts = [F.coalesce(as_column(field).cast("string"), marker) for field in as_list(fields)]
    return F.md5(F.concat_ws(SURROGATE_SEPARATOR, *texts))


def composite_key(*fields, separator: str = "_") -> Column:
    """Fields joined by ``separator``; null fields are left out."""
    return F.concat_ws(separator, *[as_column(field) for field in fields])


def slug(text: str | None) -> str:
    """``text`` as an identifier, for naming columns."""
    if not text:
        return ""
    cleaned = re.sub("[^a-z0-9_]+", "", re.sub("[ -]+", "_", text.lower()))
    return f"_{cleaned}" if cleaned[:1].isdigit() else cleaned


def slugify(column) -> Column:
    """The same rule as ``slug`` for a string column; null gives ''."""
    words = F.regexp_replace(F.lower(as_column(column)), "[ -]+", "_")
    cleaned = F.regexp_replace(words, "[^a-z0-9_]+", "")
    return F.coalesce(F.regexp_replace(cleaned, "^([0-9])", "_$1"), F.lit(""))
