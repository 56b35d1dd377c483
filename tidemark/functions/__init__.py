from tidemark.functions.dates import boundary_count, month_start, shift, to_date_or_null
from tidemark.functions.keys import SURROGATE_NULL, composite_key, slug, slugify, surrogate_key
from tidemark.functions.maths import (
    haversine,
    percent_change,
    radians,
    round_scaled,
    safe_add,
    safe_divide,
    safe_subtract,
    width_bucket,
)
from tidemark.functions.text import blank_to_null, bool_to_text, format_kpi, safe_cast, trend_label
from tidemark.functions.web import url_host, url_parameter, url_path

__all__ = [
    "SURROGATE_NULL",
    "blank_to_null",
    "bool_to_text",
    "boundary_count",
    "composite_key",
    "format_kpi",
    "haversine",
    "month_start",
    "percent_change",
    "radians",
    "round_scaled",
    "safe_add",
    "safe_cast",
    "safe_divide",
    "safe_subtract",
    "shift",
    "slug",
    "slugify",
    "surrogate_key",
    "to_date_or_null",
    "trend_label",
    "url_host",
    "url_parameter",
    "url_path",
    "width_bucket",
]
