"""Column functions (scalar expressions) of the catalog."""

from .text import (  # noqa: F401
    cents_to_price, descriptions, fill_null, full_audio_languages, join_list,
    list_size, owners_text, owners_upper_bound, percent, price_to_float,
    release_year, released_date, safe_int, sanitize_text, split_literal,
    size_or_null, split_strip, strip_each, strip_ws, supported_languages, tags_map, whole_number,
)
