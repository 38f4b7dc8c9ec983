"""Column -> Column helpers (all Catalyst built-ins, codegen-friendly)."""

from newslake.functions.dates import date_spine, date_to_text
from newslake.functions.text import (boilerplate_cut, fill_defaults, tags_from_hrefs, tags_normalise,
                                     tags_to_array, tokenise, whitespace_collapse)
from newslake.functions.timeparse import api_time_parse, publish_time_parse
from newslake.functions.urls import article_key, url_absolute, url_category, url_parts

__all__ = [
    "api_time_parse", "article_key", "boilerplate_cut", "date_spine", "date_to_text", "fill_defaults",
    "publish_time_parse", "tags_from_hrefs", "tags_normalise", "tags_to_array", "tokenise",
    "url_absolute", "url_category", "url_parts", "whitespace_collapse",
]
