"""newslake — article-trend analytics on Spark.

Every operator takes DataFrames (plus parameters) and returns a DataFrame.
Heavy lifting stays inside Catalyst expressions; the only Python crossing is
the Arrow-batched HTML parse in :mod:`newslake.operators.html`.
"""

from newslake.schema import ARTICLE_SCHEMA, CONTENT_COLUMNS, KEY_COLUMNS, conform_articles
from newslake.session import build_session, shared_path

__all__ = [
    "ARTICLE_SCHEMA",
    "CONTENT_COLUMNS",
    "KEY_COLUMNS",
    "build_session",
    "conform_articles",
    "shared_path",
]
