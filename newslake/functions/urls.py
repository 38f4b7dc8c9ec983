"""URL decomposition."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# urlparse-like split that never fails: authority only after '//', path up to
# the query or fragment.
AUTHORITY_RE = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)"
PATH_RE = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)"


def url_authority(url) -> Column:
    return F.regexp_extract(_c(url), AUTHORITY_RE, 1)


def url_path(url) -> Column:
    """Path without query/fragment and without ``;params`` of the last segment
    (as ``urlparse`` splits them off for web schemes)."""
    return F.regexp_replace(F.regexp_extract(_c(url), PATH_RE, 1), r";[^/]*$", "")


def url_parts(url) -> Column:
    """struct(subdomain, origin, article_id, slug).

    Host labels come from the full authority (port and user info kept, like a
    netloc); the path is stripped of leading/trailing slashes and cut once at
    the first remaining slash.
    """
    labels = F.split(url_authority(url), r"\.")
    path = F.regexp_replace(url_path(url), r"^/+|/+$", "")
    segs = F.split(path, "/", 2)
    return F.struct(
        F.try_element_at(labels, F.lit(1)).alias("subdomain"),
        F.coalesce(F.try_element_at(labels, F.lit(2)), F.lit("")).alias("origin"),
        F.try_element_at(segs, F.lit(1)).alias("article_id"),
        F.coalesce(F.try_element_at(segs, F.lit(2)), F.lit("")).alias("slug"),
    )


def article_key(parts) -> Column:
    """``subdomain:article_id:slug`` from a :func:`url_parts` struct; NULL without a URL."""
    p = _c(parts)
    return F.when(p["subdomain"].isNotNull(), F.concat_ws(":", p["subdomain"], p["article_id"], p["slug"]))


def url_absolute(path, root: str) -> Column:
    """Prefix a relative link with the site root (plain concatenation)."""
    return F.concat(F.lit(root), _c(path))


def url_category(url) -> Column:
    """First path segment of the link ('' for a bare '/', NULL without a path)."""
    return F.try_element_at(F.split(url_path(url), "/"), F.lit(2))
