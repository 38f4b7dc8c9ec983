"""Timestamp parsing (P8, P9); results are wall-clock ``timestamp_ntz``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from newslake.constants import WEEKDAY_ABBREVIATIONS, ZONE_LABELS, ZONE_OFFSETS

ISO_Z_FRACTION = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
SPACE_SECONDS = "yyyy-MM-dd HH:mm:ss"
ISO_T_SECONDS = "yyyy-MM-dd'T'HH:mm:ss"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _ntz(s: Column, fmt: str, whole_seconds: bool = False) -> Column:
    """Parse ``s`` with ``fmt`` straight to a wall-clock ``timestamp_ntz``.

    The text is parsed as a UTC instant (an explicit ``+0000`` is appended)
    and rebuilt from its epoch microseconds, so the session time zone never
    shifts it (a local time inside a DST gap stays as written).
    """
    instant = F.try_to_timestamp(F.concat(s, F.lit(" +0000")), F.lit(fmt + " Z"))
    micros = F.unix_micros(instant)
    if whole_seconds:
        micros = micros - F.pmod(micros, F.lit(1_000_000))
    return F.timestamp_add("MICROSECOND", micros, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def _in_zone(wall: Column, minutes: Column, zone: str) -> Column:
    """Wall clock of ``zone`` for one written with an offset (in minutes; null: none, as is)."""
    utc = F.timestamp_add("MINUTE", -minutes, wall)
    return F.when(minutes.isNull(), wall).otherwise(F.convert_timezone(F.lit("UTC"), F.lit(zone), utc))


def parse_meta_time(v, zone: str | None = None) -> Column:
    """One meta value.

    If the text before the first comma is a single alphabetic word, it is the
    RFC-822-like form: zone labels are stripped (not converted) and the weekday
    dropped before parsing ``d MMM yyyy HH:mm:ss``.  Otherwise ISO-8601; an
    explicit offset is dropped and the wall clock kept.  With ``zone`` a label
    (``ZONE_OFFSETS``) or an offset is converted instead, to that zone's wall clock;
    values without either stay as written.
    """
    s = F.trim(_c(v))
    head = F.trim(F.split_part(s, F.lit(","), F.lit(1)))
    # Text before the first comma is one alphabetic word -> the RFC form,
    # which only parses with an English weekday abbreviation.
    rfc_form = s.contains(",") & F.regexp_like(head, F.lit(r"^\p{L}+$"))
    weekday_ok = F.lower(head).isin(WEEKDAY_ABBREVIATIONS)
    stripped = s
    for label in ZONE_LABELS:
        stripped = F.replace(stripped, F.lit(label), F.lit(""))
    stripped = F.trim(F.regexp_replace(stripped, r"^\s*\p{L}+,\s*", ""))
    rfc = F.when(weekday_ok, _ntz(stripped, "d MMM yyyy HH:mm:ss"))
    # A whole date is required; the basic form (20240105T101500) is written out first.
    plain = F.regexp_replace(s, r"(?<=[T ].{2,40})(Z|[+-]\d{2}:?\d{2})$", "")
    plain = F.regexp_replace(plain, r"^(\d{4})(\d{2})(\d{2})(?=$|[T ])", "$1-$2-$3")
    plain = F.regexp_replace(plain, r"(?<=[T ])(\d{2})(\d{2})(\d{2})(?=$|\.)", "$1:$2:$3")
    iso = F.when(plain.rlike(r"^\d{4}-\d{2}-\d{2}($|[T ])"), plain.try_cast("timestamp_ntz"))
    if zone is not None:
        label = F.coalesce(*[F.when(F.contains(s, F.lit(k)), F.lit(m)) for k, m in ZONE_OFFSETS.items()])
        offset = F.regexp_extract(s, r"[T ].{2,40}?(Z|[+-]\d{2}:?\d{2})$", 1)
        minutes = F.substring(offset, 2, 2).cast("int") * 60 + F.substring(offset, -2, 2).cast("int")
        minutes = F.when(offset == "Z", F.lit(0)).when(F.length(offset) > 1, F.when(F.startswith(offset, F.lit("-")), -minutes).otherwise(minutes))
        rfc, iso = _in_zone(rfc, label, zone), _in_zone(iso, minutes, zone)
    return F.when(rfc_form, rfc).otherwise(iso)


def parse_body_date(text) -> Column:
    """Body date text such as ``January 5, 2024`` (dashes removed first)."""
    body = F.trim(F.regexp_replace(F.replace(_c(text), F.lit("-"), F.lit("")), r"\s+", " "))
    return F.when(body != "", _ntz(body, "MMMM d, yyyy"))


def publish_time_parse(meta, body_text=None, zone: str | None = None) -> Column:
    """Ordered multi-format parse of one meta value, then the body date text."""
    first = parse_meta_time(meta, zone)
    return first if body_text is None else F.coalesce(first, parse_body_date(body_text))


def publish_time_parse_array(metas, body_text=None, zone: str | None = None) -> Column:
    """As :func:`publish_time_parse` over an array of meta values: the first
    value that parses wins, then the body date text."""
    parsed = F.filter(F.transform(_c(metas), lambda v: parse_meta_time(v, zone)), lambda x: x.isNotNull())
    first = F.try_element_at(parsed, F.lit(1))
    return first if body_text is None else F.coalesce(first, parse_body_date(body_text))


def api_time_parse(text, fmt: str) -> Column:
    """Listing timestamp text -> struct(date, publish_time), second precision."""
    ts = _ntz(_c(text), fmt, whole_seconds=True)
    return F.struct(F.to_date(ts).alias("date"), ts.alias("publish_time"))
