"""Text and tag expressions."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newslake.constants import NO_CONTENT_FOUND, NO_TITLE_FOUND, UNKNOWN

# Python's str.strip() removes surrounding whitespace of any kind.
_EDGE_WS = r"^\s+|\s+$"
# What ``$`` may stand before, besides the end of the text, and ``\s`` does not take.
_LAST = ["\u0085", "\u2028", "\u2029"]


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is evaluated once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def replaced(text: Column, pattern: str, by: str, *signs: str) -> Column:
    """``regexp_replace`` of a text that holds one of the ``signs``, without which the pattern
    matches nowhere; any other text is only looked through for them."""
    def body(t: Column) -> Column:
        held = [F.contains(t, F.lit(s)) for s in signs]
        return F.when(functools.reduce(lambda a, b: a | b, held), F.regexp_replace(t, pattern, by)).otherwise(t)

    return let(text, body)


def strip_ws(x) -> Column:
    """``_EDGE_WS`` removed; only a text with an odd end is searched from end to end for it."""
    x = _c(x)
    return F.when(F.substring(x, -1, 1).isin(_LAST), F.regexp_replace(x, _EDGE_WS, "")).otherwise(F.btrim(x, F.lit(" \t\n\x0b\f\r")))


def tags_normalise(tags) -> Column:
    """Split on commas, strip each piece, drop empties, re-join with ','.
    NULL (non-text) becomes ''."""
    pieces = F.transform(F.split(_c(tags), ","), strip_ws)
    return F.coalesce(F.array_join(F.filter(pieces, lambda t: t != ""), ","), F.lit(""))


def tags_from_hrefs(hrefs, marker: str = "/tag/") -> Column:
    """Keep hrefs containing ``marker``; take the text after its first
    occurrence up to the next; join with ', '."""
    kept = F.filter(_c(hrefs), lambda h: h.contains(marker))
    return F.array_join(F.transform(kept, lambda h: F.split_part(h, F.lit(marker), F.lit(2))), ", ")


def tags_to_array(tags) -> Column:
    """Staging form: comma text -> array<string>, pieces not trimmed."""
    return F.split(_c(tags), ",")


DEFAULTS = {"title": NO_TITLE_FOUND, "author": UNKNOWN, "category": UNKNOWN, "content": NO_CONTENT_FOUND}


def fill_defaults(df: DataFrame, defaults: dict[str, str] | None = None) -> DataFrame:
    """Per-column defaults for NULL values (absent JSON keys arrive as NULL)."""
    d = {k: v for k, v in (defaults or DEFAULTS).items() if k in df.columns}
    return df.withColumns({k: F.coalesce(F.col(k), F.lit(v)) for k, v in d.items()})


def whitespace_collapse(text) -> Column:
    """Three or more newlines -> two, runs of spaces -> one, strip the ends."""
    t = replaced(_c(text), r"\n{3,}", "\n\n", "\n\n\n")
    return let(replaced(t, " {2,}", " ", "  "), strip_ws)


def boilerplate_cut(text, marker: str) -> Column:
    """Text before ``marker``, blank-line pairs -> a space, spaces trimmed."""
    return F.trim(F.replace(F.split_part(_c(text), F.lit(marker), F.lit(1)), F.lit("\n\n"), F.lit(" ")))


def title_cut(text) -> Column:
    """Title clean-up used with :func:`boilerplate_cut`."""
    return F.trim(F.replace(_c(text), F.lit("\n\n"), F.lit(" ")))


# Word tokens: split on anything that is not a letter, digit, '_', '-' or an
# apostrophe; quotes around a word and the clitics a treebank tokeniser splits
# off ("don't" -> "do", "it's" -> "it") are removed; then only purely
# alphabetic tokens are kept, so mixed tokens ("co2", "foo-bar") drop whole.
TOKEN_SPLIT = r"[^\p{L}\p{N}_'\-]+"
CLITIC = r"(?i)(n't|'s|'m|'re|'ve|'ll|'d)$"
ALPHA_TOKEN = r"^\p{L}+$"


def strip_clitics(t: Column) -> Column:
    t = F.regexp_replace(t, r"^'+", "")
    t = F.regexp_replace(t, CLITIC, "")
    return F.regexp_replace(t, r"'+$", "")


def tokenise(df: DataFrame, id_col: str, text_col: str, lower: bool = True,
             keep_case_col: str | None = None, carry: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """text -> rows (id, pos, token): alphabetic word tokens with position.

    ``pos`` is the 1-based index of the raw piece in the split text, so it
    orders tokens by first occurrence.  With ``keep_case_col`` the token
    before lower-casing is kept too (stopword tests are case-sensitive).
    ``carry`` columns of the document ride along on every token, so callers
    never join the token stream back to its documents.
    """
    # Explode first, then clean each piece: plain column expressions stay in
    # whole-stage codegen (a lambda over the array would not), and the
    # clitic regexes only run on the few pieces holding an apostrophe.
    out = df.select(F.col(id_col), *[F.col(c) for c in carry],
                    F.posexplode(F.split(F.col(text_col), TOKEN_SPLIT)).alias("pos", "piece"))
    piece = F.col("piece")
    out = out.withColumn("piece", F.when(piece.contains("'"), strip_clitics(piece)).otherwise(piece))
    out = out.filter(F.col("piece").rlike(ALPHA_TOKEN)).withColumn("pos", F.col("pos") + 1)
    cols = [F.col(id_col), *[F.col(c) for c in carry], "pos"]
    if keep_case_col:
        cols.append(F.col("piece").alias(keep_case_col))
    cols.append((F.lower("piece") if lower else F.col("piece")).alias("token"))
    return out.select(*cols)
