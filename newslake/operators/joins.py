"""Joins (J1-J6)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newslake.constants import ENGLISH_STOPWORDS


def new_only(incoming: DataFrame, stored: DataFrame, key: str = "id") -> DataFrame:
    """Incoming records whose key is not already stored.

    Only the key column of ``stored`` is read (column pruning reaches the
    scan); the planner picks shuffle vs broadcast from measured sizes.
    """
    return incoming.join(stored.select(key).where(F.col(key).isNotNull()), on=key, how="left_anti")


def record_exists(probe: DataFrame, stored: DataFrame, key: str = "id", flag: str | None = None) -> DataFrame:
    """Bulk existence test. Without ``flag``: probe rows that exist
    (semi-join). With ``flag``: every probe row plus a boolean column."""
    ids = stored.select(key).where(F.col(key).isNotNull())
    if flag is None:
        return probe.join(ids, on=key, how="left_semi")
    marked = ids.distinct().withColumn(flag, F.lit(True))
    return probe.join(marked, on=key, how="left").withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))


def listing_detail(listing: DataFrame, detail: DataFrame, key: str, mode: str = "left",
                   defaults: dict[str, str] | None = None) -> DataFrame:
    """Pair listing rows with their detail record.

    ``mode="left"``: a missing detail gets the default values;
    ``mode="inner"``: a missing detail drops the listing row.
    """
    if mode == "inner":
        return listing.join(detail, on=key, how="inner")
    out = listing.join(detail, on=key, how="left")
    for c, v in (defaults or {}).items():
        out = out.withColumn(c, F.coalesce(F.col(c), F.lit(v)))
    return out


def tag_lookup(df: DataFrame, id_col: str, tag_ids_col: str, tags: DataFrame, tag_id: str = "id",
               slug: str = "slug", out_col: str = "tags", sep: str = ",") -> DataFrame:
    """Resolve an array of tag ids to their slugs, joined in the original
    order (ties on equal positions broken by the slug); unmatched ids drop.
    Rows whose tags all fail to resolve get ''.

    Resolved tags are regrouped on 128 bits that stand for the row's own (id, tag
    ids), so the lists travel in no shuffle key, with a set aggregate: copies of one
    row reduce map-side, so even an id repeated in a third of the rows never builds
    a group larger than its own tag list, and two rows with the same id but
    different lists stay apart.
    """
    keyed = df.withColumns({"_k1": F.xxhash64(id_col, tag_ids_col), "_k2": F.xxhash64(F.lit("tags"), id_col, tag_ids_col)})
    exploded = keyed.select("_k1", "_k2", F.posexplode(tag_ids_col).alias("_pos", "_tag"))
    dim = tags.select(F.col(tag_id).alias("_tag"), F.col(slug).alias("_slug"))
    resolved = (exploded.join(dim, on="_tag", how="inner")
                .groupBy("_k1", "_k2")
                .agg(F.array_join(F.transform(F.array_sort(F.collect_set(F.struct("_pos", "_slug"))),
                                              lambda s: s["_slug"]), sep).alias("_tags")))
    return keyed.join(resolved, ["_k1", "_k2"], "left").withColumn(out_col, F.coalesce(F.col("_tags"), F.lit(""))).drop("_k1", "_k2", "_tags")


def stopword_anti(tokens: DataFrame, col: str = "token", stopwords=ENGLISH_STOPWORDS, case_sensitive: bool = True) -> DataFrame:
    """Drop stopword tokens; with ``case_sensitive`` (as the source does) "The" is
    none.  The list is fixed and small, so it compiles to an in-set hash probe rather
    than a join."""
    if case_sensitive:
        return tokens.filter(~F.col(col).isin(list(stopwords)))
    return tokens.filter(~F.lower(F.col(col)).isin(sorted({w.lower() for w in stopwords})))


def lemma_lookup(tokens: DataFrame, lemmas: DataFrame, col: str = "token", word: str = "word",
                 lemma: str = "lemma", out_col: str = "lemma") -> DataFrame:
    """Token -> lemma via a user-supplied table; unknown tokens map to
    themselves.  Adaptive execution picks the join from measured sizes."""
    # One lemma per word; a word listed twice takes the smallest lemma.
    table = lemmas.groupBy(F.col(word).alias("_w")).agg(F.min(lemma).alias("_l"))
    out = tokens.join(table, tokens[col] == table["_w"], "left")
    return out.withColumn(out_col, F.coalesce(F.col("_l"), F.col(col))).drop("_w", "_l")
