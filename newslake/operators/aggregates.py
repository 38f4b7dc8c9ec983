"""Aggregations (A1-A9). All are hash aggregates with a map-side partial
step, so a hot group is combined before the shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newslake.functions.dates import monday_of
from newslake.session import shared_path


def by_source(articles: DataFrame) -> DataFrame:
    """A1: per source: article count and distinct categories, busiest first."""
    return (articles.groupBy("source")
            .agg(F.count(F.lit(1)).alias("article_count"),
                 F.countDistinct("category").alias("unique_categories"))
            .orderBy(F.desc("article_count"), "source"))


def source_comparison(articles: DataFrame) -> DataFrame:
    """A2: per source: total, categories covered, mean content length,
    earliest and latest date."""
    return (articles.groupBy("source")
            .agg(F.count(F.lit(1)).alias("total_articles"),
                 F.countDistinct("category").alias("categories_covered"),
                 F.avg(F.length("content").cast("bigint")).alias("avg_article_length"),
                 F.min("date").alias("earliest_article"),
                 F.max("date").alias("latest_article")))


def daily_counts(articles: DataFrame, by: list[str] | None = None) -> DataFrame:
    """A3: count per date (optionally per date and further keys)."""
    keys = ["date"] + list(by or [])
    return articles.groupBy(*keys).agg(F.count(F.lit(1)).alias("daily_count"))


def weekly_counts(articles: DataFrame, by: list[str] | None = None) -> DataFrame:
    """A4: count per Monday-starting week (and category by default)."""
    keys = list(by if by is not None else ["category"])
    week = monday_of(F.col("date").cast("date")).alias("week")
    return articles.groupBy(*keys, week).agg(F.count(F.lit(1)).alias("weekly_count"))


def table_count(df: DataFrame) -> DataFrame:
    """A5: one-row row count."""
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def harvest_counters(links: DataFrame, known: DataFrame, date_col: str = "date",
                     order_cols: list[str] | None = None, key: str = "id") -> DataFrame:
    """Per index date: links accepted vs skipped.

    A link is skipped when its id is already stored or was already seen
    earlier in the run (arrival order = ``date_col`` then ``order_cols``).
    First arrival per id is an aggregate joined back, not a window, so a
    repeated id is combined map-side.
    """
    order = [date_col] + list(order_cols or [])
    arrival = F.struct(*[F.col(c) for c in order])
    first = links.groupBy(key).agg(F.min(arrival).alias("_first"))
    known_ids = known.select(key).where(F.col(key).isNotNull()).distinct().withColumn("_known", F.lit(True))
    marked = (links.withColumn("_arrival", arrival)
              .join(first, on=key, how="left")
              .join(known_ids, on=key, how="left"))
    accepted = F.col("_known").isNull() & (F.col("_arrival") == F.col("_first"))
    return (marked.groupBy(date_col)
            .agg(F.count_if(accepted).alias("accepted"), F.count_if(~accepted).alias("skipped")))


def listing_frontier(rows: DataFrame, start, section: str = "section", page: str = "page",
                     pos: str = "pos", ts: str = "ts", known: str = "known") -> DataFrame:
    """Which listing pages a newest-first paged harvest processes.

    Per section, pages are visited 1, 2, ... . Rows with no timestamp are
    skipped; inside a page rows are taken while newer than ``start``. The
    walk stops at the first page that is missing or has no in-range row
    (excluded), whose in-range rows are all known (excluded), or that reached
    an older row (included). Output: one row per processed page with
    in-range and new counts and the reached-old flag.
    """
    start_c = F.lit(start).cast("timestamp_ntz")
    timed = rows.filter(F.col(ts).isNotNull())
    stops = (timed.filter(F.col(ts) < start_c).groupBy(section, page)
             .agg(F.min(pos).alias("_stop_pos")))
    inpage = rows.join(stops, on=[section, page], how="left")
    in_range = (F.col(ts).isNotNull()
                & (F.col("_stop_pos").isNull() | (F.col(pos) < F.col("_stop_pos"))))
    pages = (inpage.groupBy(section, page)
             .agg(F.count_if(in_range).alias("n_in_range"),
                  F.count_if(in_range & ~F.coalesce(F.col(known), F.lit(False))).alias("n_new"),
                  F.max(F.col("_stop_pos").isNotNull()).alias("reached_old")))
    # The fold below asks the summaries several times; they are written once, so that the
    # rows themselves are scanned for the stops and for the counts and not again.
    path = shared_path(rows.sparkSession, "frontier_pages")
    pages.write.parquet(path)
    pages = rows.sparkSession.read.schema(pages.schema).parquet(path)
    stop_here = (F.col("n_in_range") == 0) | (F.col("n_new") == 0) | F.col("reached_old")
    included = (F.col("n_in_range") > 0) & (F.col("n_new") > 0) & F.col("reached_old")
    # A page number with no rows at all ends the walk too: the page after the
    # last page, or the first gap in numbering.
    nxt = pages.select(section, (F.col(page) - 1).alias(page), F.lit(True).alias("_has_next"))
    ends = (pages.join(nxt, on=[section, page], how="left").groupBy(section)
            .agg(F.min(page).alias("_first_page"),
                 F.min(F.when(stop_here, F.struct(F.col(page).alias("p"), included.alias("inc")))).alias("_stop"),
                 F.min(F.when(F.col("_has_next").isNull(), F.col(page))).alias("_last_page")))
    stop_page = F.col("_stop.p") - F.when(F.col("_stop.inc"), F.lit(0)).otherwise(F.lit(1))
    # A walk that does not begin with page 1 (or 0) finds nothing.
    end = (F.when(F.col("_first_page") > 1, F.lit(-1))
           .when(F.col("_stop").isNull() | (F.col("_last_page") < F.col("_stop.p")), F.col("_last_page")).otherwise(stop_page))
    return (pages.join(ends.select(section, end.alias("_end")), on=section)
            .filter(F.col(page) <= F.col("_end"))
            .select(section, page, "n_in_range", "n_new", "reached_old"))


def term_counts(tokens: DataFrame, id_col: str = "id", term: str = "token") -> DataFrame:
    """Occurrences of each term per article (with its first position)."""
    return (tokens.groupBy(id_col, term)
            .agg(F.count(F.lit(1)).alias("n"), F.min("pos").alias("first_pos")))


def category_count(df: DataFrame, category: str = "category") -> DataFrame:
    """A9 core: rows per category."""
    return df.groupBy(category).agg(F.count(F.lit(1)).alias("count"))
