"""Loads that account for every row: accepted, or rejected with its reasons.

Nothing becomes NULL in silence.  Lines and JSON are read PERMISSIVE with the text of a
broken record kept; values that do not parse are named.  A load is :class:`Split`: the
judged rows are one frame, of which the two outputs are filters, so that rows in equal
accepted plus rejected by construction.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from newslake.functions.timeparse import ISO_T_SECONDS, ISO_Z_FRACTION, SPACE_SECONDS, api_time_parse
from newslake.sources import listings as ls

#: Column that keeps a broken record's text.
BAD = "_bad_record"


@dataclass(frozen=True)
class Split:
    """``judged`` has the load's columns, ``reasons`` (array; empty: accepted) and ``raw``
    columns from which a rejected row can be told."""

    judged: DataFrame
    raw: tuple[str, ...]

    def accepted(self) -> DataFrame:
        return self.judged.filter(F.size("reasons") == 0).drop("reasons", *[c for c in self.raw if c.startswith("_")])

    def rejected(self) -> DataFrame:
        """``reasons`` and ``raw``, the record as JSON."""
        return self.judged.filter(F.size("reasons") > 0).select("reasons", F.to_json(F.struct(*self.raw)).alias("raw"))

    def summary(self) -> DataFrame:
        """Rows by reason; accepted rows have the reason NULL.  A row with several reasons
        counts under each."""
        return self.judged.select(F.explode_outer("reasons").alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))

    def outcomes(self) -> DataFrame:
        """``reasons`` joined by ", " (accepted: "") and ``n``, the rows of :meth:`accepted` and
        :meth:`rejected` that have them, counted in one pass over the judged rows."""
        return self.judged.groupBy(F.array_join("reasons", ", ").alias("reasons")).agg(F.count(F.lit(1)).alias("n"))

    def save(self, accepted_path: str, rejects_path: str, mode: str = "append") -> None:
        self.accepted().write.mode(mode).parquet(accepted_path)
        self.rejected().write.mode(mode).parquet(rejects_path)


def reasons(*checks: tuple[str, Column]) -> Column:
    """Names of the checks that hold (a check that is NULL does not)."""
    return F.array_compact(F.array(*[F.when(hit, F.lit(name)) for name, hit in checks]))


def _text(c: Column) -> Column:
    """Trimmed text; the word 'None' (a NULL made text upstream) and blanks are NULL."""
    s = F.trim(c.cast("string"))
    return F.when((s != "None") & (s != ""), s)


def _has(c: str, df: DataFrame) -> Column:
    return _text(F.col(c)) if c in df.columns else F.lit(None).cast("string")


def load_records(records: DataFrame) -> Split:
    """S11 with rejects: records without an id, or whose date or publish time is given but
    cannot be read."""
    date, time, key = (_has(c, records) for c in ("date", "publish_time", "id"))
    held = records.withColumns({"_record": F.struct(*records.columns), "_reasons": reasons(
        ("id missing", key.isNull()), ("date unreadable", date.isNotNull() & date.try_cast("timestamp_ntz").isNull()),
        ("publish_time unreadable", time.isNotNull() & time.try_cast("timestamp_ntz").isNull()))})
    loaded = ls.load_normalise(held, extra=["_record", "_reasons"])
    return Split(loaded.withColumnRenamed("_reasons", "reasons"), ("_record",))


def read_csv(spark: SparkSession, path: str, schema: StructType | str, header: bool = True, **options) -> Split:
    """S5 with rejects: lines with a wrong number of fields or a value of another type than
    ``schema`` declares.  Every column is parsed whatever is selected later, so what counts
    as broken does not depend on the query."""
    declared = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    full = StructType([*declared.fields, StructField(BAD, StringType())])
    lines = (spark.read.schema(full).options(header=header, mode="PERMISSIVE", columnNameOfCorruptRecord=BAD, **options).csv(path))
    # The reader parses (and so judges) only the columns a query asks for: ask for all, by
    # adding no characters of each to the broken text.
    nothing = [F.substring(F.col(f"`{c}`").cast("string"), 1, 0) for c in declared.names]
    broken = F.length(F.concat_ws("", F.col(BAD), *nothing)) > 0
    return Split(lines.withColumn("reasons", reasons(("malformed line", broken))), (BAD,))


def parsed_json(value: Column, schema: str) -> tuple[Column, Column]:
    """``value`` as ``schema`` (DDL), and whether it is broken: absent, not JSON, or with a
    value of another type."""
    if not schema.startswith("struct<"):
        whole = F.from_json(value, schema)
        return whole, value.isNull() | whole.isNull()
    whole = F.from_json(value, f"struct<{BAD}: string, {schema[len('struct<'):]}", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD})
    return whole, value.isNull() | whole.isNull() | whole[BAD].isNotNull()


def _rows(pages: DataFrame, schema: str, items, value_col: str) -> DataFrame:
    """One row per listing item, and one for every broken page (``_page_bad``, item NULL)."""
    whole, bad = parsed_json(F.col(value_col), schema)
    read = pages.select(F.col(value_col).alias("_value"), whole.alias("_whole"), F.coalesce(bad, F.lit(True)).alias("_page_bad"))
    # A readable page without items has no row; a broken one has one, without an item.
    listed = F.when(F.col("_page_bad"), F.array(F.lit(None))).otherwise(items(F.col("_whole")))
    return read.select("_page_bad", F.when(F.col("_page_bad"), F.col("_value")).alias("_page"), F.explode(listed).alias("_item"))


def _unreadable(text: Column, fmt: str) -> Column:
    return (F.coalesce(text, F.lit("")) == "") | api_time_parse(text, fmt)["publish_time"].isNull()


def listing_items(pages: DataFrame, shape: str, value_col: str = "value") -> Split:
    """Items of landed listing pages of a shape ("detail" S7, "sectioned" S8, "posts" S9),
    judged before they are joined: broken pages, items without an id, without a link where
    the shape needs one, and with a time that is absent or unreadable."""
    if shape == "detail":
        rows = _rows(pages, ls.LISTING_A_PAGE, lambda w: w["listItem"], value_col)
        it = F.col("_item")
        checks = [("id missing", it["_id"].isNull()), ("slug missing", F.coalesce(it["slugline_url"], F.lit("")) == ""),
                  ("time unreadable", _unreadable(it["createdDateFull"], ISO_Z_FRACTION))]
    elif shape == "sectioned":
        rows = _rows(pages, ls.LISTING_B_PAGE, lambda w: F.when(w["response"] == "success", w["data"]), value_col)
        it = F.col("_item")
        checks = [("id missing", it["cms_article_id"].isNull()), ("time unreadable", _unreadable(it["publish_time"], SPACE_SECONDS))]
    elif shape == "posts":
        rows = _rows(pages, ls.LISTING_C_PAGE, lambda w: w, value_col)
        it = F.col("_item")
        checks = [("id missing", it["id"].isNull()), ("link missing", F.coalesce(it["link"], F.lit("")) == ""),
                  ("time unreadable", _unreadable(it["date"], ISO_T_SECONDS))]
    else:
        raise ValueError("shape must be detail, sectioned or posts")
    bad = F.col("_page_bad")
    judged = reasons(("malformed page", bad), *[(name, ~bad & hit) for name, hit in checks])
    return Split(rows.select("_item.*", "_item", "_page", judged.alias("reasons")), ("_item", "_page"))


def listing_details(details: DataFrame, shape: str, value_col: str = "value") -> Split:
    """Landed detail records of a shape ("detail" S7, "sectioned" S8): broken ones, failed
    responses, and those without an id."""
    if shape == "detail":
        whole, bad = parsed_json(F.col(value_col), ls.LISTING_A_DETAIL)
        rows = details.select(F.col(value_col).alias("_value"), whole.alias("_whole"), F.coalesce(bad, F.lit(True)).alias("_bad"))
        checks = [("id missing", F.col("_whole._id").isNull())]
    elif shape == "sectioned":
        whole, bad = parsed_json(F.col(value_col), ls.LISTING_B_DETAIL)
        rows = details.select(F.col(value_col).alias("_value"), whole.alias("_whole"), F.coalesce(bad, F.lit(True)).alias("_bad"))
        failed = F.coalesce(F.col("_whole.response") != "success", F.lit(True))
        checks = [("failed response", failed), ("id missing", ~failed & F.col("_whole.data.cms_article_id").isNull())]
    else:
        raise ValueError("shape must be detail or sectioned")
    judged = reasons(("malformed record", F.col("_bad")), *[(name, ~F.col("_bad") & hit) for name, hit in checks])
    return Split(rows.select("_whole.*", "_value", judged.alias("reasons")).drop(BAD), ("_value",))


__all__ = ["BAD", "Split", "listing_details", "listing_items", "load_records", "parsed_json", "read_csv", "reasons"]
