"""Line dedup by site-relative frequency."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.llm.base import SPACE_CHARS, stage

#: A line on more than this share of its site's pages is boilerplate ...
RATIO = 0.02
#: ... if it is on this many of them at least; sites of a few pages say nothing.
LEAST_PAGES = 3


def _line_key(line: Column) -> Column:
    return F.xxhash64(F.btrim(line, F.lit(SPACE_CHARS)))


def _has_word(line: Column) -> Column:
    return F.btrim(line, F.lit(SPACE_CHARS)) != ""


def boilerplate(docs: DataFrame, site: str = "source", ratio: float = RATIO, least_pages: int = LEAST_PAGES, by_text: bool = False) -> DataFrame:
    """(site, lines): for each site the keys of its boilerplate lines.

    With ``by_text`` pages of the same text count as one, in a line's pages and in its site's.

    A site's list is bounded by (mean distinct lines a page) / ratio, however many pages it has. Counts are combined in each
    task before they are shuffled, so a site with a third of all pages is no hot group.
    """
    pages = docs.select(F.col(site).alias("site"), F.array_distinct(F.transform(F.filter(F.split(F.coalesce("text", F.lit("")), "\n"), _has_word), _line_key)).alias("keys"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("page"))
    if by_text:
        pages = pages.dropDuplicates(["site", "page"])
    totals = pages.groupBy("site").agg(F.count(F.lit(1)).alias("pages"))
    counts = pages.select("site", F.explode("keys").alias("key")).groupBy("site", "key").agg(F.count(F.lit(1)).alias("on")).filter(F.col("on") >= least_pages)
    common = counts.join(totals.select(F.col("site").alias("of"), "pages"), F.col("site").eqNullSafe(F.col("of"))).filter(F.col("on") > ratio * F.col("pages"))
    return common.groupBy("site").agg(F.collect_set("key").alias("lines"))


def drop_boilerplate(docs: DataFrame, site: str = "source", ratio: float = RATIO, least_pages: int = LEAST_PAGES, by_text: bool = False) -> DataFrame:
    """``docs`` without the lines that are on more than ``ratio`` of their site's pages; ``n_chars`` follows if it is there.

    Lines are compared without the white space around them, by a 64-bit hash within their site. Lines without a word stay.
    A null text stays null; a null site is a site. A document all of whose lines go keeps its row, with an empty text.
    With ``by_text`` copies of a page are one page, so that they don't make its lines boilerplate.
    """
    # Written first, so that its size decides the join: a few sites' lists need no shuffle of the texts.
    listed = stage(boilerplate(docs, site, ratio, least_pages, by_text).select(F.col("site").alias("__of"), F.col("lines").alias("__lines")), "boilerplate")
    joined = docs.join(listed, F.col(site).eqNullSafe(F.col("__of")), "left")
    kept = F.filter(F.split(F.col("text"), "\n"), lambda x: ~(_has_word(x) & F.array_contains("__lines", _line_key(x))))
    text = F.when(F.col("__lines").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    out = joined.withColumn("text", text)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)
