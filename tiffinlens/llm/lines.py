"""Line dedup by site-relative frequency, in DataFrame functions only.

Lines are counted per host after a map-side combine, so a host with a third of
all pages is no single task. What remains per host is short: if its pages have L
different lines on average, at most L / ratio lines can stand on more than
``ratio`` of them. Texts are not shuffled for the counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .staging import staged

# A line on more than this share of a host's pages is boilerplate ...
MAX_RATIO = 0.1
# ... if it is on this many pages at least: on a host of few pages a share says little.
MIN_PAGES = 5


def line_of(line: Column) -> Column:
    """A line without blanks, tabs and carriage returns at its ends."""
    return F.btrim(line, F.lit(" \t\r"))


def key_of(line: Column) -> Column:
    """128 bits that stand for a trimmed line."""
    return F.struct(F.xxhash64(line).alias("a"), F.xxhash64(F.lit("line"), line).alias("b"))


def text_lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def host_lines(documents: DataFrame, host: str = "source", text: str = "text") -> DataFrame:
    """host, key, pages: on how many of the host's pages each line stands."""
    once = F.array_distinct(
        F.filter(F.transform(text_lines(F.col(text)), line_of), lambda line: line != "")
    )
    return (
        documents.where(F.col(host).isNotNull())
        .select(F.col(host).alias("host"), F.explode(once).alias("line"))
        .select("host", key_of(F.col("line")).alias("key"))
        .select("host", "key.a", "key.b")
        .groupBy("host", "a", "b")
        .agg(F.count("*").alias("pages"))
    )


def boilerplate(
    documents: DataFrame,
    host: str = "source",
    text: str = "text",
    max_ratio: float = MAX_RATIO,
    min_pages: int = MIN_PAGES,
) -> DataFrame:
    """host, lines: the keys of each host's boilerplate lines; hosts without any are absent."""
    totals = (
        documents.where(F.col(host).isNotNull()).groupBy(F.col(host).alias("host")).agg(F.count("*").alias("total"))
    )
    return (
        host_lines(documents, host, text)
        .where(F.col("pages") >= min_pages)
        .join(totals, "host")
        .where(F.col("pages") > max_ratio * F.col("total"))
        .groupBy("host")
        .agg(F.sort_array(F.collect_list(F.struct("a", "b"))).alias("lines"))
    )


def drop_boilerplate(
    documents: DataFrame,
    host: str = "source",
    text: str = "text",
    max_ratio: float = MAX_RATIO,
    min_pages: int = MIN_PAGES,
    counts: bool = False,
) -> DataFrame:
    """Every row, its text without the lines on more than ``max_ratio`` of its host's pages.

    Lines compare without blanks at their ends; blank lines neither count nor go.
    A line counts once per page however often it stands there; repeated rows are
    pages of their own. A NULL text stays NULL; a NULL host is no site, and
    nothing goes. With ``counts``, n_lines (lines that are not blank) and
    n_dropped are added. Other columns pass through, whatever their names.
    """
    bad = staged(boilerplate(documents, host, text, max_ratio, min_pages), "boilerplate").select(
        F.col("host").alias("__host"), F.col("lines").alias("__lines")
    )
    joined = documents.join(bad, documents[host] == bad["__host"], "left")
    kept = F.filter(
        text_lines(F.col(text)),
        lambda line: ~F.array_contains(F.col("__lines"), key_of(line_of(line))) | (line_of(line) == ""),
    )
    result = joined.withColumn("__kept", F.when(F.col("__lines").isNotNull(), F.array_join(kept, "\n")).otherwise(F.col(text)))
    columns = [F.col("__kept").alias(text) if c == text else F.col(c) for c in documents.columns]
    if not counts:
        return result.select(*columns)
    lines = F.coalesce(n_lines(F.col(text)), F.lit(0)).cast("long")
    left = F.coalesce(n_lines(F.col("__kept")), F.lit(0)).cast("long")
    return result.select(*columns, lines.alias("n_lines"), (lines - left).alias("n_dropped"))


def n_lines(text: Column) -> Column:
    return F.size(F.filter(text_lines(text), lambda line: line_of(line) != ""))
