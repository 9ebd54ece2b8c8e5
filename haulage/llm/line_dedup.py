"""Line dedup by frequency relative to a site.

Pages are grouped by host. A line is boilerplate on a host if it stands on more than `ratio` of the host's pages, and on
`min_pages` of them (two: the ratio decides, but a host's only page keeps its text). Boilerplate lines are dropped from the host's pages; all other text stays as it is.

Lines are cut at \\n and compared after trimming spaces and tabs; lines without other characters are never counted or
dropped. A line counts once per page. Counting groups by (host, 128-bit hash of the line) with map-side combine, so a
line found on a third of all pages meets as one row per task. A host has at most (mean lines per page) / ratio
boilerplate lines (with few pages: as many as their pages have), so their hashes fit one array per host; pages meet that array in a join by host, which Spark
broadcasts if it is small and splits at run time if a host is skewed.

Null texts stay null and count as pages without lines. A null host is a host of its own. Repeated rows are pages of
their own. An empty table gives an empty table. Columns beyond the named ones pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulage.llm import staging

BLANKS = " \t\r"
#: Share of a host's pages above which a line is boilerplate. One page alone has no lines of others to compare with.
RATIO, MIN_PAGES = 0.1, 2
#: Tags that end a line of a page's text; what scripts, styles and comments hold is no text.
LINE_TAGS = r"(?i)<(?:/?(?:p|div|li|ul|ol|h[1-6]|tr|table|article|section|nav|header|footer|title|head|body|html)|br)\b[^>]*>"
HIDDEN = r"(?is)<!--.*?-->|<script\b.*?</script>|<style\b.*?</style>"


def line_key(line: Column) -> Column:
    return F.unhex(F.md5(F.trim(line, F.lit(BLANKS))))


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def html_text(html: Column) -> Column:
    """A page's text: a line per block of text."""
    shown = F.regexp_replace(html, HIDDEN, "\n")
    text = F.regexp_replace(F.regexp_replace(shown, LINE_TAGS, "\n"), r"<[^>]*>", "")
    return F.btrim(F.regexp_replace(text, r"\n{2,}", "\n"), F.lit("\n"))


def host_of(url: Column) -> Column:
    """Lower-case host of a URL without port and user, empty if there is none."""
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def boilerplate(rows: DataFrame, ratio: float, min_pages: int) -> DataFrame:
    """rows: host, whole (text). Gives b_host, b_keys: the hashes of each host's boilerplate lines."""
    lines = F.filter(lines_of(F.col("whole")), lambda line: F.trim(line, F.lit(BLANKS)) != "")
    keys = F.array_distinct(F.transform(lines, line_key))
    narrow = rows.select(F.col("host").alias("h"), keys.alias("keys"))
    totals = narrow.groupBy("h").agg(F.count(F.lit(1)).alias("n_pages"))
    counts = narrow.select("h", F.explode("keys").alias("k")).groupBy("h", "k").agg(F.count(F.lit(1)).alias("n"))
    frequent = counts.filter(F.col("n") >= min_pages)
    over = frequent.join(totals.withColumnRenamed("h", "t"), F.expr("h <=> t")).filter(
        F.col("n") > F.lit(ratio) * F.col("n_pages")
    )
    return over.groupBy(F.col("h").alias("b_host")).agg(F.sort_array(F.collect_list("k")).alias("b_keys"))


def drop_boilerplate(
    pages: DataFrame, text: Column, host: Column, ratio: float = RATIO, min_pages: int = MIN_PAGES
) -> DataFrame:
    """row (all columns of a page), host, n_lines, n_dropped, text (without boilerplate).

    The page's own columns travel inside a struct, so whatever names they have cannot clash.
    """
    rows = pages.select(F.struct(*pages.columns).alias("row"), text.alias("whole"), host.alias("host"))
    known = staging.staged(boilerplate(rows, ratio, min_pages), "line-dedup")
    joined = rows.join(known, F.expr("host <=> b_host"), "left")
    keeps = lambda line: ~F.array_contains(F.col("b_keys"), line_key(line))
    has_any = F.col("b_keys").isNotNull() & F.col("whole").isNotNull()
    counted = joined.withColumn("kept", F.when(has_any, F.filter(lines_of(F.col("whole")), keeps))).withColumn(
        "n_lines", F.coalesce(F.size(lines_of(F.col("whole"))), F.lit(0)).cast("long")
    )
    n_dropped = F.when(has_any, F.col("n_lines") - F.size("kept")).otherwise(F.lit(0)).cast("long")
    cleaned = F.when(F.col("n_dropped") > 0, F.array_join("kept", "\n")).otherwise(F.col("whole"))
    return counted.withColumn("n_dropped", n_dropped).select(
        "row", "host", "n_lines", "n_dropped", cleaned.alias("text")
    )


def clean_pages(pages: DataFrame, ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """page_id, host, n_lines, n_dropped, text of web pages (page_id, url, html)."""
    texts = pages.select("page_id", html_text(F.col("html")).alias("text"), host_of(F.col("url")).alias("host"))
    texts = staging.staged(texts, "line-dedup-pages")  # tags are taken off once
    done = drop_boilerplate(texts, F.col("text"), F.col("host"), ratio, min_pages)
    return done.selectExpr("row.page_id", "host", "n_lines", "n_dropped", "text")


def clean_documents(docs: DataFrame, ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """Documents with their sources as sites and the columns of docs; n_chars follows the text."""
    done = drop_boilerplate(docs, F.col("text"), F.col("source"), ratio, min_pages)
    new = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.col("n_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("row.n_chars"))
    return done.select(*[new.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])
