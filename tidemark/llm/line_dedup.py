"""Site-relative line frequency: lines on too large a share of a host's pages are boilerplate and go."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.sources.store import settle

# Applied in this order to the raw page; each is (pattern, replacement), in syntax common to Java and RE2.
TO_LINES = (
    (r"(?is)<!--.*?-->", ""),
    (r"(?is)<(script|style|noscript)\b.*?</(script|style|noscript)\s*>", ""),
    (r"(?i)</?(html|head|body|title|nav|ul|ol|li|div|p|br|hr|h[1-6]|article|section|header|footer|aside|main|form"
     r"|table|tr|td|th|pre|blockquote)\b[^>]*>", "\n"),
    (r"<[^>]*>", ""),
    (r"&nbsp;", " "), (r"&lt;", "<"), (r"&gt;", ">"), (r"&quot;", '"'), (r"&#39;", "'"), (r"&amp;", "&"),
    (r"[ \t\r\f\x0b]+", " "),
    (r" ?\n[ \n]*", "\n"),
    (r"^[ \n]+|[ \n]+$", ""),
)
HOST = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)"


def page_lines(html: Column) -> Column:
    """The page's text as one line per block element, without empty lines; null stays null."""
    for pattern, replacement in TO_LINES:
        html = F.regexp_replace(html, pattern, replacement)
    return html


def host_of(url: Column) -> Column:
    """Lower-case host of a URL; empty if there is none or the URL is null."""
    return F.lower(F.coalesce(F.regexp_extract(url, HOST, 1), F.lit("")))


def drop_boilerplate(pages: DataFrame, max_ratio: float = 0.1, min_pages: int = 3, id_col: str = "page_id",
                     url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, host, host_pages, n_lines, n_dropped, text): pages without lines found on too many of the host's.

    A line is dropped from all pages of a host when the number of the host's pages that contain it, divided by the
    number of the host's pages, is above ``max_ratio`` and that number is at least ``min_pages`` (a line of one page
    is not boilerplate of a small site). A page counts once however often it repeats a line.

    Only hashes of lines are shuffled: the lines of a page are made distinct before they are counted, counts combine
    before the shuffle, and a page carries its text once, to meet the short array of its dropped lines. Null URLs
    and URLs without host form the host ''; null pages have no lines and an empty text; repeated ids are kept as the
    rows they are (rows of one id share what is dropped); an empty table gives no rows; other columns are not read.
    """
    lines = F.filter(F.split(page_lines(F.col(html_col)), "\n"), lambda x: x != "")
    hashes = F.transform("lines", lambda x: F.xxhash64(F.col("host"), x))
    cut = settle(pages.select(F.col(id_col).alias("page_id"), host_of(F.col(url_col)).alias("host"),
                              F.coalesce(lines, F.array().cast("array<string>")).alias("lines")), "page-lines")
    keyed = cut.select("page_id", "host", F.array_distinct(hashes).alias("keys"))
    totals = settle(keyed.groupBy("host").agg(F.count(F.lit(1)).alias("host_pages")), "page-hosts")
    counts = (keyed.select("host", F.explode("keys").alias("k")).groupBy("host", "k")
              .agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_pages))
    over = counts.join(totals, "host").where(F.col("n") / F.col("host_pages") > max_ratio).select("k")
    over = settle(over, "page-boilerplate")
    hit = (keyed.select("page_id", F.explode("keys").alias("k")).join(over, "k")
           .groupBy("page_id").agg(F.collect_set("k").alias("dropped")))
    joined = (cut.join(hit.withColumnRenamed("page_id", "hit_id"), F.col("page_id").eqNullSafe(F.col("hit_id")), "left")
              .join(totals, "host"))
    none = F.array().cast("array<bigint>")
    kept = F.filter("lines", lambda x: ~F.array_contains(F.coalesce("dropped", none), F.xxhash64(F.col("host"), x)))
    return (joined.withColumn("kept", kept).select(
        "page_id", "host", "host_pages", F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size("kept")).cast("long").alias("n_dropped"), F.array_join("kept", "\n").alias("text")))
