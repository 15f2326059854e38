"""Line dedup by site-relative frequency (DataFrame functions only).

Pages are grouped by host; for each line the pages of the host containing it
are divided by the host's pages; lines above ``max_ratio`` on at least
``min_pages`` pages are boilerplate and are dropped from every page of that host.

A line counts once per page (``array_distinct`` inside the row), so the only
shuffle carries one partial count per (host, 64-bit line hash) and map task:
a host or a line with a third of all rows is pre-aggregated.  The dropped
lines of a host are at most ``average lines per page / max_ratio``; they are
written as one small row per host and joined back (Spark broadcasts that
table when its written size is within ``autoBroadcastJoinThreshold``, else
it splits skewed hosts in a sort-merge join).

Edge cases: null or empty text has no lines and stays as it is; blank lines
are never dropped; a null host is a host of its own; repeated rows are pages of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomlog.llm.common import written

MAX_RATIO = 0.1
MIN_PAGES = 4
PASSAGE_WORDS = 50                   # a line of more words is a passage


def _key(line: Column) -> Column:
    return F.xxhash64(F.trim(line))


def boilerplate(pages: DataFrame, host: Column, text: Column, max_ratio: float = MAX_RATIO,
                min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, pages, lines): page count and boilerplate line hashes of every host."""
    totals = written(pages.select(host.alias("host")).groupBy("host").agg(F.count(F.lit(1)).alias("pages")), "host-pages")
    lines = F.filter(F.split(text, "\n"), lambda x: F.trim(x) != "")
    counted = (pages.select(host.alias("h"), F.explode(F.array_distinct(F.transform(lines, _key))).alias("key"))
               .groupBy("h", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_pages))
    frequent = (counted.join(totals, F.col("h").eqNullSafe(F.col("host")))
                .where(F.col("n") > max_ratio * F.col("pages"))
                .groupBy("h").agg(F.collect_list("key").alias("lines")))   # at most lines per page / max_ratio
    found = totals.join(frequent, F.col("h").eqNullSafe(F.col("host")), "left")
    return written(found.select("host", "pages", F.coalesce("lines", F.array().cast("array<bigint>")).alias("lines")),
                   "boilerplate")


def drop_boilerplate(pages: DataFrame, host: Column, text: Column, max_ratio: float = MAX_RATIO,
                     min_pages: int = MIN_PAGES) -> DataFrame:
    """Every row of ``pages`` with __host, __pages (of its host), __lines and
    __kept: its lines before and after (null text: both null)."""
    table = boilerplate(pages, host, text, max_ratio, min_pages)
    table = table.select(F.col("host").alias("__h"), F.col("pages").alias("__pages"), F.col("lines").alias("__drop"))
    rows = pages.withColumns({"__host": host, "__lines": F.split(text, "\n")})
    joined = rows.join(table, F.col("__host").eqNullSafe(F.col("__h")), "left").drop("__h")
    kept = F.when(F.size("__drop") == 0, F.col("__lines")).otherwise(
        F.filter("__lines", lambda x: (F.trim(x) == "") | ~F.array_contains("__drop", _key(x))))
    return joined.withColumn("__kept", kept).drop("__drop")


def drop_passages(pages: DataFrame, page_id: str, text: str, min_words: int = PASSAGE_WORDS,
                  min_pages: int = MIN_PAGES) -> DataFrame:
    """``pages`` with repeated passages taken out of ``text``: the whole table is
    the site, and a line of more than ``min_words`` words on at least
    ``min_pages`` pages, whatever share of the table they are, stays on the page
    with the smallest id only (if no id is known, on all).  A page made of nothing
    but such lines stays as it is: it is a copy of a page, not a page with a passage."""
    lines = F.filter(F.split(text, "\n"), lambda x: F.size(F.split(F.trim(x), r"\s+")) > min_words)
    held = pages.select(F.col(page_id).alias("p"), F.xxhash64(text).alias("t"),
                        F.explode(F.array_distinct(F.transform(lines, _key))).alias("key"))
    held = written(held, "passage-lines")
    passages = held.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("p").alias("keeper")).where(F.col("n") >= min_pages)
    passages = written(passages.select("key", "keeper"), "passages")
    # per text of an id, at most its own lines
    drops = (held.join(passages, "key").where(~F.col("p").eqNullSafe(F.col("keeper")))
             .groupBy(F.col("p").alias("__p"), F.col("t").alias("__t")).agg(F.collect_set("key").alias("__drop")))
    drops = written(drops, "passage-drops")
    joined = pages.join(drops, F.col(page_id).eqNullSafe(F.col("__p")) & (F.xxhash64(text) == F.col("__t")), "left")
    kept = F.filter(F.split(text, "\n"), lambda x: (F.trim(x) == "") | ~F.array_contains("__drop", _key(x)))
    some = F.col("__drop").isNotNull() & F.exists(kept, lambda x: F.trim(x) != "")
    return joined.withColumn(text, F.when(some, F.array_join(kept, "\n")).otherwise(F.col(text))).select(*pages.columns)


def host_of(url: Column) -> Column:
    """Host and port of a URL, lower-cased; '' without one, null for null."""
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))


_BLOCKS = "p|div|br|li|ul|ol|nav|h[1-6]|article|section|header|footer|table|tr|td|title|head|body|html|main|aside|form"


def html_lines(html: Column) -> Column:
    """Text of a page: scripts, styles and comments go, block tags end a line,
    other tags go."""
    t = F.regexp_replace(html, r"(?is)<script.*?</script>|<style.*?</style>|<!--.*?-->", "")
    t = F.regexp_replace(t, rf"(?i)</?({_BLOCKS})(?:\s[^>]*)?/?>", "\n")
    t = F.regexp_replace(t, r"<[^>]*>", "")
    return F.regexp_replace(t, r"[ \t]*\n\s*", "\n")


def site_lines(pages: DataFrame, url: str = "url", html: str = "html", page_id: str = "page_id",
               max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """page_id, host, host_pages, n_lines, n_dropped, text of every page."""
    rows = written(pages.select(F.col(page_id).alias("page_id"), host_of(F.col(url)).alias("host"),
                                html_lines(F.col(html)).alias("text")), "page-lines")
    out = drop_boilerplate(rows, F.col("host"), F.col("text"), max_ratio, min_pages)
    n = F.coalesce(F.size(F.filter("__lines", lambda x: F.trim(x) != "")), F.lit(0))
    m = F.coalesce(F.size(F.filter("__kept", lambda x: F.trim(x) != "")), F.lit(0))
    return out.select("page_id", "host", F.col("__pages").alias("host_pages"), n.cast("long").alias("n_lines"),
                      (n - m).cast("long").alias("n_dropped"), F.array_join("__kept", "\n").alias("text"))
