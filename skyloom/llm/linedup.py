"""Lines that are boilerplate of their site, found by site-relative page frequency. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom.llm.common import cut, text_or_empty, unused


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def _named(line: Column) -> Column:
    """What stands for a line: its 64-bit hash and its length."""
    return F.struct(F.xxhash64(line).alias("h"), F.length(line).alias("n"))


def boilerplate(docs: DataFrame, text_col: str = "text", site_col: str = "source", percent: int = 5, min_pages: int = 2) -> DataFrame:
    """(site, dropped): of each site, the lines that stand on more than `percent` % of its pages and on `min_pages` at least; by default on two, since a line of one page is no repetition.

    Pages of a site with equal texts count once: a page that was crawled a thousand times isn't boilerplate. Blank
    lines never count. Null and empty sites are one site. An array holds at most (lines a page) * 100 / percent lines.
    """
    text = text_or_empty(text_col)
    page = docs.select(text_or_empty(site_col).alias("site"), F.xxhash64(text).alias("page"), F.length(text).alias("chars"), F.transform(F.filter(F.array_distinct(_lines(text)), lambda x: F.length(F.trim(x)) > 0), _named).alias("lines"))
    total = page.select("site", "page", "chars").distinct().groupBy("site").agg(F.count("*").alias("pages"))
    on = page.select("site", "page", "chars", F.explode("lines").alias("line")).select("site", "page", "chars", "line.h", "line.n").distinct()
    often = on.groupBy("site", "h", "n").agg(F.count("*").alias("seen")).where(F.col("seen") >= min_pages)
    bad = often.join(total, "site").where(F.col("seen") * 100 > F.col("pages") * percent)
    return bad.groupBy("site").agg(F.sort_array(F.collect_list(F.struct("h", "n"))).alias("dropped"))


def drop_boilerplate(docs: DataFrame, text_col: str = "text", site_col: str = "source", percent: int = 5, min_pages: int = 2, count_col: str | None = None) -> DataFrame:
    """docs without the boilerplate lines in text_col; count_col gets the number of lines dropped.

    Every row and every other column stays; a text of boilerplate alone becomes empty, a null text stays null.
    The table of dropped lines is written first, so that Spark sees its size: a small one is broadcast, a larger one
    is joined by shuffles, where adaptive execution splits a hot site.
    """
    site, dropped, name = unused(docs, "__site"), unused(docs, "__dropped"), count_col or unused(docs, "__count")
    bad = cut(boilerplate(docs, text_col, site_col, percent, min_pages), "boilerplate").select(F.col("site").alias(site), F.col("dropped").alias(dropped))
    rows = docs.withColumn(site, text_or_empty(site_col)).join(bad, site, "left")
    kept = F.filter(_lines(F.col(text_col)), lambda x: ~F.array_contains(F.col(dropped), _named(x)))
    hit = F.col(dropped).isNotNull() & F.col(text_col).isNotNull()
    lost = F.when(hit, F.size(_lines(F.col(text_col))) - F.size(kept)).otherwise(0)
    out = rows.withColumn(name, lost).withColumn(text_col, F.when(hit, F.array_join(kept, "\n")).otherwise(F.col(text_col)))
    return out.select(*docs.columns, *([count_col] if count_col else []))


ORACLE_SQL = """
WITH d AS (SELECT doc_id, coalesce(source, '') AS site, coalesce(text, '') AS body, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
total AS (SELECT site, count(DISTINCT body) AS pages FROM d GROUP BY site),
seen AS (SELECT site, line, count(DISTINCT body) AS seen FROM (SELECT site, body, unnest(list_distinct(ls)) AS line FROM d) WHERE length(trim(line)) > 0 GROUP BY site, line),
bad AS (SELECT seen.site, list(line) AS dropped FROM seen JOIN total ON seen.site = total.site WHERE seen >= 2 AND seen * 100 > pages * 5 GROUP BY seen.site),
k AS (SELECT doc_id, ls, list_filter(ls, lambda x: NOT list_contains(coalesce(dropped, []), x)) AS kept FROM d LEFT JOIN bad ON d.site = bad.site)
SELECT doc_id, len(ls) AS n_lines, len(ls) - len(kept) AS n_dropped, md5(array_to_string(kept, chr(10))) AS kept_md5 FROM k
"""
