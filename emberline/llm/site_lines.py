"""Operator 7: line dedup by site-relative frequency.

Pages are grouped by host; a line that stands in more than a given share of its host's pages is boilerplate of that
site and is dropped from them.  Frequencies are counted with partial aggregates on (host, line digest).  A host has
at most (lines a page) / (share) such lines, so they are gathered in one small array a host; that array meets the
host's pages under a salt.  A host has a salt for each so many pages, so one with a third of all pages is dealt over as
many tasks as it needs, and a small one costs one row.  Pages are parsed once and their lines written.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import saved, table

#: Pages of a host that meet its array under one salt.
PAGES_A_SALT = 2048
_HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"
_UNSEEN = r"(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->"
_BLOCKS = r"(?i)</?(?:address|article|aside|blockquote|body|br|dd|div|dl|dt|fieldset|figcaption|figure|footer|form|h[1-6]|head|header|hr|html|li|main|nav|ol|option|p|pre|section|table|tbody|td|tfoot|th|thead|title|tr|ul)\b[^>]*>"
_EDGES = r"^[ \t-\r]+|[ \t-\r]+$"


def host_of(url: Column) -> Column:
    """Host of a URL in lower case; empty for a null URL or one without a host."""
    return F.coalesce(F.lower(F.regexp_extract(url, _HOST, 1)), F.lit(""))


def lines_of(html: Column) -> Column:
    """Visible lines of a page: block elements end lines, other markup goes, entities are read, empty lines go."""
    text = F.regexp_replace(F.regexp_replace(F.regexp_replace(html, _UNSEEN, ""), _BLOCKS, "\n"), r"<[^>]*>", "")
    for name, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        text = F.replace(text, F.lit(name), F.lit(char))
    return F.filter(F.transform(F.split(text, "\n"), lambda x: F.regexp_replace(x, _EDGES, "")), lambda x: x != "")


def drop_site_lines(pages: DataFrame, share: float = 0.3, least: int = 3) -> DataFrame:
    """page_id, host, n_lines, n_dropped, text (the lines left) for every row of ``pages``.

    A line is dropped if more than ``share`` of the host's pages hold it, and at least ``least`` of them.  Each row is
    a page, repeated rows too; a line counts once a page; pages without a host form a site of their own.  A null or
    empty html has no lines and an empty text, and counts as a page.  Other columns are not read; an empty table gives
    an empty result.
    """
    rows = saved(pages.select("page_id", host_of(F.col("url")).alias("host"), F.coalesce(lines_of(F.col("html")), F.array().cast("array<string>")).alias("lines")), "page-lines")
    digest = lambda x: F.md5(x.cast("binary"))
    totals = saved(rows.groupBy("host").agg(F.count("*").alias("pages")).withColumn("salts", F.ceil(F.col("pages") / PAGES_A_SALT).cast("int")), "host-pages")
    seen = rows.select("host", F.explode(F.transform(F.array_distinct("lines"), digest)).alias("line")).groupBy("host", "line").agg(F.count("*").alias("n")).filter(F.col("n") >= least)
    big = totals.filter("salts > 1").select("host", "salts")
    if big.count() <= 100_000:  # two numbers a host; beyond that the hosts are joined like any rows
        big = F.broadcast(big)

    def dealt(df: DataFrame, *by: str) -> DataFrame:
        """A host's rows over as many salts as its pages call for."""
        return df.join(big, "host", "left").withColumn("salt", F.pmod(F.xxhash64(*by), F.coalesce("salts", F.lit(1))).cast("int")).drop("salts")

    salts = F.explode(F.sequence(F.lit(0), F.col("salts") - 1))
    common = dealt(seen, "line").join(totals.select("host", "pages", "salts", salts.alias("salt")), ["host", "salt"]).filter(F.col("n") > F.lit(share) * F.col("pages"))
    site = common.groupBy("host", "salts").agg(F.collect_set("line").alias("common")).select("host", "common", salts.alias("salt"))
    joined = dealt(rows, "page_id", "lines").join(site, ["host", "salt"], "left")
    kept = F.when(F.col("common").isNull(), F.col("lines")).otherwise(F.filter("lines", lambda x: ~F.array_contains("common", digest(x))))
    out = joined.select("page_id", "host", F.size("lines").cast("long").alias("n_lines"), kept.alias("kept"))
    return out.select("page_id", "host", "n_lines", (F.col("n_lines") - F.size("kept")).alias("n_dropped"), F.array_join("kept", "\n").alias("text"))


def op7_site_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_site_lines(table(spark, sf_dir, "pages")).select("page_id", "host", "n_lines", "n_dropped", F.md5(F.col("text").cast("binary")).alias("text_md5"))


ORACLE = rf"""
with stripped as (
  select page_id, coalesce(lower(regexp_extract(url, '{_HOST}', 1)), '') as host,
    regexp_replace(regexp_replace(regexp_replace(html, '{_UNSEEN}', '', 'g'), '{_BLOCKS}', chr(10), 'g'), '<[^>]*>', '', 'g') as x from pages),
readable as (
  select page_id, host, replace(replace(replace(replace(replace(replace(x, '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&') as x from stripped),
lined as (
  select row_number() over () as r, page_id, host,
    coalesce(list_filter(list_transform(string_split(x, chr(10)), lambda l: regexp_replace(l, '^[ \t-\r]+|[ \t-\r]+$', '', 'g')), lambda l: l <> ''), []) as lines from readable),
seen as (select host, line, count(*) as n from (select host, unnest(list_distinct(lines)) as line from lined) group by all),
totals as (select host, count(*) as pages from lined group by host),
common as (select host, list(line) as common from seen join totals using (host) where n >= 3 and n > 0.3e0 * pages group by host),
cleaned as (
  select page_id, lined.host as host, len(lines) as n_lines,
    case when common is null then lines else list_filter(lines, lambda l: not list_contains(common, l)) end as kept from lined left join common using (host))
select page_id, host, n_lines, n_lines - len(kept) as n_dropped, md5(coalesce(array_to_string(kept, chr(10)), '')) as text_md5 from cleaned
"""
