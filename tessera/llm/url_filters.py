"""URL filters by a temporal list join, in DataFrame functions only.

List entries are dated: an entry puts a pattern (a domain, a host, or a host with its first path
segment) on the list with an action from its date on, until the next entry of the same pattern.
``validity`` turns entries into half-open intervals. ``judge`` is an as-of join: every capture is
met, by equality, with the intervals of its own patterns that were valid on the day it was fetched,
and the most specific active entry decides.

Intervals are cut at month borders and joined on (pattern, month), so a hot host's captures spread
over months, a capture meets only the entries of its month, and larger skew is left to Spark's
skew-join splitting. The list is broadcast by the planner only if its measured size allows it.

Defined cases: a null url, or one without a host, matches nothing and is allowed; so is a capture
with a null date. Of entries of one pattern and date the last by ``action`` then ``category``
counts. A ``remove`` entry ends the listing. Rows with a null pattern or date are no entries.
Captures that repeat are judged one by one. Extra columns of captures are carried through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tessera.llm.common import fresh, staged

_HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"
_SEGMENT = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+(/[^/?#]+)"


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, _HOST, 1))


def patterns(url: Column) -> Column:
    """The patterns that may list a url, as an array of (``rank``, ``pattern``); rank 3 is the most
    specific. Null without a host."""
    host = host_of(url)
    segment = F.regexp_extract(url, _SEGMENT, 1)
    domain = F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1)  # the last two labels, whatever registry they belong to
    def entry(rank: int, pattern: Column, given: Column) -> Column:  # noqa: E306
        return F.when(given, F.struct(F.lit(rank).alias("rank"), pattern.alias("pattern")))
    found = F.array(entry(1, F.concat(F.lit("domain:"), domain), domain != ""),
                    entry(2, F.concat(F.lit("host:"), host), host != ""),
                    entry(3, F.concat(F.lit("path:"), host, segment), segment != ""))
    return F.when(host != "", F.filter(found, lambda x: x.isNotNull()))


def validity(entries: DataFrame) -> DataFrame:
    """Intervals of the dated entries (``pattern``, ``listed_on``, ``action``, ``category``):
    ``pattern``, ``action``, ``category``, ``valid_from``, ``valid_to`` (null: still valid)."""
    one = entries.filter("pattern IS NOT NULL AND listed_on IS NOT NULL").groupBy("pattern", "listed_on").agg(
        F.max(F.struct("action", "category")).alias("e"))
    until = F.lead("listed_on").over(W.partitionBy("pattern").orderBy("listed_on"))
    return one.select("pattern", "e.action", "e.category", F.col("listed_on").alias("valid_from"), until.alias("valid_to")) \
        .filter("action IS NULL OR action <> 'remove'")


def judge(captures: DataFrame, intervals: DataFrame, url: str = "url", fetched_on: str = "fetched_on") -> DataFrame:
    """Adds ``verdict`` (``block`` or ``allow``), ``pattern``, ``category`` and ``valid_from`` of
    the deciding entry (null if none was active)."""
    row = fresh(captures, "row")
    # Numbered once and staged: the numbers are read twice, and a task that is run again must not give others.
    tagged = staged(captures.sparkSession, captures.withColumn(row, F.monotonically_increasing_id()), "captures")
    tries = tagged.select(row, F.col(fetched_on).alias("_day"), F.explode(patterns(F.col(url))).alias("_p")) \
        .select(row, "_day", "_p.rank", F.col("_p.pattern").alias("_pattern"), F.trunc("_day", "month").alias("_month"))
    last = captures.agg(F.max(fetched_on)).first()[0]  # open intervals need not reach beyond it
    months = F.sequence(F.trunc("valid_from", "month"),
                        F.greatest(F.trunc("valid_from", "month"), F.trunc(F.coalesce(F.date_sub("valid_to", 1), F.lit(last)), "month")),
                        F.expr("interval 1 month"))
    cut = intervals.filter(F.col("valid_from") <= F.lit(last)).select(
        F.col("pattern").alias("_listed"), "action", "category", "valid_from", "valid_to", F.explode(months).alias("_in"))
    active = tries.join(cut, (F.col("_pattern") == F.col("_listed")) & (F.col("_month") == F.col("_in"))
                        & (F.col("valid_from") <= F.col("_day")) & (F.col("valid_to").isNull() | (F.col("_day") < F.col("valid_to"))))
    best = active.groupBy(row).agg(F.max(F.struct("rank", "action", "category", "valid_from", F.col("_pattern").alias("pattern"))).alias("_best"))
    best = best.withColumnRenamed(row, "_of")
    out = tagged.join(best, tagged[row] == best["_of"], "left")
    return out.select(*[F.col(f"`{c}`") for c in captures.columns],
                      F.when(F.col("_best.action") == "block", "block").otherwise("allow").alias("verdict"),
                      F.col("_best.pattern").alias("pattern"), F.col("_best.category").alias("category"),
                      F.col("_best.valid_from").alias("valid_from"))


# --- the registered query's dated list, derived from the pages ----------------------------------

START = "2024-01-01"
CATEGORIES = ["adult", "malware", "spam", "ads"]


def _number(text: Column, first: int) -> Column:
    return F.conv(F.substring(F.md5(text), first, 6), 16, 10).cast("long")


def captures_of(pages: DataFrame) -> DataFrame:
    """Pages with the day of capture: a fixed function of the page number, over one year."""
    day = F.pmod(F.col("page_id") * 7919, F.lit(366)).cast("int")
    return pages.select("page_id", "url", F.date_add(F.lit(START).cast("date"), day).alias("fetched_on"))


def list_of(pages: DataFrame) -> DataFrame:
    """Three dated entries for each pattern that occurs in the pages; dates, actions and
    categories are fixed functions of the pattern."""
    known = pages.select(F.explode(patterns(F.col("url"))).alias("p")).select("p.pattern").distinct()
    rows = known.select("pattern", F.explode(F.array(*[F.lit(i) for i in range(3)])).alias("i"))
    key = F.concat(F.col("i").cast("string"), F.lit("/"), F.col("pattern"))
    return rows.select(
        "pattern", F.date_add(F.lit(START).cast("date"), (_number(key, 1) % 366).cast("int")).alias("listed_on"),
        F.element_at(F.array(*map(F.lit, ["allow", "block", "block", "remove"])), (_number(key, 7) % 4 + 1).cast("int")).alias("action"),
        F.element_at(F.array(*map(F.lit, CATEGORIES)), (_number(key, 13) % 4 + 1).cast("int")).alias("category"))


ORACLE = r"""
WITH page AS (
  SELECT row_number() OVER () AS r, page_id, url, DATE '2024-01-01' + ((page_id * 7919) % 366)::INT AS day,
         lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)) AS host,
         regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+(/[^/?#]+)', 1) AS seg
  FROM pages),
tries AS (
  SELECT r, day, 1 AS rank, 'domain:' || regexp_extract(host, '([^.]+\.[^.]+)$', 1) AS pattern FROM page
  WHERE regexp_extract(host, '([^.]+\.[^.]+)$', 1) <> ''
  UNION ALL SELECT r, day, 2, 'host:' || host FROM page WHERE host <> ''
  UNION ALL SELECT r, day, 3, 'path:' || host || seg FROM page WHERE host <> '' AND seg <> ''),
entry AS (
  SELECT pattern, md5(i || '/' || pattern) AS h
  FROM (SELECT DISTINCT pattern FROM tries) CROSS JOIN (SELECT unnest([0, 1, 2])::VARCHAR AS i)),
listed AS (
  SELECT pattern, DATE '2024-01-01' + (('0x' || substr(h, 1, 6))::BIGINT % 366)::INT AS listed_on,
         ['allow', 'block', 'block', 'remove'][('0x' || substr(h, 7, 6))::BIGINT % 4 + 1] AS action,
         ['adult', 'malware', 'spam', 'ads'][('0x' || substr(h, 13, 6))::BIGINT % 4 + 1] AS category
  FROM entry),
one AS (SELECT pattern, listed_on, max({'a': action, 'c': category}) AS e FROM listed GROUP BY 1, 2),
asof_ AS (
  SELECT t.r, t.rank, t.pattern, o.listed_on, o.e.a AS action, o.e.c AS category
  FROM tries t ASOF JOIN one o ON t.pattern = o.pattern AND t.day >= o.listed_on),
best AS (
  SELECT r, max({'rank': rank, 'action': action, 'category': category, 'd': listed_on, 'p': pattern}) AS b
  FROM asof_ WHERE action <> 'remove' GROUP BY r)
SELECT page_id, url, day::VARCHAR AS fetched_on, CASE WHEN b.action = 'block' THEN 'block' ELSE 'allow' END AS verdict,
       b.p AS pattern, b.category AS category, b.d::VARCHAR AS valid_from
FROM page LEFT JOIN best ON page.r = best.r"""
