"""URL filter by a temporal list join.

A list is a log of dated entries, each adding a pattern to a list or removing
it. The log becomes validity intervals, and an as-of join evaluates each
capture against the entries that were active on the day it was fetched.

A pattern is a domain (itself and what is below it) or a host with the first
segment of its paths. What a capture is compared with depends on its host, that
segment and the day alone, so these are made distinct first: a host that a third
of all captures share comes to a row per segment and day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import ascii_lower, quoted, without

HOST = "^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"
SECTION = "^[a-z][a-z0-9+.-]*://[^/?#]*/([^/?#]+)"
RESULTS = ["host", "blocked", "decided_by", "listed_on", "n_active"]


def url_host(url: Column) -> Column:
    return F.regexp_extract(ascii_lower(url), HOST, 1)


def url_section(url: Column) -> Column:
    """``host/first segment``, empty without a path."""
    segment = F.regexp_extract(ascii_lower(url), SECTION, 1)
    return F.when(segment == "", F.lit("")).otherwise(F.concat(url_host(url), F.lit("/"), segment))


def validity(entries: DataFrame) -> DataFrame:
    """``entries`` (list, pattern, action, op, day) as intervals: an ``add`` holds from
    its day until the pattern's next entry in the list, or without end. Of one
    day's entries, a ``remove`` goes before an ``add``, and ``block`` before ``allow``, as
    the day's last word."""
    dated = entries.where("list IS NOT NULL AND pattern IS NOT NULL AND day IS NOT NULL AND op IN ('add', 'remove')")
    rank = F.when(F.col("op") == "remove", 2).when(F.col("action") == "block", 1).otherwise(0)
    # one row a day: what one pattern can hold is bounded by the calendar
    daily = (dated.groupBy("list", "pattern", "day").agg(F.max_by(F.struct("op", "action"), rank).alias("last"))
             .select("list", "pattern", "day", "last.op", "last.action"))
    until = F.lead("day").over(Window.partitionBy("list", "pattern").orderBy("day"))
    return (daily.withColumn("until", until).where("op = 'add'")
            .select("list", "pattern", "action", F.col("day").alias("from"), "until"))


def evaluate_captures(captures: DataFrame, entries: DataFrame, url: str = "url", day: str = "day") -> DataFrame:
    """Every row of ``captures`` with ``host``, ``blocked``, ``decided_by`` (the pattern), ``listed_on``
    and ``n_active`` (how many active entries match).

    The most specific active entry decides: a host with a segment before domains,
    longer domains before shorter ones; among equals ``block``, then the newest. A
    capture that none matches is not blocked, nor is one without a url, host or
    day. Repeated captures and entries change nothing. Input columns named like a
    result column are replaced."""
    keep = without(captures, [*RESULTS, "__host", "__section", "__day"])
    link = F.col(quoted(url)).cast("string")
    rows = captures.select(*[F.col(quoted(c)) for c in keep], url_host(link).alias("__host"), url_section(link).alias("__section"),
                           F.col(quoted(day)).cast("date").alias("__day"))
    asked = rows.select("__host", "__section", "__day").where("__host <> '' AND __day IS NOT NULL").distinct()
    labels = F.split("__host", "\\.")
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    keys = F.filter(F.array_append(domains, F.col("__section")), lambda k: k != "")
    candidates = asked.select("*", F.explode(F.array_distinct(keys)).alias("pattern"), F.year("__day").alias("year"))
    last = F.coalesce(F.date_sub("until", 1), F.make_date(F.greatest(F.year("from"), F.lit(captures_horizon(asked))), F.lit(12), F.lit(31)))
    # year by year, so that a pattern with a long history meets only what was fetched then
    held = validity(entries).select("*", F.explode(F.sequence(F.year("from"), F.greatest(F.year("from"), F.year(last)))).alias("year"))
    matched = candidates.join(held, ["pattern", "year"]).where((F.col("from") <= F.col("__day")) & (F.col("until").isNull() | (F.col("__day") < F.col("until"))))
    weight = F.struct(F.col("pattern").contains("/").alias("section"), F.length("pattern").alias("length"), (F.col("action") == "block").alias("block"),
                      F.col("from"), F.col("pattern"))
    verdicts = matched.groupBy("__host", "__section", "__day").agg(F.max(weight).alias("best"), F.count(F.lit(1)).alias("n_active"))
    return rows.join(verdicts, ["__host", "__section", "__day"], "left").select(
        *[F.col(quoted(c)) for c in keep], F.col("__host").alias("host"), F.coalesce("best.block", F.lit(False)).alias("blocked"),
        F.col("best.pattern").alias("decided_by"), F.col("best.from").alias("listed_on"), F.coalesce("n_active", F.lit(0)).cast("long").alias("n_active"))


def captures_horizon(asked: DataFrame) -> int:
    """The last year in which anything was fetched."""
    return asked.agg(F.coalesce(F.max(F.year("__day")), F.lit(1))).first()[0]


def derived_log(pages: DataFrame) -> DataFrame:
    """A dated list log over the hosts and sections of ``pages``: there is no such
    table, so each host and section gets entries by digits of its MD5."""

    def digits(col: Column, at: int) -> Column:
        return F.conv(F.substring(F.md5(col.cast("binary")), at, 4), 16, 10).cast("int")

    link = F.col("url").cast("string")
    names = (pages.select(F.explode(F.array(url_host(link), url_section(link), F.regexp_extract(url_host(link), "([^.]+\\.[^.]+)$", 1))).alias("pattern"))
             .where("pattern <> ''").distinct())
    start = F.date_add(F.lit("2024-01-01").cast("date"), digits(F.col("pattern"), 1) % 250)
    step = digits(F.col("pattern"), 5) % 60 + 1
    kind = digits(F.col("pattern"), 9) % 4
    action = F.when(digits(F.col("pattern"), 13) % 3 == 0, "allow").otherwise("block")
    events = F.array(*[F.struct(F.lit(op).alias("op"), F.date_add(start, step * k).alias("day"), F.lit(k).alias("number"))
                       for k, op in enumerate(("add", "remove", "add", "add"))])
    return (names.select("pattern", action.alias("action"), kind.alias("kind"), F.explode(events).alias("event"))
            .where("event.number <= kind").select(F.lit("derived").alias("list"), "pattern", "action", "event.op", "event.day"))
