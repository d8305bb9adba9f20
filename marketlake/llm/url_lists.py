"""Temporal URL filters: captures joined as of their fetch time to dated list entries.

List entries are dated events: on a day, a list adds or removes a host, a
domain (with all hosts below it) or a URL prefix. Per list and key, the events
become validity intervals [from, to): each 'add' holds until the next event of
that key. A capture is looked up under every key that could cover it (its host,
each parent domain, each directory of its path), by an equi-join on key and
month, and an interval matches when it holds at the fetch time.

Intervals are cut at month borders, so a capture meets only the entries of its
month: a key with a long history costs no more than one with a short one. The
events of a key are ordered month by month and the months are chained through
their first and last events, so a key that holds a third of all events isn't
one task. Hot keys on the captures' side are split by adaptive execution. In
one month a key has at most a few dozen days with events.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_FAR = "9999-12-31"


def host_of(url: Column) -> Column:
    """Lower-cased host without user, port and trailing dot; null if there is none."""
    h = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    h = F.regexp_replace(h, r"\.$", "")
    return F.when(h != "", h)


def path_of(url: Column) -> Column:
    """Path without query and fragment; '/' if empty."""
    p = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)", 1)
    return F.when(p == "", "/").otherwise(p)


def keys_of(url: Column) -> Column:
    """Every key that could cover a URL: 'host:h', 'domain:d' of h and its parents, 'prefix:h/dir/'."""
    labels = F.split(host_of(url), "\\.")
    domains = F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(labels) - 1, F.lit(1))),
        lambda i: F.concat(F.lit("domain:"), F.array_join(F.slice(labels, i, F.size(labels)), ".")))
    steps = F.split(path_of(url), "/")
    prefixes = F.transform(
        F.sequence(F.lit(1), F.size(steps) - 1),
        lambda i: F.concat(F.lit("prefix:"), host_of(url), F.array_join(F.slice(steps, 1, i), "/"), F.lit("/")))
    return F.when(host_of(url).isNotNull(), F.array_distinct(
        F.concat(F.array(F.concat(F.lit("host:"), host_of(url))), domains, prefixes)))


def intervals(entries: DataFrame) -> DataFrame:
    """Validity intervals (list, key, valid_from, valid_to) of events (list, key, day, added).

    Of several events of a list and key on one day an 'add' wins. Events with a
    null list, key, day or action are ignored; repeated ones count once; a
    removal without an entry and an 'add' of a held key change nothing. The
    last interval of a held key has no end (9999-12-31).
    """
    days = (entries.where(F.col("list").isNotNull() & F.col("key").isNotNull() & F.col("day").isNotNull()
                          & F.col("added").isNotNull())
            .groupBy("list", "key", "day").agg(F.max(F.col("added").cast("int")).alias("held"))
            .withColumn("month", F.trunc("day", "month")))
    # the first event of each month gives the end of the month before it that has events
    heads = days.groupBy("list", "key", "month").agg(F.min("day").alias("head"))
    by_key = Window.partitionBy("list", "key").orderBy("month")
    heads = heads.select("list", "key", "month", F.lead("head").over(by_key).alias("following"))
    by_month = Window.partitionBy("list", "key", "month").orderBy("day")
    ends = days.withColumn("next_day", F.lead("day").over(by_month))
    return (ends.join(heads, ["list", "key", "month"]).where("held = 1")
            .select("list", "key", F.col("day").alias("valid_from"),
                    F.coalesce("next_day", "following", F.lit(_FAR).cast("date")).alias("valid_to")))


def matches(captures: DataFrame, entries: DataFrame, *, id_col: str = "page_id", url_col: str = "url",
            time_col: str = "fetched") -> DataFrame:
    """(id, list, key, valid_from): each list entry that holds for a capture at its fetch time.

    Captures with a null URL or time, or without a host, match nothing.
    """
    held = intervals(entries)
    known = captures.select(F.col(id_col).alias("id"), F.col(time_col).cast("date").alias("at"),
                            F.explode(keys_of(F.col(url_col))).alias("key")).where(F.col("at").isNotNull())
    known = known.withColumn("month", F.trunc("at", "month"))
    # no month outside the captures' is needed
    day = F.col(time_col).cast("date")
    low, high = captures.agg(F.min(day), F.max(day)).first()
    low, high = F.lit(low).cast("date"), F.lit(high).cast("date")
    cut = (held.where((F.col("valid_from") <= high) & (F.col("valid_to") > low))
           .withColumn("month", F.explode(F.sequence(
               F.trunc(F.greatest("valid_from", low), "month"),
               F.trunc(F.least(F.date_sub("valid_to", 1), high), "month"), F.expr("interval 1 month")))))
    return (known.join(cut, ["key", "month"])
            .where((F.col("valid_from") <= F.col("at")) & (F.col("at") < F.col("valid_to")))
            .select("id", "list", "key", "valid_from"))


def filter_urls(captures: DataFrame, entries: DataFrame, *, allow: str = "allow", id_col: str = "page_id",
                url_col: str = "url", time_col: str = "fetched") -> DataFrame:
    """Every capture with what the lists said when it was fetched.

    Columns: ``id_col``, host, n_entries (held entries of all lists but
    ``allow``), lists (their names in order, comma-joined, '' if none), allowed
    (the allow list covers it) and blocked (n_entries > 0 and not allowed).
    Captures that share an id are judged together; a null id gets one row.
    """
    found = matches(captures, entries, id_col=id_col, url_col=url_col, time_col=time_col)
    found = found.groupBy("id").agg(
        F.sum(F.when(F.col("list") != allow, 1).otherwise(0)).alias("n_entries"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("list") != allow, F.col("list")))), ",").alias("lists"),
        F.max(F.col("list") == allow).alias("allowed"))
    base = captures.groupBy(F.col(id_col).alias("capture")).agg(F.min(host_of(F.col(url_col))).alias("host"))
    n = F.coalesce(F.col("n_entries"), F.lit(0)).cast("bigint")
    allowed = F.coalesce(F.col("allowed"), F.lit(False))
    return (base.join(found, F.col("capture").eqNullSafe(F.col("id")), "left")
            .select(F.col("capture").alias(id_col), "host", n.alias("n_entries"),
                    F.coalesce("lists", F.lit("")).alias("lists"), allowed.alias("allowed"),
                    ((n > 0) & ~allowed).alias("blocked")))
