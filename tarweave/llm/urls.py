"""URL filters with dated lists.

An entry says that from some time on a list has a pattern (a domain, or a host and
the start of a path) or no longer has it. Entries become intervals in which a
pattern is listed. Each capture of a URL is joined with the intervals of all
patterns it falls under that hold when it was fetched: an as-of join, on the
pattern and on periods of time into which captures and intervals are cut.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarweave.llm.common import stage

#: Seconds of one period. An interval has one row for each period it touches.
PERIOD = 30 * 86400


def host_of(url: Column) -> Column:
    """The host of ``url`` in lower case, without user and port; null for what is no URL."""
    host = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.when(host != "", F.rtrim(host, F.lit(".")))


def patterns_of(url: Column) -> Column:
    """All patterns that ``url`` falls under: its host, the domains above it, and the host with each start of its path."""
    labels = F.split(host_of(url), r"\.")
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    parts = F.filter(F.split(path, "/"), lambda p: p != "")
    starts = F.when(
        F.size(parts) > 0,
        F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.concat(host_of(url), F.lit("/"), F.array_join(F.slice(parts, F.lit(1), i), "/"))),
    ).otherwise(F.array().cast("array<string>"))
    return F.when(host_of(url).isNull(), F.array().cast("array<string>")).otherwise(F.array_distinct(F.concat(domains, starts)))


def listed_intervals(entries: DataFrame) -> DataFrame:
    """``pattern, category, since, until``: when a pattern is listed; ``until`` is null as long as it stays listed.

    ``entries`` are ``pattern, category, at long, listed boolean``. An entry holds
    until the next of its pattern and category; of entries of one time, one that
    lists counts. Entries with a null in them are ignored.
    """
    turn = Window.partitionBy("pattern", "category").orderBy("at")
    return (
        entries.select(F.lower("pattern").alias("pattern"), "category", "at", "listed").dropna()
        .groupBy("pattern", "category", "at").agg(F.max("listed").alias("listed"))
        .withColumn("until", F.lead("at").over(turn))
        .where("listed")
        .select("pattern", "category", F.col("at").alias("since"), "until")
    )


def judge(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """``captures`` (``id, url, fetched_at long``) with ``categories`` and ``kept``.

    ``categories`` are those, sorted and comma-joined, that list the URL when it was
    fetched; ``kept`` is whether there are none. A null URL or time falls under
    nothing and is kept. Rows may repeat an id: each is judged by its own URL and
    time. Other columns of ``captures`` are not returned.
    """
    captures = captures.select("id", "url", "fetched_at")
    spans = listed_intervals(entries)
    (last,) = captures.agg(F.max("fetched_at")).first()
    periods = stage(
        spans.withColumn("end", F.least("until", F.lit((last or 0) + 1)))
        .where("since < end")
        .withColumn("period", F.explode(F.expr(f"sequence(floor(since / {PERIOD}), floor((end - 1) / {PERIOD}))")))
        .select("pattern", "period", "category", "since", "until"),
        "periods",
    )
    keys = (
        captures.where("fetched_at IS NOT NULL")
        .select("id", "url", "fetched_at", F.floor(F.col("fetched_at") / PERIOD).alias("period"), F.explode(patterns_of(F.col("url"))).alias("pattern"))
    )
    hits = (
        keys.join(periods, ["pattern", "period"])
        .where("since <= fetched_at AND (until IS NULL OR fetched_at < until)")
        .groupBy("id", "url", "fetched_at").agg(F.array_join(F.array_sort(F.collect_set("category")), ",").alias("categories"))
    )
    hits = hits.withColumnsRenamed({"id": "_id", "url": "_url", "fetched_at": "_at"})
    same = F.col("id").eqNullSafe(F.col("_id")) & (F.col("url") == F.col("_url")) & (F.col("fetched_at") == F.col("_at"))
    return captures.join(hits, same, "left").select(
        "id", "url", "fetched_at", F.coalesce("categories", F.lit("")).alias("categories"), F.col("categories").isNull().alias("kept")
    )
