"""Dated URL lists held against captures as of their fetch time.

Every (list, pattern) is a history of additions and removals. ``intervals``
turns it into the times when the pattern is active; ``judge`` joins every
capture with what was active when it was fetched. A pattern is a host (which
covers its subdomains) or a host with a path (which covers what lies below).
The longest active pattern decides, and of equally long ones a block.

Captures of one host can be a third of all rows: captures are salted and the
intervals repeated for each salt, so the join deals a host out to many tasks.

Defined results: additions win over removals of the same moment; entries
without list, pattern or time have no effect; an unknown action removes; a null or unreadable url, or a
null time, matches nothing and is allowed; an address of any length is cut into all its patterns;
repeated captures are judged each;
other columns are ignored; an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chorale.llm.common import let

# Parts that one host's captures are dealt into.
SALTS = 16


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.\-]*://[^/?#]*([^?#]*)", 1)


def patterns_of(url: Column) -> Column:
    """All patterns that cover ``url``: its host, the domains above, its path and the paths above."""

    def tails(labels: Column) -> Column:
        n = F.size(labels)
        return F.transform(F.sequence(F.lit(1), n), lambda i: F.array_join(F.slice(labels, i, n), "."))

    def heads(parts: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(1), F.size(parts)),
            lambda i: F.concat(host_of(url), F.lit("/"), F.array_join(F.slice(parts, 1, i), "/")),
        )

    labels = F.split(host_of(url), r"\.")
    parts = F.filter(F.split(path_of(url), "/"), lambda x: x != "")
    below = let(parts, lambda p: F.when(F.size(p) > 0, heads(p)).otherwise(F.array().cast("array<string>")))
    return F.when(host_of(url) != "", F.concat(let(labels, tails), below))


def intervals(entries: DataFrame) -> DataFrame:
    """(list, pattern, since, until): when each pattern was active; ``until`` null if it still is."""
    known = entries.filter("list IS NOT NULL AND pattern IS NOT NULL AND at IS NOT NULL")
    moments = known.groupBy("list", "pattern", "at").agg(F.max(F.coalesce(F.col("action") == "add", F.lit(False))).alias("on"))
    history = Window.partitionBy("list", "pattern").orderBy("at")
    spans = moments.select("list", "pattern", F.col("at").alias("since"), F.lead("at").over(history).alias("until"), "on")
    return spans.filter("on").drop("on")


def judge(captures: DataFrame, entries: DataFrame, salts: int = SALTS) -> DataFrame:
    """Each capture with n_active (patterns in force), pattern, list, since and ``blocked``.

    ``captures`` has page_id, url and at; ``entries`` list ('block' or 'allow'), pattern, at and action.
    """
    rows = captures.select("page_id", "url", "at").withColumn("row", F.monotonically_increasing_id())
    salt = F.pmod(F.xxhash64("row"), F.lit(salts))
    keyed = rows.filter("at IS NOT NULL").select("row", "at", salt.alias("salt"), F.explode(patterns_of(F.col("url"))).alias("pattern"))
    spans = intervals(entries).withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    active = keyed.join(spans.hint("merge"), ["pattern", "salt"]).filter("since <= at AND (until IS NULL OR at < until)")
    best = F.max(F.struct(F.length("pattern").alias("size"), (F.col("list") == "block").alias("block"), "pattern", "list", "since"))
    # Captures come along in the grouping, so that none is lost and nothing is joined back.
    both = rows.select("row", "page_id", "url", "at", F.lit(None).cast(active.select(best).dtypes[0][1]).alias("hit"), F.lit(0).alias("n"))
    hits = active.select(
        "row", F.lit(None).cast(rows.schema["page_id"].dataType).alias("page_id"), F.lit(None).cast("string").alias("url"),
        F.lit(None).cast(rows.schema["at"].dataType).alias("at"),
        F.struct(F.length("pattern").alias("size"), (F.col("list") == "block").alias("block"), "pattern", "list", "since").alias("hit"),
        F.lit(1).alias("n"),
    )
    grouped = both.unionByName(hits).groupBy("row").agg(
        F.max("page_id").alias("page_id"), F.max("url").alias("url"), F.max("at").alias("at"),
        F.max("hit").alias("hit"), F.sum("n").alias("n_active"),
    )
    return grouped.select(
        "page_id", "url", "at", "n_active", "hit.pattern", "hit.list", "hit.since",
        F.coalesce(F.col("hit.block"), F.lit(False)).alias("blocked"),
    )
