"""URL filters by a temporal list join.

List entries are dated: each adds a pattern to a list or removes it, from the start of a day. They
become validity intervals, and every capture is judged by the entries active on the day it was
fetched. Patterns are a host, a domain (with all hosts below it) or a host and leading path.

The as-of join works on days: captures are reduced to distinct (pattern, day) first, of listed
patterns only, so a host with a third of all captures is a few hundred rows in the join. Built-in
expressions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

_PARTS = r"^(?:[A-Za-z][A-Za-z0-9+.-]*+:)?//(?:[^/?#@]*+@)?([^/?#:]*+)(?::[0-9]*+)?(/[^?#]*+)?"


def host_of(url: Column) -> Column:
    """Lower-case host without a closing dot; empty if there is none."""
    return F.lower(F.regexp_replace(F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 1), r"\.$", ""))


def patterns_of(url: Column, labels: Column | None = None, steps: Column | None = None) -> Column:
    """Array of (kind, pattern) that a list may hold for this URL.

    `labels` and `steps`: the most that a listed domain or leading path has; longer ones are not
    made, so that a very long URL costs its length and not the square of it.
    """
    host = host_of(url)
    parts = F.split(host, r"\.")
    n = F.size(parts)
    first = F.lit(1) if labels is None else F.greatest(F.lit(1), n - labels + 1)
    domains = F.transform(
        F.sequence(first, n),
        lambda i: F.struct(F.lit("domain").alias("kind"), F.array_join(F.slice(parts, i, n), ".").alias("pattern")),
    )
    path = F.filter(F.split(F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 2), "/"), lambda s: s != "")
    last = F.size(path) if steps is None else F.least(F.size(path), steps)
    prefixes = F.transform(
        F.sequence(F.lit(1), last),
        lambda i: F.struct(
            F.lit("prefix").alias("kind"),
            F.concat(host, F.lit("/"), F.array_join(F.slice(path, F.lit(1), i), "/")).alias("pattern"),
        ),
    )
    none = F.expr("cast(array() as array<struct<kind:string,pattern:string>>)")
    own = F.array(F.struct(F.lit("host").alias("kind"), host.alias("pattern")))
    some = F.concat(own, F.when(first <= n, domains).otherwise(none), F.when(last > 0, prefixes).otherwise(none))
    return F.when(host == "", none).otherwise(some)


def _most(entries: DataFrame, kind: str, sign: str) -> Column:
    """One more than the most times that `sign` is in a listed pattern of this kind; 0 without any."""
    of = F.when(F.col("kind") == kind, F.regexp_count("pattern", F.lit(sign)) + 1)
    return F.coalesce(entries.agg(F.coalesce(F.max(of), F.lit(0)).alias("most")).scalar(), F.lit(0))


def states(entries: DataFrame) -> DataFrame:
    """Per (list, kind, pattern, day) whether the pattern is on the list from that day on.

    Of several entries on one day the last by `seq` holds, of equal ones a removal. Entries
    with a null in any key, and unknown actions, say nothing.
    """
    known = entries.where("list IS NOT NULL AND kind IS NOT NULL AND pattern IS NOT NULL AND day IS NOT NULL")
    last = F.max(F.struct(F.coalesce("seq", F.lit(-1)).alias("seq"), (F.col("action") == "remove").alias("off")))
    return (
        known.where("action IN ('add', 'remove')")
        .groupBy("list", "kind", "pattern", "day")
        .agg(last.alias("last"))
        .select("list", "kind", "pattern", "day", (~F.col("last.off")).alias("listed"))
    )


def intervals(entries: DataFrame) -> DataFrame:
    """(list, kind, pattern, valid_from, valid_to) as whole days, end exclusive, null if open.

    Additions of what is listed, and removals of what is not, change nothing; they join no
    intervals and cut none.
    """
    order = W.partitionBy("list", "kind", "pattern").orderBy("day")
    turns = states(entries).withColumn("before", F.lag("listed", 1, False).over(order)).where("listed <> before")
    spans = turns.withColumn("valid_to", F.lead("day").over(order)).where("listed")
    return spans.select("list", "kind", "pattern", F.col("day").alias("valid_from"), "valid_to")


def judged(
    captures: DataFrame,
    entries: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    fetched_col: str = "fetched",
    allow: tuple[str, ...] = ("trusted",),
) -> DataFrame:
    """One row per capture: page_id, host, fetch_day, matched (sorted `list:kind:pattern`), blocked.

    blocked: on a list on the fetch day, and on none of the `allow` lists. A null URL, one
    without a host, or a null fetch time matches nothing. Repeated rows stay repeated. Other
    columns are ignored; empty captures give no rows, empty entries block nothing. A URL may be
    of any length and depth. Lists are dated by days: an entry counts for the whole of its day,
    so fetch times count as days too.
    """
    rows = captures.select(
        F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.to_date(fetched_col).alias("fetch_day")
    )
    # What is judged is a URL on a day; copies of both are judged once.
    seen = rows.where("url IS NOT NULL AND fetch_day IS NOT NULL").select("url", "fetch_day").distinct()
    seen = seen.withColumn("labels", _most(entries, "domain", "[.]")).withColumn("steps", _most(entries, "prefix", "/") - 1)
    made = patterns_of(F.col("url"), F.col("labels"), F.col("steps"))
    asked = seen.select("url", F.col("fetch_day").alias("day"), F.explode(made).alias("p"))
    asked = asked.select("url", "day", "p.kind", "p.pattern")
    spans = intervals(entries)
    days = asked.select("kind", "pattern", "day").distinct()
    listed = spans.select("list", "kind", "pattern").distinct()
    # As-of join: interval starts and asked days in one order; the last start before a day tells.
    starts = spans.select("list", "kind", "pattern", F.col("valid_from").alias("day"), "valid_to", F.lit(0).alias("asks"))
    marks = days.join(listed, ["kind", "pattern"]).select(
        "list", "kind", "pattern", "day", F.lit(None).cast("date").alias("valid_to"), F.lit(1).alias("asks")
    )
    order = W.partitionBy("list", "kind", "pattern").orderBy("day", "asks")
    start = F.when(F.col("asks") == 0, F.struct(F.coalesce("valid_to", F.lit("9999-12-31").cast("date")).alias("end")))
    active = (
        starts.unionByName(marks)
        .withColumn("open", F.last(start, True).over(order))
        .where("asks = 1 AND open.end > day")
        .groupBy("kind", "pattern", "day")
        .agg(F.collect_set("list").alias("lists"))
    )
    hits = asked.join(active, ["kind", "pattern", "day"]).select(
        "url", F.col("day").alias("fetch_day"), "kind", "pattern", F.explode("lists").alias("list")
    )
    found = hits.groupBy("url", "fetch_day").agg(
        F.sort_array(F.collect_set(F.concat_ws(":", "list", "kind", "pattern"))).alias("matched"),
        F.bool_or(F.col("list").isin(*allow)).alias("allowed"),
    )
    return rows.join(found, ["url", "fetch_day"], "left").select(
        "page_id",
        host_of(F.col("url")).alias("host"),
        "fetch_day",
        F.concat_ws(" ", "matched").alias("matched"),
        (F.col("matched").isNotNull() & ~F.coalesce("allowed", F.lit(False))).alias("blocked"),
    )
