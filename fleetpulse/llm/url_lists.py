"""URL filtering by dated block lists: an as-of join of captures and list entries.

Changes of a list (an entry is added or removed at some time) become validity
intervals of its entries. A capture is compared with the entries for its host,
the host's parent domains and its path's prefixes that were active when it was
fetched. Everything is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetpulse.sinks.tables import materialize

OPEN_END = 253_402_300_799  # 9999-12-31T23:59:59Z in epoch seconds
SLICE_SECONDS = 30 * 86_400


def host_of(url: Column) -> Column:
    """Lower-case host without port and user; null where there is none."""
    return _host(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))


def _host(authority: Column) -> Column:
    host = F.regexp_replace(F.regexp_replace(F.lower(authority), "^.*@", ""), r":[0-9]*$", "")
    trimmed = F.rtrim(host, F.lit("."))
    return F.when(trimmed != "", trimmed)


def _steps(path: Column) -> Column:
    return F.filter(F.split(path, "/"), lambda s: s != "")


def normal_entry(entry: Column) -> Column:
    """A list entry in the form of ``entry_keys``; null without a host.

    That is the host in lower case without user, port and closing dots, then
    the path's steps with their case. A scheme, a query, a fragment and empty
    steps, closing slashes among them, say nothing.
    """
    plain = F.regexp_replace(F.regexp_replace(F.trim(entry), r"^[A-Za-z][A-Za-z0-9+.-]*://", ""), r"(?s)[?#].*$", "")
    authority = F.substring_index(plain, "/", 1)
    steps = _steps(F.substr(plain, F.char_length(authority) + 1))
    host = _host(authority)
    return F.when(host.isNotNull(), F.array_join(F.concat(F.array(host), steps), "/"))


def path_depth(entry: Column) -> Column:
    """Path steps of a list entry; 0 for a host or domain."""
    return F.size(F.split(entry, "/")) - 1


def entry_keys(url: Column, depths: list[int]) -> Column:
    """The entries that can match a URL: every domain of its host, then its path prefixes of the given depths, as distinct texts."""
    host = host_of(url)
    labels = F.split(host, r"\.")
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)", 1)
    steps = _steps(path)
    prefixes = F.filter(F.array(*map(F.lit, depths)).cast("array<int>"), lambda n: n <= F.size(steps))
    paths = F.transform(prefixes, lambda n: F.concat(host, F.lit("/"), F.array_join(F.slice(steps, 1, n), "/")))
    return F.when(host.isNull(), F.array().cast("array<string>")).otherwise(F.array_distinct(F.concat(domains, paths)))


def validity(changes: DataFrame) -> DataFrame:
    """``list_name, entry, changed_at, action`` to intervals: list_name, entry, valid_from, valid_to (exclusive).

    The action ``add`` opens an interval and ``remove`` closes it; a repeated
    action changes nothing. Of changes of one entry in the same second the
    removal counts. Rows with a null, another action or an entry without host
    are left out. Entries are told apart by their normal form.
    """
    known = changes.select("list_name", normal_entry(F.col("entry")).alias("entry"), F.col("changed_at").cast("bigint").alias("at"), "action")
    known = known.dropna().filter(F.col("action").isin("add", "remove"))
    states = known.groupBy("list_name", "entry", "at").agg(F.min((F.col("action") == "add").cast("int")).alias("active"))
    history = Window.partitionBy("list_name", "entry").orderBy("at")
    turns = states.withColumn("before", F.lag("active", 1, 0).over(history)).filter(F.col("active") != F.col("before"))
    ends = turns.withColumn("valid_to", F.lead("at", 1, OPEN_END).over(history))
    return ends.filter("active = 1").select("list_name", "entry", F.col("at").alias("valid_from"), "valid_to")


def matches(captures: DataFrame, intervals: DataFrame, slice_seconds: int = SLICE_SECONDS) -> DataFrame:
    """Distinct url and fetched_at with the list entry that applied: the longest, then the first by list name.

    Entries are cut where time slices of the captures' span meet, so a capture
    meets the intervals of its own slice only, however long an entry's history.
    Paths are cut at the depths that entries have, which one aggregate tells.
    An entry with many captures is split by adaptive execution, as both sides of
    the join are plain exchanges.
    """
    asked = materialize(
        captures.select("url", F.col("fetched_at").cast("bigint").alias("fetched_at")).dropna().distinct(), "captures"
    )
    span = asked.agg(F.min("fetched_at").alias("first"), F.max("fetched_at").alias("last")).first()
    first, last = (span["first"], span["last"]) if span["first"] is not None else (0, -1)

    def slice_of(time: Column) -> Column:
        return F.floor(time / F.lit(slice_seconds)).cast("bigint")

    inside = intervals.filter((F.col("valid_from") <= last) & (F.col("valid_to") > first))
    low, high = F.greatest("valid_from", F.lit(first)), F.least(F.col("valid_to") - 1, F.lit(last))
    sliced = materialize(inside.withColumn("slice", F.explode(F.sequence(slice_of(low), slice_of(high)))), "intervals")
    depths = sorted(d for d in sliced.agg(F.collect_set(path_depth(F.col("entry")))).first()[0] if d > 0)
    keyed = asked.withColumn("entry", F.explode(entry_keys(F.col("url"), depths))).withColumn("slice", slice_of(F.col("fetched_at")))
    hit = keyed.join(sliced, ["entry", "slice"]).filter(
        (F.col("valid_from") <= F.col("fetched_at")) & (F.col("fetched_at") < F.col("valid_to"))
    )
    best = F.struct((-F.char_length("entry")).alias("size"), "entry", "list_name", "valid_from", "valid_to")
    chosen = hit.groupBy("url", "fetched_at").agg(F.min(best).alias("hit"), F.count(F.lit(1)).alias("n_matches"))
    return chosen.select("url", "fetched_at", "hit.entry", "hit.list_name", "hit.valid_from", "hit.valid_to", "n_matches")


def judge(captures: DataFrame, intervals: DataFrame, key: str = "page_id", slice_seconds: int = SLICE_SECONDS) -> DataFrame:
    """One row per capture: the key, url, fetched_at, blocked, and the entry that blocks it.

    A capture without URL, host or time is not blocked. Repeated rows stay.
    Other columns are not read, so their names cannot clash.
    """
    rows = captures.select(F.col(key), "url", F.col("fetched_at").cast("bigint").alias("fetched_at"))
    found = materialize(matches(rows, intervals, slice_seconds), "matches")
    joined = rows.join(found, ["url", "fetched_at"], "left")
    blocked = F.col("entry").isNotNull().alias("blocked")
    return joined.select(
        key, "url", "fetched_at", blocked, "list_name", "entry", "valid_from", "valid_to", F.coalesce("n_matches", F.lit(0)).alias("n_matches")
    )


def allowed(captures: DataFrame, intervals: DataFrame, slice_seconds: int = SLICE_SECONDS) -> DataFrame:
    """The captures that no entry blocked when they were fetched, with their own columns."""
    found = materialize(matches(captures, intervals, slice_seconds), "matches").select(
        F.col("url").alias("_hit_url"), F.col("fetched_at").alias("_hit_at")
    )
    same = (F.col("url") == F.col("_hit_url")) & (F.col("fetched_at").cast("bigint") == F.col("_hit_at"))
    return captures.join(found, same, "left_anti")
