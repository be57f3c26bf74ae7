"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetpulse.sinks.tables import materialize


def components(links: DataFrame) -> DataFrame:
    """Links ``u, v`` to ``node, comp``, where comp is the smallest node that links reach.

    Alternates large-star and small-star steps: every node points to the
    smallest neighbour it knows until nothing changes. Minima are summed before
    the shuffle and written, so that a node with many links meets its minimum in
    a join whose sides are plain exchanges, which adaptive execution can split.
    """
    edges = materialize(_distinct(links.filter("u <> v")), "links")
    before = None
    while (state := _state(edges)) != before:
        before = state
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = materialize(_hooked(both, both.filter("v > u")), "large-star")
        edges = materialize(_hooked(large, large, keep_hub=True), "small-star")
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("comp"))
    return stars.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct())


def near_components(links: DataFrame) -> DataFrame:
    """As ``components``, with half the writes, for links of which each node has few to smaller nodes.

    Only the minimum that a hub of many larger nodes meets is written; the step
    towards smaller nodes stays in the plan.
    """
    edges = materialize(_distinct(links.filter("u <> v")), "links")
    before = None
    while (state := _state(edges)) != before:
        before = state
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _hooked(both, both.filter("v > u"))
        least = large.groupBy("u").agg(F.min("v").alias("m"), F.collect_list("v").alias("met"))
        ends = F.explode(F.concat(F.array("u"), "met")).alias("end")
        edges = materialize(_distinct(least.select("m", ends).filter("end <> m").select(F.col("end").alias("u"), F.col("m").alias("v"))), "stars")
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("comp"))
    return stars.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct())


def _distinct(edges: DataFrame) -> DataFrame:
    """Each link once, its larger node first."""
    return edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _state(edges: DataFrame) -> tuple:
    """Count and checksum of a link table: one row."""
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def _hooked(neighbours: DataFrame, moved: DataFrame, keep_hub: bool = False) -> DataFrame:
    """The far ends of ``moved`` linked to the smallest of their hub and the hub's neighbours (and the hub too)."""
    least = neighbours.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = moved.join(materialize(least, "least"), "u")
    pairs = F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")))
    if keep_hub:
        pairs = F.concat(pairs, F.array(F.struct(F.col("u"), F.col("m").alias("v"))))
    return _distinct(joined.select(F.explode(pairs).alias("e")).select("e.*").filter("u <> v"))
