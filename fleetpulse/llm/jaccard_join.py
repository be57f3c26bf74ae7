"""Exact near-duplicate classes by a Jaccard metric-space join.

The Jaccard distance of two word-shingle sets is a metric. Texts whose sets are
equal are one node. Two nodes within the radius share one of their rarest
shingles, so the nodes that hold a rare shingle form a region, and every link
lies inside some region. Each node first meets one pivot, that of its largest
region; nodes within the radius of a pivot are one class, and regions of one
class are done, which ends most large groups of copies. Regions that overlap
and fit into a task are joined there exactly. A larger one takes a pivot and
falls into an inner cell (within the radius: one class), a boundary (within
twice the radius) and an outer cell. By the triangle inequality no link joins
inner and outer cell, so the boundary is copied to both sides, inner with
boundary and boundary with outer, and these regions are joined the same way;
what is too large after some levels is joined block by block. Distances are
counted over whole sets.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetpulse.llm.common import STAGE_BYTES, Batches, Memo, bytes_of, map_batches, offsets, take_over
from fleetpulse.llm.graph import components
from fleetpulse.operators.lookup import lookup_join
from fleetpulse.sinks.tables import materialize

SHINGLE_WORDS = 5
SIMILAR = 80  # per cent
BUCKETS = 1 << 18
_BLOCK = 1 << 12
SMALL_REGION = 32
MOST_LEVELS = 4
TASK_ITEMS = 2_000_000  # shingles of a region that one task joins, 16 MB

# Unrelated odd multipliers, one for each place in a shingle, and those of a mixing step.
_PLACES = [xxhash.xxh3_64_intdigest(str(k)) | 1 for k in range(SHINGLE_WORDS)]
_MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


class WordHashes(Memo):
    def __missing__(self, word: bytes) -> int:
        value = self.recall(word)
        if value is not None:
            return value
        value = xxhash.xxh3_64_intdigest(word)
        self.trim()
        self.keep(word, value)
        return value


_WORDS = WordHashes(300_000)


def _start_task() -> None:
    take_over("word hashes", _WORDS.forget)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(_MIX[0])
    x = (x ^ (x >> np.uint64(27))) * np.uint64(_MIX[1])
    return x ^ (x >> np.uint64(31))


def shingles(text: bytes) -> np.ndarray:
    """64-bit hashes of a text's word shingles, in text order; a shorter text is one shingle."""
    words = text.lower().split()  # of bytes: A-Z only, and the six ASCII blanks
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))
    size = min(SHINGLE_WORDS, len(words))
    n = len(words) - size + 1
    total = np.full(n, size, np.uint64)
    for k in range(size):
        total += hashes[k : k + n] * np.uint64(_PLACES[k])
    return _mixed(total)


def shingle_set(text: bytes) -> np.ndarray:
    return np.unique(shingles(text))


def _bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes & np.uint64(BUCKETS - 1)).astype(np.int64)


def prefix_length(n: int, similar: int = SIMILAR) -> int:
    """Rarest shingles of which two similar sets must share one."""
    return n + (-similar * n // 100) + 1 if n else 0


def bucket_counts(documents: DataFrame) -> np.ndarray:
    """How often shingles fall into each of a fixed number of hash buckets, over all texts.

    The counts only order shingles from rare to common; any order gives the same
    classes. Tasks send blocks of counts that are summed in two steps.
    """
    schema = "block int, part int, counts binary"
    types = pa.schema([("block", pa.int32()), ("part", pa.int32()), ("counts", pa.binary())])

    def count(batches: Batches) -> Batches:
        _start_task()
        counts = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            hashes = np.concatenate([shingles(t) for t in bytes_of(batch)] or [np.zeros(0, np.uint64)])
            counts += np.bincount(_bucket(hashes), minlength=BUCKETS)
        part = TaskContext.get().partitionId() % 64
        for block in range(BUCKETS // _BLOCK):
            own = counts[block * _BLOCK : (block + 1) * _BLOCK]
            if own.any():
                row = {"block": [block], "part": [part], "counts": [own.astype("<i8").tobytes()]}
                yield pa.RecordBatch.from_pydict(row, schema=types)

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(c, "<i8") for c in table.column("counts").to_pylist())
        return pa.table({"block": table.column("block")[:1], "part": table.column("part")[:1], "counts": [total.tobytes()]}, schema=types)

    counted = map_batches(documents.select(F.col("text").cast("string").alias("text")), count, schema, STAGE_BYTES)
    merged = counted.groupBy("block", "part").applyInArrow(add, schema).groupBy("block").applyInArrow(add, schema)
    counts = np.zeros(BUCKETS, np.int64)
    for block, _, own in merged.collect():  # BUCKETS numbers at most
        counts[block * _BLOCK : (block + 1) * _BLOCK] = np.frombuffer(own, "<i8")
    return counts


def _node(hashes: np.ndarray) -> int:
    return int(np.frombuffer(xxhash.xxh3_64_digest(hashes.tobytes()), ">i8")[0])


def signatures(documents: DataFrame, counts: Broadcast, key: str = "doc_id") -> DataFrame:
    """doc_id, text_key (hash of the text), n (set size), node (hash of the set, null if empty), prefix (rarest shingles)."""
    schema = "doc_id bigint, text_key bigint, n bigint, node bigint, prefix array<bigint>"
    types = pa.schema([(c, pa.int64()) for c in ("doc_id", "text_key", "n", "node")] + [("prefix", pa.list_(pa.int64()))])

    def run(batches: Batches) -> Batches:
        _start_task()
        common = counts.value
        for batch in batches:
            sizes, nodes, prefixes = [], [], []
            for text in bytes_of(batch):
                own = shingle_set(text)
                order = np.lexsort((own, common[_bucket(own)]))
                sizes.append(len(own))
                nodes.append(_node(own) if len(own) else None)
                prefixes.append(own[order[: prefix_length(len(own))]].view(np.int64))
            arrays = [pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()), pa.array(prefixes, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_key"), *arrays], schema=types)

    return map_batches(_keyed(documents, key), run, schema, STAGE_BYTES)


def _keyed(documents: DataFrame, key: str) -> DataFrame:
    text = F.col("text").cast("string")
    return documents.select(F.col(key).cast("bigint").alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text"))


def _id_text(doc_id: Column, text_key: Column) -> Column:
    return F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("none")), text_key.cast("string"))


def node_sets(documents: DataFrame, members: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """``node, n, items`` (the sorted set as bytes) of the wanted nodes, from one document of each."""
    carriers = lookup_join(members.filter("node IS NOT NULL"), wanted, "node", "text_key", how="left_semi")
    carriers = carriers.groupBy("node").agg(F.min(_id_text(F.col("doc_id"), F.col("text_key"))).alias("carrier"))
    carriers = materialize(carriers.select("carrier").distinct(), "carriers")
    rows = _keyed(documents, key).withColumn("carrier", _id_text(F.col("doc_id"), F.col("text_key")))
    schema = "node bigint, n bigint, items binary"
    types = pa.schema([("node", pa.int64()), ("n", pa.int64()), ("items", pa.binary())])

    def run(batches: Batches) -> Batches:
        _start_task()
        for batch in batches:
            sets = [shingle_set(t) for t in bytes_of(batch)]
            columns = [pa.array([_node(s) for s in sets], pa.int64()), pa.array([len(s) for s in sets], pa.int64())]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([s.tobytes() for s in sets], pa.binary())], schema=types)

    chosen = lookup_join(rows, carriers, "carrier", "text_key", how="left_semi")
    sets = map_batches(chosen.select("text"), run, schema, STAGE_BYTES)
    again = members.groupBy("doc_id", "text_key").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")
    return materialize(sets if again.isEmpty() else sets.dropDuplicates(["node"]), "sets")


def overlaps(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``a, b`` with both set sizes and their common shingles; a popular b is split by adaptive execution.

    Only the sets that pairs name are moved.
    """
    left = sets.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("items").alias("items_a"))
    right = sets.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("items").alias("items_b"))
    pairs = materialize(pairs, "pairs")
    right = lookup_join(right, pairs.select("b").distinct(), "b", "b", how="left_semi")
    schema = "a bigint, b bigint, n_a bigint, n_b bigint, common bigint"
    types = pa.schema([(c, pa.int64()) for c in ("a", "b", "n_a", "n_b", "common")])

    def run(batches: Batches) -> Batches:
        for batch in batches:
            ours, theirs = (batch.column(c).to_pylist() for c in ("items_a", "items_b"))
            common = [
                np.intersect1d(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), assume_unique=True).size
                for x, y in zip(ours, theirs)
            ]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in types.names[:4]), pa.array(common, pa.int64())], schema=types)

    joined = lookup_join(left, pairs, "a", "a").join(right, "b")
    return map_batches(joined.select("a", "b", "n_a", "n_b", "items_a", "items_b"), run, schema, STAGE_BYTES)


def _sizes_allow(n_a: Column, n_b: Column, per_cent: int) -> Column:
    return 100 * F.least(n_a, n_b) >= per_cent * F.greatest(n_a, n_b)


class _Join:
    """State of one join: the sets, and the links found, kept as the classes that they make."""

    def __init__(self, similar: int):
        self.similar = similar
        self.boundary = max(0, 2 * similar - 100)  # similarity at twice the radius
        self.classes = None

    def measure(self, pairs: DataFrame, sets: DataFrame) -> DataFrame:
        """Measures pairs, takes the links among them and returns all, written."""
        found = materialize(overlaps(pairs, sets), "overlaps")
        self.link(found.filter(self.within(self.similar)).select("a", "b"))
        return found

    def link(self, links: DataFrame) -> None:
        links = links.toDF("u", "v")
        if self.classes is not None:
            links = links.unionByName(self.classes.select(F.col("node").alias("u"), F.col("comp").alias("v")))
        self.classes = materialize(components(links), "classes")

    @staticmethod
    def within(per_cent: int) -> Column:
        """Whether a measured pair's similarity is at least ``per_cent``, in whole numbers."""
        return 100 * F.col("common") >= per_cent * (F.col("n_a") + F.col("n_b") - F.col("common"))

    def classed(self, members: DataFrame) -> DataFrame:
        """Members with their class so far."""
        if self.classes is None:
            return members.withColumn("comp", F.col("node"))
        joined = members.join(self.classes, "node", "left")
        return joined.withColumn("comp", F.coalesce("comp", "node"))

    def open_regions(self, members: DataFrame) -> DataFrame:
        """Members (region, node, n) of the regions that hold more than one class, with items (shingles), size and pivot."""
        classed = self.classed(members)
        regions = classed.groupBy("region").agg(
            F.count(F.lit(1)).alias("size"), F.sum("n").alias("region_items"), F.min(F.struct("node", "n")).alias("pivot"),
            F.min("comp").alias("low"), F.max("comp").alias("high"),
            F.bit_xor(F.xxhash64("node")).alias("mark"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("mark2"),
        ).filter("size > 1 AND low < high")
        once = regions.groupBy("size", "region_items", "pivot", "mark", "mark2").agg(F.min("region").alias("region"))
        once = once.select("region", "size", "region_items", F.col("pivot.node").alias("pivot"), F.col("pivot.n").alias("n_pivot"))
        return materialize(lookup_join(members, materialize(once, "regions"), "region", "node"), "members")

    def local(self, members: DataFrame, sets: DataFrame) -> DataFrame:
        """Links ``u, v`` that join the classes inside each region (region, node) of bounded size; one task a region."""
        similar = self.similar
        types = pa.schema([("u", pa.int64()), ("v", pa.int64())])

        def join(rows: pa.Table) -> pa.Table:
            rows = rows.sort_by("node")
            nodes = rows.column("node").to_pylist()
            items = [np.frombuffer(i, np.uint64) for i in rows.column("items").to_pylist()]
            links = task_links(items, rows.column("comp").to_pylist(), similar)
            return pa.table({"u": [nodes[x] for x, _ in links], "v": [nodes[y] for _, y in links]}, schema=types)

        placed = materialize(self.classed(members.select("region", "node")), "placed")
        rows = lookup_join(sets.select("node", "items"), placed, "node", "node").select("region", "node", "comp", "items")
        return rows.groupBy("region").applyInArrow(join, "u bigint, v bigint")


def task_links(items: list[np.ndarray], classes: list[int], similar: int) -> list[tuple[int, int]]:
    """Similar pairs that join sets of different classes, as many as it takes to join them all.

    Sets are met by size; a set finds the earlier ones with which it shares one
    of its rarest shingles.
    """
    _, numbers = np.unique(np.concatenate(items), return_inverse=True)
    counts = np.bincount(numbers)
    rank = np.empty(len(counts), np.int64)
    rank[np.argsort(counts, kind="stable")] = np.arange(len(counts))
    ends = np.cumsum([len(i) for i in items])
    ranked = [np.sort(rank[numbers[e - len(i) : e]]) for i, e in zip(items, ends)]
    parent = list(range(len(items)))
    first: dict[int, int] = {}
    for x, own in enumerate(classes):
        parent[x] = first.setdefault(own, x)

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    postings: dict[int, list[int]] = {}
    marked = np.zeros(len(counts), bool)
    links = []
    for x in sorted(range(len(items)), key=lambda i: len(ranked[i])):
        own, n = ranked[x], len(ranked[x])
        met: set[int] = set()
        for r in own[: prefix_length(n, similar)].tolist():
            met.update(postings.get(r, ()))
        marked[own] = True
        for y in met:
            theirs = ranked[y]
            if 100 * len(theirs) < similar * n or root(x) == root(y):
                continue
            common = int(np.count_nonzero(marked[theirs]))
            if 100 * common >= similar * (n + len(theirs) - common):
                parent[root(y)] = root(x)
                links.append((x, y))
        marked[own] = False
        # Later sets are not smaller, so a similar one shares one of these.
        for r in own[: n + (-2 * similar * n // (100 + similar)) + 1].tolist():
            postings.setdefault(r, []).append(x)
    return links


def task_counts(items: list[np.ndarray], weights: np.ndarray, sides: np.ndarray, across: bool, similar: int) -> np.ndarray:
    """Summed weights of the other sets that are similar to each set; with ``across`` only of those on another side.

    A set meets all that share a shingle with it through the holders of its
    shingles. What is held per set is bounded by the shingles of the task.
    """
    sizes = np.asarray([len(i) for i in items])
    _, numbers = np.unique(np.concatenate(items), return_inverse=True)
    holders = np.repeat(np.arange(len(items)), sizes)[np.argsort(numbers, kind="stable")]
    counts = np.bincount(numbers)
    starts = offsets(counts)
    begins = offsets(sizes)
    total = np.zeros(len(items), np.int64)
    for x, n in enumerate(sizes):
        own = numbers[begins[x] : begins[x + 1]]
        held = counts[own]
        places = np.arange(held.sum()) + np.repeat(starts[own] - offsets(held)[:-1], held)
        common = np.bincount(holders[places], minlength=len(items))
        linked = (common > 0) & (100 * common >= similar * (n + sizes - common))
        linked[x] = False
        if across:
            linked &= sides != sides[x]
        total[x] = weights[linked].sum()
    return total


def _pairs_of(members: DataFrame, similar: int) -> DataFrame:
    """Pairs of fitting sizes in regions of bounded size, once a region; ``meets`` tells whether a link may be found there."""
    left, right = (members.select("region", *[F.col(c).alias(f"{c}_{x}") for c in ("node", "n", "place")]) for x in "ab")
    n_a, n_b = F.col("n_a"), F.col("n_b")
    overlap = _overlap(n_a, n_b, similar)
    meets = (F.col("place_a") <= n_a - overlap) & (F.col("place_b") <= n_b - overlap)
    joined = left.join(right, "region").filter("node_a < node_b").filter(_sizes_allow(n_a, n_b, similar))
    return joined.select(F.col("node_a").alias("a"), F.col("node_b").alias("b"), "n_a", "n_b", meets.alias("meets"))


def node_classes(
    reps: DataFrame,
    sets_of: Callable[[DataFrame], DataFrame],
    similar: int = SIMILAR,
    small: int = SMALL_REGION,
    task_items: int = TASK_ITEMS,
) -> DataFrame:
    """``node, comp`` of all linked nodes.

    ``reps`` has node, n and prefix of each node; ``sets_of`` gives the sets of
    wanted nodes. Of two similar sets the smaller has a common shingle among its
    first few (it leads there), the larger among those that its size and the
    smaller's leave; a node that can be neither in a region is not in it.
    """
    join = _Join(similar)
    postings = reps.select("node", "n", F.posexplode("prefix").alias("place", "region"))
    lead = F.col("place") < F.col("n") - _overlap(F.col("n"), F.col("n"), similar) + 1
    shared = postings.groupBy("region").agg(
        F.count(F.lit(1)).alias("size"), F.min("node").alias("a"), F.max("node").alias("b"),
        F.min("n").alias("n_a"), F.max("n").alias("n_b"), F.min(F.when(lead, F.col("n"))).alias("least"),
    )
    shared = materialize(shared.filter("size > 1"), "shared")
    several = shared.filter("size > 2").select("region", F.col("size").alias("shared_by"), "least")
    posted = materialize(lookup_join(postings, several, "region", "node"), "posted")
    few, crowd = posted.filter(F.col("shared_by") <= small), posted.filter(F.col("shared_by") > small)
    twos = shared.filter("size = 2").filter(_sizes_allow(F.col("n_a"), F.col("n_b"), similar)).select("a", "b", "n_a", "n_b", F.lit(True).alias("meets"))
    pairs = twos.unionByName(_pairs_of(few, similar)).groupBy("a", "b")
    counted = pairs.agg(
        F.count(F.lit(1)).alias("c"), F.max("meets").alias("meets"), F.first("n_a").alias("n_a"), F.first("n_b").alias("n_b")
    )
    counted = materialize(counted.filter("meets").withColumn("strong", _can_link(similar)), "counted")
    # Nodes of crowded regions may share more than these counts tell, so their pairs stay.
    crowded = materialize(crowd.select("node").distinct(), "crowded")
    weak = counted.filter("NOT strong").join(crowded.toDF("a"), "a", "left_semi").join(crowded.toDF("b"), "b", "left_semi")
    near = materialize(counted.filter("strong").select("a", "b").unionByName(weak.select("a", "b")), "near")
    partner = F.greatest("least", F.ceil(F.lit(similar) * F.col("n") / 100))
    follows = (partner <= F.col("n")) & (F.col("place") < F.col("n") - _overlap(F.col("n"), partner, similar) + 1)
    large = join.open_regions(crowd.filter(lead | follows).select("region", "node", "n"))
    wanted = near.select(F.explode(F.array("a", "b")).alias("node")).unionByName(large.select("node")).distinct()
    sets = sets_of(materialize(wanted, "wanted"))

    home = large.groupBy("node").agg(F.max(F.struct("size", "pivot", "n", "n_pivot")).alias("home"))
    home = home.filter("node <> home.pivot").filter(_sizes_allow(F.col("home.n"), F.col("home.n_pivot"), similar))
    join.measure(home.select(F.col("node").alias("a"), F.col("home.pivot").alias("b")), sets)
    large = join.open_regions(large.select("region", "node", "n"))
    near = _between_classes(join, near)
    large, near = _joined_in_tasks(join, large, near, sets, task_items)
    if not near.isEmpty():
        join.measure(near, sets)

    for _ in range(MOST_LEVELS):
        large = join.open_regions(large.select("region", "node", "n"))
        if large.isEmpty():
            return join.classes
        fits = F.col("region_items") <= task_items
        join.link(join.local(large.filter(fits), sets))
        large = large.filter(~fits)
        stars = large.filter("node <> pivot").filter(_sizes_allow(F.col("n"), F.col("n_pivot"), join.boundary))
        found = join.measure(stars.select(F.col("node").alias("a"), F.col("pivot").alias("b")).distinct(), sets)
        large = materialize(_cells(join, large, found), "cells")
    large = join.open_regions(large)
    if not large.isEmpty():
        join.link(join.local(_block_pairs(large, task_items), sets))
    return join.classes


def _between_classes(join: _Join, pairs: DataFrame) -> DataFrame:
    """The pairs whose nodes are not one class already."""
    first = join.classes.select(F.col("node").alias("a"), F.col("comp").alias("comp_a"))
    second = join.classes.select(F.col("node").alias("b"), F.col("comp").alias("comp_b"))
    joined = pairs.join(first, "a", "left").join(second, "b", "left")
    apart = F.coalesce("comp_a", "a") != F.coalesce("comp_b", "b")
    return materialize(joined.filter(apart).select("a", "b"), "near")


def _joined_in_tasks(
    join: _Join, large: DataFrame, near: DataFrame, sets: DataFrame, task_items: int
) -> tuple[DataFrame, DataFrame]:
    """Joins what overlaps, directly or not, in one task if it fits; returns the regions and pairs that do not."""
    edges = large.select(F.col("node").alias("u"), F.col("region").alias("v"))
    union = materialize(components(edges.unionByName(near.toDF("u", "v"))), "unions").withColumnRenamed("comp", "union")
    members = union.join(sets.select("node", "n"), "node")
    weights = members.groupBy("union").agg(F.sum("n").alias("items"))
    sized = materialize(lookup_join(union, materialize(weights, "weights"), "union", "node"), "sized")
    fits = sized.filter(F.col("items") <= task_items).select(F.col("union").alias("region"), "node")
    join.link(join.local(fits, sets))
    beyond = materialize(sized.filter(F.col("items") > task_items).select("node"), "beyond")
    return large.join(beyond, "node", "left_semi"), near.join(beyond.toDF("a"), "a", "left_semi")


def _block_pairs(large: DataFrame, task_items: int) -> DataFrame:
    """Regions cut into blocks by hash, as regions of two blocks each: every pair of nodes meets in one of them."""
    blocks = F.greatest(F.lit(1), F.ceil(4 * F.col("region_items") / F.lit(task_items))).cast("bigint")
    own = F.pmod(F.xxhash64("node", "region"), F.col("blocks"))
    rows = large.withColumn("blocks", blocks).withColumn("own", own)
    other = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("other")
    paired = rows.select("region", "node", "own", other)
    return paired.select(F.xxhash64("region", F.least("own", "other"), F.greatest("own", "other")).alias("region"), "node")


def _overlap(n_a: Column, n_b: Column, similar: int) -> Column:
    """Fewest common shingles of similar sets of these sizes."""
    return F.ceil(similar * (n_a + n_b) / (100 + similar))


def _can_link(similar: int) -> Column:
    """Whether a pair with ``c`` common prefix shingles, and no common large region, can be similar.

    Beyond the prefix whose last shingle comes first, at most the rest of its
    set can be common.
    """
    n_a, n_b = F.col("n_a"), F.col("n_b")
    rest = [F.ceil(similar * n / 100) - 1 for n in (n_a, n_b)]
    return _sizes_allow(n_a, n_b, similar) & ((100 + similar) * (F.col("c") + F.greatest(*rest)) >= similar * (n_a + n_b))


def _cells(join: _Join, large: DataFrame, found: DataFrame) -> DataFrame:
    """The regions below each large one: inner cell with boundary, and boundary with outer cell.

    The pivot has met all others and leaves. An inner cell without boundary is
    one class and ends here.
    """
    cell = F.when(join.within(join.similar), 0).when(join.within(join.boundary), 1).otherwise(2)
    measured = found.select(F.col("a").alias("node"), F.col("b").alias("pivot"), cell.alias("cell"))
    members = large.select("region", "node", "n", "pivot").filter("node <> pivot")
    placed = members.join(measured, ["node", "pivot"], "left")
    sides = F.when(F.col("cell") == 0, F.array(F.lit(0))).when(F.col("cell") == 1, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(1)))
    below = placed.select("node", "n", "region", F.explode(sides).alias("side"))
    return below.select(F.xxhash64("region", "side").alias("region"), "node", "n")


def members_of(documents: DataFrame, key: str = "doc_id", similar: int = SIMILAR) -> tuple[DataFrame, DataFrame]:
    """Signatures of all documents and ``node, comp`` of all nodes that links or copies join to others."""
    context = documents.sparkSession.sparkContext
    counts = context.broadcast(bucket_counts(documents))
    members = materialize(signatures(documents, counts, key), "signatures")
    reps = members.filter("node IS NOT NULL").groupBy("node").agg(F.first("n").alias("n"), F.first("prefix").alias("prefix"))
    reps = materialize(reps, "nodes")
    classes = node_classes(reps, lambda wanted: node_sets(documents, members, wanted, key), similar)
    return members, classes


def classes(documents: DataFrame, key: str = "doc_id", similar: int = SIMILAR) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id.

    component_id is the smallest doc_id that links (similarity of at least
    ``similar`` per cent) reach. A null or empty text has no shingles and links
    with nothing, not even another one. Repeated rows are copies. A null id
    takes part in links, but names no class unless all ids of it are null.
    Other columns are not read. A set is known by its 64-bit hash.
    """
    members, linked = members_of(documents, key, similar)
    firsts = members.filter("node IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("copies"))
    firsts = materialize(firsts, "firsts")
    in_links = firsts.join(linked, "node").select("node", "comp", "first")
    least = materialize(in_links.groupBy("comp").agg(F.min("first").alias("component")), "least")
    answers = lookup_join(in_links, least, "comp", "node").select("node", "component")
    alone = firsts.filter("copies > 1").join(linked, "node", "left_anti").select("node", F.col("first").alias("component"))
    answers = materialize(answers.unionByName(alone), "answers")
    rows = members.select("doc_id", "n", "node", F.monotonically_increasing_id().alias("spread"))
    joined = lookup_join(rows, answers, "node", "spread", how="left")
    return joined.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))


def node_links(nodes: DataFrame, sets: DataFrame, similar: int = SIMILAR, task_items: int = TASK_ITEMS) -> DataFrame:
    """``node, n_links`` of the linked nodes (node, comp, n, copies): copies of the other nodes that are similar.

    All links of a node lie in its class. A class of up to ``task_items``
    shingles is counted in one task; a larger one is cut into blocks by hash,
    and each two blocks, and each block with itself, are a task of their own.
    """
    weights = materialize(nodes.groupBy("comp").agg(F.sum("n").alias("items")), "weights")
    blocks = F.when(F.col("items") > task_items, F.ceil(4 * F.col("items") / F.lit(task_items))).otherwise(1).cast("bigint")
    sized = lookup_join(nodes, weights, "comp", "node").withColumn("blocks", blocks)
    sided = sized.withColumn("side", F.pmod(F.xxhash64("node", "comp"), F.col("blocks")))
    other = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("other")
    paired = sided.select("node", "comp", "copies", "side", other)
    low, high = F.least("side", "other").alias("low"), F.greatest("side", "other").alias("high")
    placed = materialize(paired.select("node", "comp", "copies", "side", low, high), "placed")
    types = pa.schema([("node", pa.int64()), ("n_links", pa.int64())])

    def count(rows: pa.Table) -> pa.Table:
        items = [np.frombuffer(i, np.uint64) for i in rows.column("items").to_pylist()]
        copies, sides = (rows.column(c).to_numpy() for c in ("copies", "side"))
        across = rows.column("low")[0].as_py() != rows.column("high")[0].as_py()
        total = task_counts(items, copies, sides, across, similar)
        return pa.table({"node": rows.column("node"), "n_links": pa.array(total, pa.int64())}, schema=types)

    rows = lookup_join(sets.select("node", "items"), placed, "node", "node")
    counted = rows.groupBy("comp", "low", "high").applyInArrow(count, "node bigint, n_links bigint")
    return counted.groupBy("node").agg(F.sum("n_links").alias("n_links"))


def link_counts(documents: DataFrame, key: str = "doc_id", similar: int = SIMILAR, task_items: int = TASK_ITEMS) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, n_links.

    n_links counts the other documents of a similarity of at least ``similar``
    per cent. Rows and components as in ``classes``: repeated rows and equal
    texts link with each other, a text without shingles has no links. Every
    pair of different sets of a class that share a shingle is counted, so a
    class of many near copies costs as the square of its size.
    """
    members, linked = members_of(documents, key, similar)
    copies = members.filter("node IS NOT NULL").groupBy("node").agg(
        F.count(F.lit(1)).alias("copies"), F.first("n").alias("n"), F.min("doc_id").alias("first")
    )
    copies = materialize(copies, "copies")
    nodes = materialize(linked.join(copies, "node"), "linked")
    sets = node_sets(documents, members, nodes.select("node"), key)
    links = materialize(node_links(nodes.drop("first"), sets, similar, task_items), "links")
    least = materialize(nodes.groupBy("comp").agg(F.min("first").alias("component")), "least")
    named = lookup_join(nodes.select("node", "comp"), least, "comp", "node").select("node", F.lit(0).alias("n_links"), "component")
    several = copies.filter("copies > 1").select("node", (F.col("copies") - 1).alias("n_links"), F.col("first").alias("component"))
    known = several.unionByName(links.withColumn("component", F.lit(None).cast("bigint"))).unionByName(named)
    answers = known.groupBy("node").agg(F.sum("n_links").alias("n_links"), F.min("component").alias("component"))
    answers = materialize(answers, "answers")
    rows = members.select("doc_id", "n", "node", F.monotonically_increasing_id().alias("spread"))
    joined = lookup_join(rows, answers, "node", "spread", how="left")
    return joined.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.coalesce("component", "doc_id").alias("component_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
    )


def keep_one(documents: DataFrame, key: str = "doc_id", similar: int = SIMILAR) -> DataFrame:
    """The document with the smallest id of each class, with its own columns; texts without words all stay.

    Rows are told apart by id and text, a null id comes last; of rows that are
    equal in both one stays.
    """
    members, linked = members_of(documents, key, similar)
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")
    ranked = members.filter("node IS NOT NULL").groupBy("node").agg(F.min(rank).alias("first"))
    ranked = ranked.join(linked, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    chosen = ranked.groupBy("comp").agg(F.min("first").alias("first"))
    name = _id_text(F.col("first.doc_id"), F.col("first.text_key"))
    keepers = chosen.select(name.alias("name"), F.lit(True).alias("keeper"))
    named = members.filter("node IS NOT NULL").select(_id_text(F.col("doc_id"), F.col("text_key")).alias("name"))
    counted = named.groupBy("name").agg(F.count(F.lit(1)).alias("rows"))
    verdicts = materialize(counted.join(keepers, "name", "left"), "verdicts")
    tag = "_near_duplicate_name"
    rows = documents.withColumn(tag, _id_text(F.col(key), F.xxhash64(F.col("text").cast("string"))))

    def tagged(chosen: str) -> DataFrame:
        return verdicts.filter(chosen).select(F.col("name").alias(tag))

    kept = lookup_join(rows, tagged("keeper IS NULL"), tag, key, how="left_anti")
    again = materialize(tagged("keeper AND rows > 1"), "repeated")
    if not again.isEmpty():
        once = lookup_join(kept, again, tag, key, how="left_semi").dropDuplicates([tag])
        kept = lookup_join(kept, again, tag, key, how="left_anti").unionByName(once)
    return kept.select(*documents.columns)
