"""Near duplicates by min-max hashing.

Every permutation of the shingle hashes gives two values of a signature, its
minimum and its maximum, so 64 permutations make 128 values: half the hash
evaluations, and an unbiased estimate whose variance is lower than that of 128
minima. Two permutations (four values) are a band; texts that agree in a band
share a bucket. At the limit of 80 % a pair misses all 32 bands with a
probability of 5e-8.

Texts with equal sets are one node. Buckets are put together where they overlap
and compared in one task if that is bounded in shingles and in pairs; there the
signatures sort out pairs and whole sets confirm them. The nodes of larger ones
first meet pivots, another one in every bucket and round, which makes one class
of most of a group of copies; buckets that still hold several classes are tried
again, and what is left after some rounds is compared in pairs of blocks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetpulse.llm.common import Batches, Memo, bytes_of, map_batches, offsets
from fleetpulse.llm.graph import near_components
from fleetpulse.operators.lookup import lookup_join
from fleetpulse.sinks.tables import materialize

SHINGLE_WORDS = 4
SIMILAR = 80  # per cent
PERMUTATIONS = 64
BAND_PERMUTATIONS = 2
# Two sets at the limit agree in 102 of 128 values on average; fewer than 70 have a probability below 1e-10.
LEAST_AGREEMENT = 70
TASK_ITEMS = 2_000_000  # shingles that one task compares, 16 MB
TASK_PAIRS = 200_000_000  # places in buckets that one task looks at: the sum of their squared sizes
BLOCK_NODES = 1_000
PIVOT_ROUNDS = 3
MAX_BROADCAST = 8 << 20
ROWS_PER_TASK = 50_000
_ROWS_AT_ONCE = 2_048


def _odd_numbers(label: str, n: int) -> np.ndarray:
    return np.asarray([xxhash.xxh3_64_intdigest(f"{label}:{i}") | 1 for i in range(n)], np.uint64)


_PLACES = _odd_numbers("place", SHINGLE_WORDS)
_FACTORS, _SHIFTS = _odd_numbers("factor", PERMUTATIONS), _odd_numbers("shift", PERMUTATIONS)
_BAND_PLACES = _odd_numbers("band", 2 * BAND_PERMUTATIONS)
_MIX = _odd_numbers("mix", 2)


class _WordHashes(Memo):
    def __missing__(self, word: bytes) -> int:
        value = self.recall(word)
        if value is None:
            value = xxhash.xxh3_64_intdigest(word)
            self.trim()
            self.keep(word, value)
        return value


_WORDS = _WordHashes(300_000)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX[0]
    x = (x ^ (x >> np.uint64(29))) * _MIX[1]
    return x ^ (x >> np.uint64(32))


def shingle_set(text: bytes) -> np.ndarray:
    """Sorted 64-bit hashes of a text's distinct word shingles; a shorter text is one shingle."""
    words = text.lower().split()  # of bytes: A-Z only, and the six ASCII blanks
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))
    size = min(SHINGLE_WORDS, len(words))
    total = np.full(len(words) - size + 1, size, np.uint64)
    for k in range(size):
        total += hashes[k : k + len(total)] * _PLACES[k]
    return np.unique(_mixed(total))


def signature(items: np.ndarray) -> np.ndarray:
    """Minima and maxima of a set under every permutation: two rows."""
    low = np.full(PERMUTATIONS, np.iinfo(np.uint64).max, np.uint64)
    high = np.zeros(PERMUTATIONS, np.uint64)
    for at in range(0, len(items), _ROWS_AT_ONCE):
        permuted = items[at : at + _ROWS_AT_ONCE, None] * _FACTORS + _SHIFTS
        np.minimum(low, permuted.min(axis=0), out=low)
        np.maximum(high, permuted.max(axis=0), out=high)
    return np.stack([low, high])


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """Bucket of every band, from signatures of shape (n, 2, PERMUTATIONS)."""
    n, bands = len(signatures), PERMUTATIONS // BAND_PERMUTATIONS
    values = signatures.reshape(n, 2, bands, BAND_PERMUTATIONS).transpose(0, 2, 1, 3).reshape(n, bands, 2 * BAND_PERMUTATIONS)
    return _mixed((_mixed(values) * _BAND_PLACES).sum(axis=2, dtype=np.uint64) + np.arange(bands, dtype=np.uint64))


def signed(documents: DataFrame, key: str = "doc_id") -> DataFrame:
    """``row, doc_id, n, digest, bands, items``, written; without shingles digest, bands and items are null."""
    columns = [("row", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int64()), ("digest", pa.binary()),
               ("bands", pa.list_(pa.int64())), ("items", pa.binary())]
    types = pa.schema(columns)

    def run(batches: Batches) -> Batches:
        for batch in batches:
            sets = [shingle_set(t) for t in bytes_of(batch)]
            full = [k for k, own in enumerate(sets) if len(own)]
            bands: list[np.ndarray | None] = [None] * len(sets)
            if full:
                keys = band_keys(np.stack([signature(sets[k]) for k in full])).view(np.int64)
                for k, own in zip(full, keys):
                    bands[k] = own
            items = [own.tobytes() if len(own) else None for own in sets]
            arrays = [
                pa.array([len(own) for own in sets], pa.int64()),
                pa.array([i and xxhash.xxh3_128_digest(i) for i in items], pa.binary()),
                pa.array(bands, pa.list_(pa.int64())),
                pa.array(items, pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("doc_id"), *arrays], schema=types)

    text = F.col("text").cast("string").alias("text")
    rows = documents.select(F.col(key).cast("bigint").alias("doc_id"), text, F.monotonically_increasing_id().alias("row"))
    schema = "row bigint, doc_id bigint, n bigint, digest binary, bands array<bigint>, items binary"
    return materialize(map_batches(rows, run, schema), "signatures")


def _lookup(facts: DataFrame, table: DataFrame, key: str, spread_by: str, how: str = "inner") -> DataFrame:
    return lookup_join(facts, table, key, spread_by, how, MAX_BROADCAST, ROWS_PER_TASK)


def _sizes_allow(n_a: Column, n_b: Column, similar: int) -> Column:
    return 100 * F.least(n_a, n_b) >= similar * F.greatest(n_a, n_b)


def _confirmed(pairs: DataFrame, sets: DataFrame, similar: int) -> DataFrame:
    """The pairs ``a, b`` whose whole sets are similar enough."""
    pairs = materialize(pairs, "pairs")
    left = sets.select(F.col("node").alias("a"), F.col("items").alias("items_a"))
    right = sets.select(F.col("node").alias("b"), F.col("items").alias("items_b"))
    right = materialize(_lookup(right, pairs.select("b").distinct(), "b", "b", how="left_semi"), "pivots")
    types = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Batches) -> Batches:
        for batch in batches:
            ours, theirs = ([np.frombuffer(i, np.uint64) for i in batch.column(c).to_pylist()] for c in ("items_a", "items_b"))
            linked = pa.array([_similar(x, y, similar) for x, y in zip(ours, theirs)], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], schema=types).filter(linked)

    joined = _lookup(left.join(pairs, "a"), right, "b", "a")
    return map_batches(joined.select("a", "b", "items_a", "items_b"), run, "a bigint, b bigint")


def _similar(x: np.ndarray, y: np.ndarray, similar: int) -> bool:
    common = np.intersect1d(x, y, assume_unique=True).size
    return 100 * common >= similar * (len(x) + len(y) - common)


def task_classes(items: list[np.ndarray], classes: list[int], buckets: list[list[int]], similar: int) -> np.ndarray:
    """The classes of sets, joined by confirmed links between those that share a bucket: equal numbers are one class.

    A node meets all later ones of its buckets at once by signature; those that
    agree enough, and are not in its class by then, are compared in full.
    """
    # The last byte of each value: never fewer agreements than of whole values, and half of one more by chance.
    signatures = np.stack([_mixed(signature(i)).astype(np.uint8).ravel() for i in items])
    sizes = np.asarray([len(i) for i in items])
    labels = np.unique(np.asarray(classes), return_inverse=True)[1]
    numbers, starts = np.unique(np.concatenate(items), return_inverse=True)[1], offsets(sizes)
    held = np.zeros(int(numbers.max()) + 1, bool)
    found: dict[int, list[int]] = {}
    for x, keys in enumerate(buckets):
        for own in keys:
            found.setdefault(own, []).append(x)
    holders = {own: np.asarray(met) for own, met in found.items()}
    for x, keys in enumerate(buckets):
        met = np.zeros(len(items), bool)
        for own in keys:
            met[holders[own]] = True
        apart = np.flatnonzero(met[x + 1 :]) + x + 1
        apart = apart[labels[apart] != labels[x]]
        apart = apart[100 * np.minimum(sizes[apart], sizes[x]) >= similar * np.maximum(sizes[apart], sizes[x])]
        near = apart[(signatures[apart] == signatures[x]).sum(axis=1) >= LEAST_AGREEMENT]
        if not len(near):
            continue
        held[numbers[starts[x] : starts[x + 1]]] = True
        ends = np.cumsum(sizes[near])
        places = np.arange(ends[-1]) + np.repeat(starts[near] - ends + sizes[near], sizes[near])
        common = np.add.reduceat(held[numbers[places]], ends - sizes[near], dtype=np.int64)
        held[numbers[starts[x] : starts[x + 1]]] = False
        for y in near[100 * common >= similar * (sizes[x] + sizes[near] - common)].tolist():
            if labels[x] != labels[y]:
                labels[labels == labels[y]] = labels[x]
    return labels


def _chosen(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows whose node is wanted. Nodes are dense numbers, so one bit each tells: 4 KB for 32,768 of them."""
    place, slot = F.bitmap_bit_position("node"), F.bitmap_bucket_number("node")
    bits = wanted.groupBy(slot.alias("slot")).agg(F.bitmap_construct_agg(place).alias("bits"))
    met = _lookup(rows.withColumn("slot", slot), materialize(bits, "bits"), "slot", "node")
    byte = F.conv(F.hex(F.substring("bits", F.expr("CAST(bitmap_bit_position(node) div 8 + 1 AS INT)"), F.lit(1))), 16, 10).cast("int")
    held = byte.bitwiseAND(F.expr("shiftleft(1, CAST(bitmap_bit_position(node) % 8 AS INT))")) > 0
    return met.filter(held).select(*rows.columns)


class _Classes:
    """The links found so far, kept as the classes that they make."""

    def __init__(self) -> None:
        self.found: DataFrame | None = None

    def start(self, stars: DataFrame) -> None:
        """Classes of regions that share no node, from links of nodes to the smallest of their class."""
        stars = materialize(stars, "stars").select(F.col("u").alias("node"), F.col("v").alias("comp"))
        self.found = stars.unionByName(stars.select(F.col("comp").alias("node"), "comp").distinct())

    def link(self, links: DataFrame) -> None:
        links = links.toDF("u", "v")
        if self.found is not None:
            links = links.unionByName(self.found.select(F.col("node").alias("u"), F.col("comp").alias("v")))
        self.found = materialize(near_components(links), "classes")

    def open(self, members: DataFrame) -> DataFrame:
        """Members (bucket, node, n) of buckets with several classes, with comp, size (nodes), items and low (smallest node)."""
        classed = members.drop("comp").join(self.found, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
        classed = materialize(classed.select("bucket", "node", "n", "comp"), "classed")
        buckets = classed.groupBy("bucket").agg(
            F.count(F.lit(1)).alias("size"), F.sum("n").alias("items"), F.min("node").alias("low"),
            F.min("comp").alias("least"), F.max("comp").alias("most"),
        )
        several = materialize(buckets.filter("least < most").drop("least", "most"), "buckets")
        return materialize(_lookup(classed, several, "bucket", "node"), "open")


def _compared(rows: DataFrame, sets: DataFrame, similar: int) -> DataFrame:
    """Links ``u, v`` from nodes to the smallest of their class within each region of ``region, node, comp, buckets``; one task a region."""
    types = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("node")
        items = [np.frombuffer(i, np.uint64) for i in table.column("items").to_pylist()]
        labels = task_classes(items, table.column("comp").to_pylist(), table.column("buckets").to_pylist(), similar)
        _, first, own = np.unique(labels, return_index=True, return_inverse=True)
        nodes, smallest = table.column("node").to_numpy(), first[own]
        linked = smallest != np.arange(len(nodes))
        return pa.table([nodes[linked], nodes[smallest[linked]]], schema=types)

    placed = materialize(rows, "placed")
    joined = placed.join(sets.select("node", "items"), "node").select("region", "node", "comp", "buckets", "items")
    return joined.groupBy("region").applyInArrow(run, "u bigint, v bigint")


def _unions(opened: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Open members by the regions that their overlapping buckets make: those that fit a task, and those beyond."""
    edges = opened.filter("node <> low").select(F.col("node").alias("u"), F.col("low").alias("v"))
    union = materialize(near_components(edges), "unions").withColumnRenamed("comp", "region")
    # A bucket lies in one region, that of any of its nodes.
    placed = materialize(opened.join(union, "node"), "regions")
    nodes = placed.dropDuplicates(["node"]).groupBy("region").agg(F.sum("n").alias("region_items"))
    buckets = placed.filter("node = low").groupBy("region").agg(F.sum(F.col("size") * F.col("size")).alias("region_pairs"))
    fits = (F.col("region_items") <= TASK_ITEMS) & (F.col("region_pairs") <= TASK_PAIRS)
    sizes = materialize(nodes.join(buckets, "region").select("region", fits.alias("fits")), "sizes")
    judged = materialize(_lookup(placed, sizes, "region", "node"), "judged")
    return judged.filter("fits"), judged.filter("NOT fits")


def _members(postings: DataFrame, shared: DataFrame) -> DataFrame:
    """The postings of shared buckets, with what is known of the buckets.

    A bucket's size tells into how many salted parts it is split, so postings
    are not counted again. At most all postings / ``ROWS_PER_TASK`` are split.
    """
    parts = F.ceil(F.col("size") / F.lit(ROWS_PER_TASK)).cast("bigint")
    split = F.broadcast(shared.filter(F.col("size") > ROWS_PER_TASK).select("bucket", parts.alias("parts")))
    salt = F.pmod(F.xxhash64("node"), F.coalesce("parts", F.lit(1)))
    salted = postings.join(split, "bucket", "left").withColumn("salt", salt).drop("parts")
    table = shared.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), parts - 1)))
    return salted.join(table, ["bucket", "salt"]).drop("salt")


def _pivot_pairs(opened: DataFrame, level: int, similar: int) -> DataFrame:
    """Every open member with a pivot of its bucket that another round or bucket chooses differently."""
    turned = F.xxhash64("bucket", F.lit(level))
    pivots = opened.groupBy("bucket").agg(F.min(F.col("node").bitwiseXOR(turned)).alias("least"))
    pivots = pivots.select("bucket", F.col("least").bitwiseXOR(turned).alias("pivot"))
    own = opened.select(F.col("bucket"), F.col("node").alias("pivot"), F.col("comp").alias("pivot_comp"), F.col("n").alias("n_pivot"))
    chosen = materialize(own.join(pivots, ["bucket", "pivot"]), "pivots")
    met = _lookup(opened, chosen, "bucket", "node").filter("comp <> pivot_comp")
    allowed = met.filter(_sizes_allow(F.col("n"), F.col("n_pivot"), similar))
    return allowed.select(F.col("node").alias("a"), F.col("pivot").alias("b")).distinct()


def _block_pairs(opened: DataFrame) -> DataFrame:
    """Buckets cut into blocks by hash; every two blocks are a region, so all pairs of a bucket meet in one."""
    by_items, by_nodes = F.ceil(4 * F.col("items") / F.lit(TASK_ITEMS)), F.ceil(F.col("size") / F.lit(BLOCK_NODES))
    blocks = F.greatest(F.lit(1).cast("bigint"), by_items, by_nodes)
    own = F.pmod(F.xxhash64("node", "bucket"), blocks)
    other = F.explode(F.sequence(F.lit(0).cast("bigint"), blocks - 1)).alias("other")
    paired = opened.select("bucket", "node", "comp", own.alias("own"), other)
    region = F.xxhash64("bucket", F.least("own", "other"), F.greatest("own", "other"))
    return paired.select(region.alias("region"), "node", "comp", F.array("bucket").alias("buckets"))


def node_classes(reps: DataFrame, sets_of, similar: int = SIMILAR) -> DataFrame | None:
    """``node, comp`` of all linked nodes from ``node, n, bands``; ``sets_of`` gives node and items of wanted nodes."""
    postings = reps.select("node", "n", F.explode("bands").alias("bucket"))
    shared = postings.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("size"), F.sum("n").alias("items"), F.min("node").alias("low"), F.max("node").alias("high")
    )
    shared = materialize(shared.filter("low < high").drop("high"), "shared")
    members = materialize(_members(postings, shared).withColumn("comp", F.col("node")), "members")
    if members.isEmpty():
        return None
    sets = sets_of(members.select("node").distinct())
    classes = _Classes()
    for level in range(PIVOT_ROUNDS):
        fitting, beyond = _unions(members)
        rows = fitting.groupBy("region", "node", "comp").agg(F.collect_list("bucket").alias("buckets"))
        found = _compared(rows, sets, similar)
        classes.link(found) if level else classes.start(found)
        if beyond.isEmpty():
            return classes.found
        classes.link(_confirmed(_pivot_pairs(beyond, level, similar), sets, similar))
        members = classes.open(beyond)
        if members.isEmpty():
            return classes.found
    classes.link(_compared(_block_pairs(members), sets, similar))
    return classes.found


def near_duplicates(documents: DataFrame, key: str = "doc_id", similar: int = SIMILAR) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    component_id is the smallest doc_id that links reach, and that document is
    kept. A null or empty text has no shingles and links with nothing, not even
    another one. Repeated rows are copies of each other; rows that share the
    smallest id are all kept. A null id takes part in links but names no class
    unless no row of the class has an id; then all its rows are kept. Other
    columns are not read.
    """
    rows = signed(documents, key)
    groups = rows.filter("digest IS NOT NULL").groupBy("digest").agg(
        F.min("row").alias("node"), F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("copies")
    )
    copied = materialize(groups.filter("copies > 1").drop("copies"), "copied")
    placed = _lookup(rows.select("row", "doc_id", "n", "digest", "bands"), copied, "digest", "row", how="left")
    own = F.when(F.col("digest").isNotNull(), F.coalesce("node", "row"))
    first = F.when(F.col("node").isNotNull(), F.col("first")).otherwise(F.col("doc_id"))
    leads = F.coalesce("node", "row") == F.col("row")
    placed = placed.select("row", "doc_id", "n", own.alias("node"), first.alias("first"), F.when(leads, F.col("bands")).alias("bands"))
    placed = materialize(placed, "nodes")
    reps = placed.filter("node = row")

    def sets_of(wanted: DataFrame) -> DataFrame:
        return materialize(_chosen(rows.select(F.col("row").alias("node"), "items"), wanted), "sets")

    linked = node_classes(reps.select("node", "n", "bands"), sets_of, similar)
    answers = placed.select("row", "doc_id", "n", "node", "first")
    if linked is None:
        answers = answers.withColumn("component", F.lit(None).cast("bigint"))
    else:
        firsts = materialize(reps.select("node", "first").join(linked, "node"), "firsts")
        least = materialize(firsts.groupBy("comp").agg(F.min("first").alias("component")), "least")
        table = materialize(_lookup(firsts, least, "comp", "node").select("node", "component"), "components")
        answers = _lookup(answers, table, "node", "row", how="left")
    component = F.coalesce("component", "first")
    return answers.select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), component.eqNullSafe(F.col("doc_id")).alias("kept")
    )
