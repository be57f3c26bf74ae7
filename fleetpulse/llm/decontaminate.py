"""Benchmark decontamination by suffix arrays over shards of the training texts.

A shard is a bounded run of documents. Its words become numbers in a benchmark
block's vocabulary (0 for any other word), and its suffix array orders the
suffixes that can match: those whose first words all belong to the benchmark.
Every benchmark suffix is searched in it by bisection, which gives all places
of its first ``window`` words; neighbouring places on one diagonal join into
longest verbatim matches. Benchmarks larger than a block are taken in blocks,
each sent to the workers once.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetpulse.llm.common import STAGE_BYTES, Batches, bytes_of, map_batches, sha256_hex, take_over

WINDOW = 10
BLOCK_BYTES = 32 << 20
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def words_of(text: bytes) -> list[bytes]:
    """Runs of digits, lowered A-Z and characters beyond ASCII."""
    return _WORD.findall(text.lower())


@dataclass(frozen=True)
class Block:
    """Search form of some benchmark items.

    Items of equal words are one entry. ``keys`` has a row of ``window`` word
    numbers for each distinct window (0 behind a short item's end). The entries
    of window w, and its places in them, stand from ``first[w]`` to
    ``first[w + 1]``.
    """

    vocabulary: dict[bytes, int]
    keys: np.ndarray
    lengths: np.ndarray  # words that must match
    first: np.ndarray
    entries: np.ndarray
    places: np.ndarray  # first word in the entry
    item_ids: list[list[int]]  # of each entry, ascending; none if all are null


def make_block(items: list[tuple[int | None, str | None]], window: int) -> Block:
    vocabulary: dict[bytes, int] = {}
    owners: dict[tuple[int, ...], set] = {}
    for item, text in items:
        ids = tuple(vocabulary.setdefault(w, len(vocabulary) + 1) for w in words_of((text or "").encode()))
        if ids:
            owners.setdefault(ids, set()).add(item)
    tables = [np.zeros((0, window), np.uint32)]
    for ids in owners:
        row = np.asarray(ids + (0,) * (window - len(ids)), np.uint32)
        tables.append(np.lib.stride_tricks.sliding_window_view(row, window))
    counts = [len(t) for t in tables[1:]]
    keys, number = np.unique(np.concatenate(tables), axis=0, return_inverse=True)
    number = number.reshape(-1)
    order = np.argsort(number, kind="stable")
    entries = np.repeat(np.arange(len(counts)), counts)
    places = np.arange(len(number)) - np.repeat(np.cumsum(counts, dtype=np.int64) - counts, counts)
    first = np.searchsorted(number[order], np.arange(len(keys) + 1))
    listed = [sorted(i for i in ids if i is not None) for ids in owners.values()]
    return Block(vocabulary, keys, (keys > 0).sum(axis=1), first, entries[order], places[order], listed)


def benchmark_blocks(benchmark: DataFrame, window: int, block_bytes: int, key: str = "item_id") -> Iterator[Block]:
    """The benchmark in blocks of bounded bytes, one at a time on the driver; at least one, maybe empty."""
    items: list[tuple[int | None, str | None]] = []
    size, made = 0, False
    for row in benchmark.select(F.col(key).alias("item"), F.col("text").cast("string").alias("text")).toLocalIterator():
        items.append((row["item"], row["text"]))
        size += len(row["text"] or "") + 16
        if size >= block_bytes:
            yield make_block(items, window)
            items, size, made = [], 0, True
    if items or not made:
        yield make_block(items, window)


class SuffixArray:
    """Sorted suffixes of a shard's word numbers, compared by their first ``depth`` numbers."""

    def __init__(self, words: np.ndarray, depth: int, least: int):
        """``least``: words that any search matches, so suffixes that hold a 0 before are left out."""
        foreign = np.flatnonzero(words == 0)
        run = np.concatenate([foreign, [len(words)]])
        stop = run[np.searchsorted(foreign, np.arange(len(words)))] if len(words) else np.zeros(0, np.int64)
        place = np.flatnonzero(stop - np.arange(len(words)) >= least)
        padded = np.concatenate([words, np.zeros(depth, words.dtype)])
        columns = [np.where(place + k < stop[place], padded[place + k], 0) for k in range(depth)]
        order = np.lexsort(columns[::-1]) if len(place) else place
        self.columns = [c[order] for c in columns]
        self.places = place[order]

    def find(self, keys: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each key the range of suffixes that begin with its first ``lengths`` numbers."""
        beyond = np.iinfo(np.uint32).max
        last = np.where(np.arange(keys.shape[1]) < lengths[:, None], keys, beyond)
        return self._bisect(keys), self._bisect(last, above=True)

    def _bisect(self, keys: np.ndarray, above: bool = False) -> np.ndarray:
        """Suffixes below each key (``above``: not above it), by bisection of all keys at once."""
        low = np.zeros(len(keys), np.int64)
        high = np.full(len(keys), len(self.places), np.int64)
        while (open_ := low < high).any():
            middle = (low + high) // 2
            probe = np.minimum(middle, max(len(self.places) - 1, 0))
            less = np.zeros(len(keys), bool)
            tied = open_.copy()
            for k, column in enumerate(self.columns):
                value = column[probe]
                less |= tied & (value < keys[:, k])
                tied &= value == keys[:, k]
            if above:
                less |= tied
            low, high = np.where(open_ & less, middle + 1, low), np.where(open_ & ~less, middle, high)
        return low


Match = tuple[int, int, int, int]  # entry, first word in the document, first word in the entry, words
Hits = tuple[np.ndarray, np.ndarray]  # windows and their first words in the document


def window_hits(texts: list[bytes], block: Block, window: int) -> list[tuple[int, Hits]]:
    """Words of each text and the block's distinct windows in it: at most one of each length at a word."""
    number = block.vocabulary.get
    sizes, parts = [], []
    for text in texts:
        words = words_of(text)
        sizes.append(len(words))
        parts.append(np.fromiter((number(w, 0) for w in words), np.uint32, len(words)))
        parts.append(np.zeros(1, np.uint32))  # no match crosses documents
    none = np.zeros(0, np.int64)
    if not len(block.keys) or not texts:
        return [(n, (none, none)) for n in sizes]
    array = SuffixArray(np.concatenate(parts), window, int(block.lengths.min()))
    low, high = array.find(block.keys, block.lengths)
    key, nth = _spread(low, high)
    place = array.places[nth]
    order = np.argsort(place, kind="stable")
    key, place = key[order], place[order]
    starts = np.cumsum([0, *(n + 1 for n in sizes)])
    cut = np.searchsorted(place, starts)
    return [(n, (key[a:b], place[a:b] - at)) for n, a, b, at in zip(sizes, cut, cut[1:], starts)]


def _spread(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every number of every range, with the range it is of."""
    count = high - low
    owner = np.repeat(np.arange(len(count)), count)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low, count)


def longest(hits: Hits, block: Block) -> list[Match]:
    """The hits of one document, joined along diagonals into longest matches with each entry."""
    which, nth = _spread(block.first[hits[0]], block.first[hits[0] + 1])
    if not len(which):
        return []
    entry, inside, at, length = block.entries[nth], block.places[nth], hits[1][which], block.lengths[hits[0]][which]
    order = np.lexsort((at, at - inside, entry))
    entry, inside, at, length = (x[order] for x in (entry, inside, at, length))
    joins = (np.diff(entry) == 0) & (np.diff(at - inside) == 0) & (np.diff(at) == 1)
    first = np.flatnonzero(np.concatenate([[True], ~joins]))
    last = np.concatenate([first[1:], [len(at)]]) - 1
    return list(zip(*(x.tolist() for x in (entry[first], at[first], inside[first], at[last] + length[last] - at[first]))))


def search_shard(texts: list[bytes], block: Block, window: int) -> list[tuple[int, list[Match]]]:
    """Words and longest matches of each text."""
    return [(n, longest(hits, block)) for n, hits in window_hits(texts, block, window)]


def hit_words(matches: list[tuple[int, int]]) -> int:
    """Words inside any of the (first word, words) stretches."""
    total = end = 0
    for begin, words in sorted(matches):
        total += max(0, begin + words - max(begin, end))
        end = max(end, begin + words)
    return total


_MATCH = "struct<item_id bigint, doc_word bigint, item_word bigint, n_words bigint>"


def _sent(documents: DataFrame, benchmark: DataFrame, window: int, block_bytes: int) -> list[Broadcast]:
    context = documents.sparkSession.sparkContext
    return [context.broadcast(b) for b in benchmark_blocks(benchmark, window, block_bytes)]


def _summary(block: Block, texts: list[bytes], window: int) -> Iterator[tuple[int, list[tuple[int, int]], set[int], list[dict]]]:
    """Words, hit stretches, item ids and listed matches of each text."""
    for n, hits in window_hits(texts, block, window):
        distinct = np.unique(hits[0])
        entries = np.unique(block.entries[_spread(block.first[distinct], block.first[distinct + 1])[1]])
        items = {i for e in entries for i in block.item_ids[e]}
        stretches = list(zip(hits[1].tolist(), block.lengths[hits[0]].tolist()))
        first = lambda e: block.item_ids[e][0] if block.item_ids[e] else None
        listed = [dict(zip(("item_id", "doc_word", "item_word", "n_words"), (first(e), *rest))) for e, *rest in longest(hits, block)]
        yield n, stretches, items, listed


def report(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES, key: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, matches.

    ``matches`` lists the longest verbatim matches of at least a window; items
    of equal words share one, under the smallest id. Hits and items come from
    the distinct windows, so equal and overlapping items cost one search. A
    window is ``window`` consecutive words of an item, or a whole shorter item.
    Null texts have no words, items without words no window; a null item id is
    left out of ``n_items`` and the digest but its hits count; equal ids count
    once. Null and repeated document ids keep their rows, other columns are not
    read. No shuffle; a shard is one Arrow batch.
    """
    blocks = _sent(documents, benchmark, window, block_bytes)
    match = pa.struct([(n, pa.int64()) for n in ("item_id", "doc_word", "item_word", "n_words")])
    types = pa.schema(
        [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_hit", pa.int64()), ("n_items", pa.int64())]
        + [("items_sha256", pa.string()), ("contaminated", pa.bool_()), ("matches", pa.list_(match))]
    )

    def run(batches: Batches) -> Batches:
        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), bytes_of(batch)
            found = [_summary(block.value, texts, window) for block in blocks]
            out = []
            for doc_id, parts in zip(ids, zip(*found)):
                hit = hit_words([stretch for _, stretches, _, _ in parts for stretch in stretches])
                items = sorted({str(i) for _, _, own, _ in parts for i in own})
                out.append((doc_id, parts[0][0], hit, len(items), sha256_hex(",".join(items)), hit > 0, [m for p in parts for m in p[3]]))
            columns = list(zip(*out)) if out else [[] for _ in types]
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(columns, types)], schema=types)

    rows = documents.select(F.col(key).cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = (
        "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean, "
        f"matches array<{_MATCH}>"
    )
    return map_batches(rows, run, schema)


def decontaminate(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents without those that hold a window of the benchmark; rows and columns else unchanged."""
    blocks = _sent(documents, benchmark, window, block_bytes)

    def run(batches: Batches) -> Batches:
        take_over("decontamination")
        for batch in batches:
            texts = bytes_of(batch)
            hit = np.zeros(len(texts), bool)
            for block in blocks:
                hit |= [len(windows) > 0 for _, (windows, _) in window_hits(texts, block.value, window)]
            yield batch.filter(pa.array(~hit))

    return map_batches(documents, run, documents.schema, STAGE_BYTES)
