"""Alignment of two tokenisations of the same bytes.

Both tokenisers encode each text, and the bytes of their tokens must join to a
blank and the text. Then all documents of a block are merged in lockstep: one
state vector holds a pointer into the A tokens and one into the B tokens of each
document. A step emits the link of every document's two current tokens, advances
the one that ends first, or both where they end together (a cut), and drops the
documents that are finished. A very long document takes several places in the
state vector, divided where both tokenisations end.

Corpus counts of linked pairs do not move documents: a block writes its
documents' pairs as numbers into a list of its distinct pairs, only that list is
shuffled, and the counts come back to the block.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetpulse.llm import chunks
from fleetpulse.llm.common import Batches, map_batches, offsets, sha256_hex, texts_of
from fleetpulse.operators.lookup import lookup_join
from fleetpulse.sinks.tables import materialize

BLANK = "▁"  # Fixed value: the sign that stands for a space.
NORMAL, USER_DEFINED, UNUSED, BYTE = 1, 4, 5, 6  # Fixed values: piece types of the model format.
BPE = 2  # Fixed value: the model format's number for byte-pair encoding.
BLOCK_BYTES = 4 << 20
LANE_TOKENS = 4_096
LANE_SEARCH = 512
TABLE_CHUNKS, TABLE_TOKENS = 400_000, 4_000_000
MAX_BROADCAST = 8 << 20


class ByteLevelTokens:
    """Tokeniser A: a byte-level vocabulary; special strings in texts are plain text."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        with open(path, encoding="utf-8") as file:
            self.cuts = chunks.style_of(file.read()) == "leading"
        letters = {letter: byte for byte, letter in chunks.BYTE_LETTERS.items()}
        special = {i: t.content for i, t in self.library.get_added_tokens_decoder().items()}
        self.bytes: list[bytes] = []
        for i in range(self.library.get_vocab_size()):
            token = self.library.id_to_token(i) or ""
            self.bytes.append(token.encode() if i in special else bytes(letters[c] for c in token))

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.library.encode_batch_fast(texts, add_special_tokens=False)] if texts else []


class PieceTokens:
    """Tokeniser B: a piece model, which puts a blank before each text."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        with open(path, "rb") as file:
            model = sentencepiece_model_pb2.ModelProto.FromString(file.read())
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = [self._bytes(p) for p in model.pieces]
        self.blank = self.library.piece_to_id(BLANK)
        self.cuts = self._cuts(model)

    @staticmethod
    def _bytes(piece) -> bytes:
        if piece.type == BYTE:
            return bytes([int(piece.piece[3:-1], 16)])
        return piece.piece.replace(BLANK, " ").encode()

    def _cuts(self, model) -> bool:
        """Whether no merge can cross the place before a run of white space that starts with a blank, tab or line feed."""
        norm = model.normalizer_spec
        plain = norm.add_dummy_prefix and norm.escape_whitespaces and not (norm.precompiled_charsmap or norm.remove_extra_whitespaces)
        rows = [p.piece for p in model.pieces if p.type in (NORMAL, USER_DEFINED)]
        apart = all(BLANK not in p.lstrip(BLANK) and not any(c in p for c in "\t\n") for p in rows)
        kinds = not any(p.type in (USER_DEFINED, UNUSED) for p in model.pieces)
        blank = self.library.id_to_piece(self.blank) == BLANK
        bpe = model.trainer_spec.model_type == BPE and not model.trainer_spec.treat_whitespace_as_suffix
        return plain and apart and kinds and blank and bpe

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Texts that start with the blank that the model puts there itself."""
        return self.library.encode([t[1:] for t in texts], num_threads=1) if texts else []

    def encode_chunks(self, found: list[str]) -> list[list[int]]:
        """Chunks that start with white space; before other signs than a blank the model's own blank is dropped."""
        ids = self.library.encode([c[1:] if c[0] == " " else c for c in found], num_threads=1) if found else []
        return [[self.blank] if c == " " else i if c[0] == " " else i[1:] for c, i in zip(found, ids)]


class ChunkTable:
    """Both tokenisations of the chunks met so far, as numbers into flat arrays of bounded size."""

    def __init__(self, first: ByteLevelTokens, second: PieceTokens):
        self.first, self.second = first, second
        self.cuts = first.cuts and second.cuts
        self.clear()

    def clear(self) -> None:
        self.numbers: dict[str, int] = {}
        self.same = np.zeros(0, bool)
        self.ids = [np.zeros(0, np.int32)] * 2
        self.lengths = [np.zeros(0, np.int64)] * 2

    def cut(self, text: str) -> list[str]:
        """Chunks of a blank and the text; one chunk where cuts are not known to be safe.

        Pieces may end in a carriage return, so there is no cut before one.
        """
        if not self.cuts:
            return [" " + text]
        found = chunks.cut(" " + text, "leading")
        if "\r" not in text:
            return found
        joined = found[:1]
        for chunk in found[1:]:
            if chunk[0] == "\r":
                joined[-1] += chunk
            else:
                joined.append(chunk)
        return joined

    def add(self, found: list[str]) -> None:
        for n, chunk in enumerate(found, len(self.numbers)):
            self.numbers[chunk] = n
        second = self.second.encode_chunks(found) if self.cuts else self.second.encode(found)
        encoded = [self.first.encode(found), second]
        same = []
        for chunk, a, b in zip(found, *encoded):
            source = chunk.encode()
            same.append(b"".join(map(self.first.bytes.__getitem__, a)) == source == b"".join(map(self.second.bytes.__getitem__, b)))
        self.same = np.concatenate([self.same, np.asarray(same, bool)])
        for side, lists in enumerate(encoded):
            sizes = np.fromiter(map(len, lists), np.int64, len(lists))
            flat = np.fromiter((i for own in lists for i in own), np.int32, int(sizes.sum()))
            self.ids[side] = np.concatenate([self.ids[side], flat])
            self.lengths[side] = np.concatenate([self.lengths[side], sizes])

    def trim(self) -> None:
        if len(self.numbers) > TABLE_CHUNKS or sum(map(len, self.ids)) > TABLE_TOKENS:
            self.clear()

    def tokens(self, texts: list[str]) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
        """Which texts have tokens, and for A and B the flat ids of all texts with the texts' offsets."""
        self.trim()
        cut = [self.cut(t) if t else [] for t in texts]
        new = set().union(*cut).difference(self.numbers) if cut else set()
        self.add(list(new))
        sizes = np.fromiter(map(len, cut), np.int64, len(cut))
        places = np.fromiter((self.numbers[c] for own in cut for c in own), np.int64, int(sizes.sum()))
        bounds = offsets(sizes)
        equal = offsets(self.same[places].astype(np.int64))
        good = (sizes > 0) & (np.diff(equal[bounds]) == sizes)
        # A text whose bytes differ anywhere differs as a whole: chunks are joined in order.
        places = places[np.repeat(good, sizes)]
        bounds = offsets(np.where(good, sizes, 0))
        return good, [self._flat(side, places, bounds) for side in (0, 1)]

    def _flat(self, side: int, places: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        starts, lengths = offsets(self.lengths[side])[places], self.lengths[side][places]
        total = offsets(lengths)
        picked = np.arange(total[-1]) + np.repeat(starts - total[:-1], lengths)
        return self.ids[side][picked], total[bounds]


@dataclass
class Alignment:
    """Links and cuts of a block's documents; positions count through the whole block."""

    ids: list[np.ndarray]  # of A and of B
    bounds: list[np.ndarray]  # of the documents in them
    links: list[np.ndarray]  # positions in A and in B
    cuts: list[np.ndarray]  # positions behind the last token of each group, in order


def _lanes(ends: list[np.ndarray], bounds: list[np.ndarray]) -> list[np.ndarray]:
    """First and end positions of the lanes in A and B: documents, long ones divided where both tokenisations end."""
    starts, stops = [b[:-1] for b in bounds], [b[1:] for b in bounds]
    more: list[tuple[int, int, int, int]] = []
    stops = [s.copy() for s in stops]
    for doc in np.flatnonzero(stops[0] - starts[0] > LANE_TOKENS):
        last = (int(bounds[0][doc + 1]), int(bounds[1][doc + 1]))
        marks = [(int(starts[0][doc]), int(starts[1][doc]))]
        for at in range(marks[0][0] + LANE_TOKENS, last[0], LANE_TOKENS):
            window = ends[0][at : min(at + LANE_SEARCH, last[0] - 1)]
            low = marks[-1][1] + int(np.searchsorted(ends[1][marks[-1][1] : last[1]], window[0])) if len(window) else last[1]
            common, x, y = np.intersect1d(window, ends[1][low : min(low + LANE_SEARCH, last[1])], return_indices=True)
            if len(common):
                marks.append((at + int(x[0]) + 1, low + int(y[0]) + 1))
        if len(marks) > 1:
            stops[0][doc], stops[1][doc] = marks[1]
            more += [(*here, *there) for here, there in zip(marks[1:], [*marks[2:], last])]
    extra = np.asarray(more, np.int64).reshape(-1, 4).T
    return [np.concatenate(pair) for pair in zip([*starts, *stops], extra)]


def lockstep(ids: list[np.ndarray], bounds: list[np.ndarray], widths: list[np.ndarray]) -> Alignment:
    """Merges the two token sequences of all documents at once."""
    ends = [np.cumsum(w[i]) for w, i in zip(widths, ids)]
    at_a, at_b, stop_a, _ = _lanes(ends, bounds)
    # Both sequences of a lane have the same bytes, so they finish together.
    state = np.stack([at_a, at_b, stop_a])
    state = state[:, state[0] < state[2]]
    links: list[np.ndarray] = []
    cuts: list[np.ndarray] = []
    while state.shape[1]:
        end_a, end_b = ends[0][state[0]], ends[1][state[1]]
        links.append(state[:2].astype(np.int32))
        state[0] += end_a <= end_b
        state[1] += end_b <= end_a
        together = end_a == end_b
        if together.any():
            cuts.append(state[:2, together].astype(np.int32))
            alive = state[0] < state[2]
            if not alive.all():
                state = state[:, alive]
    none = np.zeros((2, 0), np.int32)
    linked, cut = np.concatenate([none, *links], axis=1), np.concatenate([none, *cuts], axis=1)
    return Alignment(ids, bounds, list(linked), list(cut[:, np.argsort(cut[0], kind="stable")]))


class BlockAligner:
    """Aligns the texts of one block after the other."""

    def __init__(self, first: str, second: str):
        self.sides = ByteLevelTokens(first), PieceTokens(second)
        self.table = ChunkTable(*self.sides)
        self.widths = [np.asarray([len(b) for b in side.bytes], np.int64) for side in self.sides]
        self.span = [len(side.bytes) for side in self.sides]
        # Decimal ids with the sign behind them: within a side, before the other side, behind a group.
        most = max(self.span)
        self.spelled = [f"{i}{sign}" for sign in ",|;" for i in range(most)]
        self.most = most

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, Alignment]:
        good, sides = self.table.tokens(texts)
        return good, lockstep([ids for ids, _ in sides], [bounds for _, bounds in sides], self.widths)

    def spellings(self, found: Alignment) -> list[str]:
        """``a1,a2|b1;a3|b2,b3`` for every document: decimal ids, groups in order."""
        counts = [np.diff(np.concatenate([[0], c])) for c in found.cuts]
        before = [offsets(c)[:-1] for c in counts]
        spelled = np.empty(len(found.ids[0]) + len(found.ids[1]), np.int64)
        for side, other in ((0, before[1]), (1, found.cuts[0].astype(np.int64))):
            places = np.arange(len(found.ids[side])) + np.repeat(other, counts[side])
            signs = np.zeros(len(found.ids[side]), np.int64)
            signs[found.cuts[side] - 1] = side + 1
            spelled[places] = found.ids[side] + signs * self.most
        bounds = found.bounds[0] + found.bounds[1]
        pieces = list(map(self.spelled.__getitem__, spelled.tolist()))
        return ["".join(pieces[a:b])[:-1] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]

    def pairs(self, found: Alignment) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Document, pair number and occurrences of the distinct linked id pairs of each document, by document."""
        code = found.ids[0][found.links[0]].astype(np.int64) * self.span[1] + found.ids[1][found.links[1]]
        doc = np.searchsorted(found.bounds[0], found.links[0], side="right") - 1
        all_pairs = self.span[0] * self.span[1]
        distinct, times = np.unique(doc * all_pairs + code, return_counts=True)
        return distinct // all_pairs, distinct % all_pairs, times


@lru_cache(maxsize=1)
def worker_aligner(first: str, second: str) -> BlockAligner:
    return BlockAligner(first, second)


def _blocks(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Spans of texts of bounded size in all; a larger text is a block of its own."""
    low = size = 0
    for n, text in enumerate(texts):
        if n > low and size + len(text) > BLOCK_BYTES:
            yield low, n
            low, size = n, 0
        size += len(text)
    if texts:
        yield low, len(texts)


def _keyed(documents: DataFrame, key: str) -> DataFrame:
    return documents.select(F.col(key).cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))


def alignments(documents: DataFrame, first: str, second: str, key: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, a_ids, b_ids, a_cuts, b_cuts, a_links, b_links.

    A group ends before position a_cuts[g] of a_ids and b_cuts[g] of b_ids; link
    k joins token a_links[k] and token b_links[k]. A text that is null or empty,
    or whose tokens' bytes differ from a blank and the text, has empty lists.
    Null and repeated keys keep their rows; other columns are not read. No shuffle.
    """
    names = ("a_ids", "b_ids", "a_cuts", "b_cuts", "a_links", "b_links")
    types = pa.schema([("doc_id", pa.int64())] + [(n, pa.list_(pa.int32())) for n in names])

    def run(batches: Batches) -> Batches:
        aligner = worker_aligner(first, second)
        for batch in batches:
            texts, keys = texts_of(batch), batch.column("doc_id")
            for low, high in _blocks(texts):
                _, found = aligner(texts[low:high])
                order = np.lexsort((found.links[1], found.links[0]))
                lists = [found.ids, found.cuts, [side[order] for side in found.links]]
                columns = [keys.slice(low, high - low)]
                for kind, pair in enumerate(lists):
                    for side, values in enumerate(pair):
                        bounds = found.bounds[side]
                        if kind:  # positions become those within the document
                            lead = found.bounds[0]
                            of = np.searchsorted(lead, pair[0] - (kind == 1), side="right") - 1
                            values = values - bounds[of]
                            bounds = offsets(np.bincount(of, minlength=len(bounds) - 1))
                        columns.append(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values, pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, schema=types)

    return map_batches(_keyed(documents, key), run, "doc_id bigint, " + ", ".join(f"{n} array<int>" for n in names))


_DOCUMENTS = ("n_a", "n_b", "n_groups", "n_links")


def aligned_blocks(documents: DataFrame, first: str, second: str, key: str = "doc_id") -> DataFrame:
    """Blocks of aligned documents, written.

    Per document its id, counts and digest, the number of its distinct linked
    pairs (``held``), and for each of those its place among the block's distinct
    ``pairs`` (``which``) and its occurrences (``times``), as packed numbers.
    ``docs`` counts the block's documents that hold each pair.
    """
    lists = ["doc_id", *_DOCUMENTS, "held", "pairs", "docs"]
    types = pa.schema(
        [("block", pa.int64()), *[(n, pa.list_(pa.int64())) for n in lists], ("digests", pa.list_(pa.string())),
         ("which", pa.binary()), ("times", pa.binary())]
    )
    schema = "block bigint, " + ", ".join(f"{n} array<bigint>" for n in lists) + ", digests array<string>, which binary, times binary"

    def run(batches: Batches) -> Batches:
        aligner = worker_aligner(first, second)
        block = TaskContext.get().partitionId() << 33
        for batch in batches:
            texts, keys = texts_of(batch), batch.column("doc_id").to_pylist()
            for low, high in _blocks(texts):
                good, found = aligner(texts[low:high])
                doc, code, times = aligner.pairs(found)
                pairs, which, docs = np.unique(code, return_inverse=True, return_counts=True)
                groups = np.searchsorted(found.bounds[0], found.cuts[0] - 1, side="right") - 1
                links = np.searchsorted(found.bounds[0], found.links[0], side="right") - 1
                row = {
                    "block": block,
                    "doc_id": keys[low:high],
                    "n_a": np.diff(found.bounds[0]),
                    "n_b": np.diff(found.bounds[1]),
                    "n_groups": np.bincount(groups, minlength=high - low),
                    "n_links": np.bincount(links, minlength=high - low),
                    "held": np.bincount(doc, minlength=high - low),
                    "pairs": pairs,
                    "docs": docs,
                    "digests": [sha256_hex(s) if g else "" for s, g in zip(aligner.spellings(found), good.tolist())],
                    "which": _narrow(which),
                    "times": _narrow(times),
                }
                yield pa.RecordBatch.from_arrays([pa.array([row[n]], types.field(n).type) for n in types.names], schema=types)
                block += 1

    return materialize(map_batches(_keyed(documents, key), run, schema), "aligned")


def _narrow(numbers: np.ndarray) -> bytes:
    """Non-negative numbers in the fewest whole bytes that hold the largest."""
    return numbers.astype(np.min_scalar_type(int(numbers.max(initial=0)))).tobytes()


def _wide(data: bytes, count: int) -> np.ndarray:
    return np.frombuffer(data, f"<u{len(data) // count}").astype(np.int64) if count else np.zeros(0, np.int64)


def pair_counts(posted: DataFrame, second_size: int) -> DataFrame:
    """``pair, total, best``: documents that hold a pair, and whether no pair of its A id is held by more.

    Written; at most as many rows as the vocabularies have pairs.
    """
    totals = materialize(posted.groupBy("pair").agg(F.sum("docs").alias("total")), "pair-totals")
    a_id = F.expr(f"pair div {second_size}L")
    most = totals.groupBy(a_id.alias("a_id")).agg(F.max("total").alias("most"))  # a row for each A id: bounded by the vocabulary
    joined = totals.withColumn("a_id", a_id).join(F.broadcast(most), "a_id")
    return materialize(joined.select("pair", "total", (F.col("total") == F.col("most")).alias("best")), "pair-counts")


def report(documents: DataFrame, first: str, second: str, key: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    A link's count is the number of documents that hold its id pair linked; rows
    with one id, or none, are documents of their own. n_best counts the links
    whose count is the highest of their A id. Texts without tokens (see
    ``alignments``) have zeros and an empty digest. Other columns are not read.
    """
    blocks = aligned_blocks(documents, first, second, key)
    posted = blocks.select("block", F.explode(F.arrays_zip("pairs", "docs")).alias("p")).select("block", F.col("p.pairs").alias("pair"), F.col("p.docs").alias("docs"))
    counts = pair_counts(posted, _piece_count(second))
    back = lookup_join(posted.select("block", "pair"), counts, "pair", "block", max_broadcast_bytes=MAX_BROADCAST)
    names = [*_DOCUMENTS, "n_best", "count_sum"]
    types = pa.schema([("doc_id", pa.int64()), *[(n, pa.int64()) for n in names], ("groups_sha256", pa.string())])

    def finish(block: pa.Table, known: pa.Table) -> pa.Table:
        known = known.sort_by("pair")
        total, best = (known.column(c).to_numpy().astype(np.int64) for c in ("total", "best"))
        row = block.to_pylist()[0]
        held = offsets(np.asarray(row["held"], np.int64))
        which, times = _wide(row["which"], held[-1]), _wide(row["times"], held[-1])
        sums = {n: np.diff(offsets(times * value[which])[held]) for n, value in (("n_best", best), ("count_sum", total))}
        columns = [row["doc_id"], *[row[n] for n in _DOCUMENTS], *sums.values(), row["digests"]]
        return pa.table([pa.array(c, t.type) for c, t in zip(columns, types)], schema=types)

    kept = blocks.select("block", "doc_id", *_DOCUMENTS, "held", "digests", "which", "times")
    schema = "doc_id bigint, " + ", ".join(f"{n} bigint" for n in names) + ", groups_sha256 string"
    known = back.withColumnRenamed("block", "of_block").groupBy("of_block")
    return kept.groupBy("block").cogroup(known).applyInArrow(finish, schema)


def _piece_count(path: str) -> int:
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=path).get_piece_size()
