"""Token ids as flat binary files with 64-bit document offsets.

A table of documents becomes a folder of parts in ascending ``doc_id`` order:
``part-NNNNN-NNNNN.bin`` (task and part of the task) holds the ids of its
documents one after the other as unsigned little-endian integers, the ``.idx``
file of the same name holds 64-bit integers: the
number of documents, their offsets in the part (one more than documents), their
ids and a mark for ids that are null. ``manifest.json`` lists the parts with
their first token and document, which are prefix sums of the parts' counts.
Readers map both files into memory.
"""

from __future__ import annotations

import json
import os
import zlib
from array import array
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetpulse.llm import chunks
from fleetpulse.llm.common import Batches, Memo, make_folder, map_batches, offsets, one_per_task, publish, shared_files, texts_of

CACHED = 1_000_000
PART_BYTES = 128 << 20
PARTS_SCHEMA = "part string, n_docs bigint, n_tokens bigint"


@dataclass(frozen=True)
class TokenFolder:
    """A written folder: its place, id width, end id and parts with their bases."""

    uri: str
    dtype: str
    parts: tuple[tuple[str, int, int, int, int], ...]  # name, documents, tokens, first document, first token


class TextEncoder:
    """Ids of whole texts as the tokenizers library gives them.

    A text of settled characters is lowered and cut into pre-tokens; those seen
    before come from a bounded cache and the library's model encodes new ones.
    Chunks of any other text go through the whole library, with a cache too.
    """

    def __init__(self, path: str, dtype: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            text = file.read()
        self.tokenizer = Tokenizer.from_str(text)
        self.style = chunks.style_of(text)
        self.pre_tokens = chunks.lowered_pre_tokens(text) if self.style == "dropped" else None
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.code = {"<u2": "H", "<u4": "I"}[dtype]
        self.chunks, self.words = Memo(CACHED), Memo(CACHED)

    def __call__(self, text: str) -> bytes:
        self.chunks.trim()
        self.words.trim()
        if self.pre_tokens and chunks.SETTLED.fullmatch(text) and not any(s in text for s in self.special):
            low = text.lower()
            if chunks.is_plain(low):
                words = low.replace(",", " , ").replace(".", " . ").split()
            else:
                words = self.pre_tokens(low)
            found = list(map(self.words.get, words))
            if None in found:
                found = [self._word(w) if i is None else i for w, i in zip(words, found)]
            return b"".join(found)
        cuts = chunks.cut(text, self.style)
        found = list(map(self.chunks.get, cuts))
        if None in found:
            found = [self._chunk(c) if i is None else i for c, i in zip(cuts, found)]
        return b"".join(found)

    def _word(self, word: str) -> bytes:
        """Ids of a lowered pre-token."""
        ids = self.words.get(word)
        if ids is None:
            ids = self.words.recall(word)
        if ids is None:
            spelled = word.encode().decode("latin-1").translate(chunks.BYTE_LETTERS)
            ids = array(self.code, [t.id for t in self.tokenizer.model.tokenize(spelled)]).tobytes()
            self.words.keep(word, ids)
        return ids

    def _chunk(self, chunk: str) -> bytes:
        ids = self.chunks.get(chunk)
        if ids is None:
            ids = self.chunks.recall(chunk)
        if ids is None:
            ids = array(self.code, self.tokenizer.encode(chunk, add_special_tokens=False).ids).tobytes()
            self.chunks.keep(chunk, ids)
        return ids


@lru_cache(maxsize=2)
def worker_encoder(path: str, dtype: str) -> TextEncoder:
    """One encoder a worker process, so its caches outlive a task."""
    return TextEncoder(path, dtype)


def id_type(largest: int) -> str:
    """The narrowest unsigned type that holds every id."""
    return "<u2" if largest < 1 << 16 else "<u4"


def write_tokens(
    documents: DataFrame,
    uri: str,
    tokenizer: str,
    end_id: int | None = None,
    parts: int | None = None,
    key: str = "doc_id",
    part_bytes: int = PART_BYTES,
) -> TokenFolder:
    """Encodes ``key`` and ``text`` of every document and writes the folder at ``uri``.

    A null or empty text has only the end id, a null key sorts first and equal
    keys by their texts' hash; a repeated row is written as often as it occurs.
    Other columns are not read, whatever their names. An empty table gives a
    folder without parts. Rows are dealt by range; a spread of the row number
    splits keys that many rows share. A task goes on to a new part after the
    batch that fills one with ``part_bytes`` of ids, so a part is bounded whatever
    the table's size. It holds the current batch, and of a part's documents the
    keys and lengths, 24 bytes each.
    """
    from tokenizers import Tokenizer

    spark = documents.sparkSession
    largest = max(Tokenizer.from_file(tokenizer).get_vocab(with_added_tokens=True).values())
    dtype = id_type(max(largest, end_id or 0))
    tail = b"" if end_id is None else np.asarray([end_id], dtype).tobytes()
    count = parts or max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = documents.select(F.col(key).cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    order = ("doc_id", F.xxhash64("text"), F.xxhash64(F.monotonically_increasing_id()))
    rows = rows.repartitionByRange(count, *order).sortWithinPartitions(*order)

    types = pa.schema([("part", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())])

    def write(batches: Batches) -> Batches:
        encode = worker_encoder(tokenizer, dtype)
        batch = next(batches, None)
        piece = 0
        while batch is not None:
            name = f"part-{TaskContext.get().partitionId():05d}-{piece:05d}"
            keys, marks, lengths = array("q"), array("q"), array("q")

            def stream(out: pa.NativeFile) -> None:
                nonlocal batch
                size = 0
                while batch is not None and size < part_bytes:
                    ids = batch.column("doc_id")
                    keys.extend(ids.fill_null(0).to_pylist())
                    marks.extend(map(int, ids.is_null().to_pylist()))
                    for tokens in map(encode, texts_of(batch)):
                        size += out.write(tokens + tail)
                        lengths.append((len(tokens) + len(tail)) // np.dtype(dtype).itemsize)
                    batch = next(batches, None)

            publish(f"{uri}/{name}.bin", stream)
            ends = offsets(np.asarray(lengths, np.int64))
            index = (np.asarray([len(keys)]), ends, np.asarray(keys, np.int64), np.asarray(marks, np.int64))
            publish(f"{uri}/{name}.idx", lambda out: [out.write(x.astype("<i8").tobytes()) for x in index])
            yield pa.RecordBatch.from_pydict({"part": [name], "n_docs": [len(keys)], "n_tokens": [int(ends[-1])]}, schema=types)
            piece += 1

    make_folder(uri)
    counts = sorted(tuple(r) for r in map_batches(rows, write, PARTS_SCHEMA).filter("n_docs > 0").collect())
    docs, tokens = (offsets(np.asarray([c[i] for c in counts], np.int64)).tolist() for i in (1, 2))
    listed = tuple((*c, docs[i], tokens[i]) for i, c in enumerate(counts))
    manifest = {"dtype": dtype, "parts": [dict(zip(("part", "n_docs", "n_tokens", "first_doc", "first_token"), p)) for p in listed]}
    publish(f"{uri}/manifest.json", lambda out: out.write(json.dumps(manifest).encode()))
    return TokenFolder(uri, dtype, listed)


def open_folder(uri: str) -> TokenFolder:
    """A folder by its manifest."""
    files, path = shared_files(uri)
    with files.open_input_stream(f"{path}/manifest.json") as file:
        manifest = json.loads(file.read())
    return TokenFolder(uri, manifest["dtype"], tuple(tuple(p.values()) for p in manifest["parts"]))


def mapped(uri: str, dtype: str) -> np.ndarray:
    """A file's integers; mapped into memory where the file system is a local mount."""
    files, path = shared_files(uri)
    if hasattr(files, "root_path") or files.type_name == "local":
        return np.memmap(path, dtype, "r") if os.path.getsize(path) else np.zeros(0, dtype)
    with files.open_input_file(path) as file:
        return np.frombuffer(file.read(), dtype)


def document_tokens(folder: TokenFolder, at: int) -> tuple[int | None, int, np.ndarray]:
    """Id, start and token ids of the document at a position of the whole folder."""
    name, n, _, first, base = next(p for p in folder.parts if p[3] <= at < p[3] + p[1])
    index = mapped(f"{folder.uri}/{name}.idx", "<i8")
    begin, end = index[1 + at - first], index[2 + at - first]
    key = None if index[2 + 2 * n + at - first] else int(index[2 + n + at - first])
    return key, int(base + begin), mapped(f"{folder.uri}/{name}.bin", folder.dtype)[begin:end]


def read_tokens(spark: SparkSession, folder: TokenFolder, with_ids: bool = False) -> DataFrame:
    """One row per document from the files: doc_id, start, n_tokens, ids_crc32 (and ids if asked for).

    The checksum is that of the ids as unsigned 32-bit little-endian integers.
    """
    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + (", ids array<bigint>" if with_ids else "")
    if not folder.parts:
        return spark.createDataFrame([], schema)
    types = pa.schema([(n, pa.int64()) for n in ("doc_id", "start", "n_tokens", "ids_crc32")])
    types = types.append(pa.field("ids", pa.list_(pa.int64()))) if with_ids else types
    uri, dtype = folder.uri, folder.dtype

    def read(batches: Batches) -> Batches:
        for batch in batches:
            for part in batch.to_pylist():
                n = part["n_docs"]
                index = mapped(f"{uri}/{part['part']}.idx", "<i8")
                tokens = mapped(f"{uri}/{part['part']}.bin", dtype)
                for low in range(0, n, 1_000):
                    high = min(low + 1_000, n)
                    own = [tokens[index[1 + d] : index[2 + d]] for d in range(low, high)]
                    columns = {
                        "doc_id": pa.array(index[2 + n + low : 2 + n + high], mask=index[2 + 2 * n + low : 2 + 2 * n + high] != 0),
                        "start": pa.array(index[1 + low : 1 + high] + part["first_token"]),
                        "n_tokens": pa.array(np.diff(index[1 + low : 2 + high])),
                        "ids_crc32": pa.array([zlib.crc32(ids.astype("<u4").tobytes()) for ids in own], pa.int64()),
                    }
                    if with_ids:
                        columns["ids"] = pa.array([ids.astype(np.int64) for ids in own], pa.list_(pa.int64()))
                    yield pa.RecordBatch.from_pydict(columns, schema=types)

    parts = one_per_task(spark, list(folder.parts), f"{PARTS_SCHEMA}, first_doc bigint, first_token bigint")
    return map_batches(parts, read, schema)
