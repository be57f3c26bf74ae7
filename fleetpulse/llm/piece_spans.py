"""SentencePiece encoding that keeps the source bytes of every piece.

The text is normalised as the model says: at each place the longest prefix that
the compiled character map lists is replaced, any other character stays. Each
normalised byte remembers the source bytes it came from. The library encodes
the text; the pieces' lengths, laid end to end over the normalised bytes, then
give every piece its span of source bytes.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetpulse.llm.common import STAGE_BYTES, Batches, map_batches, sha256_hex, take_over, texts_of

BLANK = "▁".encode()  # Fixed value: the sign that stands for a space.
NORMAL, BYTE = 1, 6  # Fixed values: piece types of the model format.
TEXTS_AT_ONCE = 200


class CharacterMap:
    """Longest-prefix look-up in a compiled character map.

    The map is a double array of 32-bit units, its size in bytes before it, and
    after it the replacements, each ended by a zero byte.
    """

    def __init__(self, compiled: bytes):
        size = int.from_bytes(compiled[:4], "little")
        self.units = np.frombuffer(compiled, "<u4", size // 4, 4).tolist() if compiled else []
        self.texts = compiled[4 + size :]

    def longest(self, source: bytes, at: int) -> tuple[int, bytes] | None:
        """Length of the longest listed prefix of ``source[at:]`` and its replacement."""
        if not self.units:
            return None
        found = None
        node = self._children(self.units[0])
        for place in range(at, len(source)):  # ends where the map has no longer key
            byte = source[place]
            unit = self.units[node ^ byte]
            if unit & 0x800000FF != byte:
                break
            node = (node ^ byte) ^ self._children(unit)
            if unit >> 8 & 1:
                found = (place + 1 - at, self.units[node] & 0x7FFFFFFF)
        if found is None:
            return None
        return found[0], self.texts[found[1] : self.texts.index(b"\0", found[1])]

    @staticmethod
    def _children(unit: int) -> int:
        return unit >> 10 << (unit >> 9 & 1) * 8


class Normalizer:
    """Normalised bytes with the source span of each."""

    def __init__(self, spec, suffix_blank: bool = False):
        self.map = CharacterMap(spec.precompiled_charsmap)
        self.prefix, self.squeeze, self.escape = spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces
        if suffix_blank:
            raise ValueError("models with blanks behind words are not supported")

    def __call__(self, source: bytes) -> tuple[bytes, np.ndarray, np.ndarray]:
        if not self.map.units and not self.squeeze:
            return self._plain(source)
        return self._mapped(source)

    def _plain(self, source: bytes) -> tuple[bytes, np.ndarray, np.ndarray]:
        """No map: only spaces change."""
        blank = BLANK if self.escape else b" "
        data = source.replace(b" ", blank)
        wide = np.where(np.frombuffer(source, np.uint8) == 0x20, len(blank), 1)
        begins = np.repeat(np.arange(len(source)), wide)
        ends = begins + 1
        if self.prefix and source:
            data, none = blank + data, np.zeros(len(blank), np.int64)
            begins, ends = np.concatenate([none, begins]), np.concatenate([none, ends])
        return data, begins, ends

    def _mapped(self, source: bytes) -> tuple[bytes, np.ndarray, np.ndarray]:
        parts: list[tuple[bytes, int, int]] = []  # replacement, source span
        at = 0
        while at < len(source):
            hit = self.map.longest(source, at)
            length, text = hit or (self._char(source, at), None)
            parts.append((source[at : at + length] if text is None else text, at, at + length))
            at += length
        if self.squeeze:
            parts = self._squeezed(parts)
        blank = BLANK if self.escape else b" "
        data, begins, ends = bytearray(), [], []
        if self.prefix and parts:
            data += blank
            begins += [parts[0][1]] * len(blank)
            ends += [parts[0][1]] * len(blank)
        for text, low, high in parts:
            same = high - low == len(text) and source[low:high] == text
            for i, byte in enumerate(text):
                one = blank if byte == 0x20 else bytes([byte])
                data += one
                begins += [low + i if same else low] * len(one)
                ends += [low + i + 1 if same else high] * len(one)
        return bytes(data), np.asarray(begins, np.int64), np.asarray(ends, np.int64)

    @staticmethod
    def _char(source: bytes, at: int) -> int:
        first = source[at]
        return 1 if first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4

    @staticmethod
    def _squeezed(parts: list[tuple[bytes, int, int]]) -> list[tuple[bytes, int, int]]:
        """Without spaces at the ends and behind other spaces."""
        out: list[tuple[bytes, int, int]] = []
        after_space = True
        for text, low, high in parts:
            if after_space:
                text = text.lstrip(b" ")
            if text:
                out.append((text, low, high))
                after_space = text.endswith(b" ")
        while out and out[-1][0].endswith(b" "):
            text, low, high = out.pop()
            if text := text.rstrip(b" "):
                out.append((text, low, high))
        return out


class PieceEncoder:
    """Ids of the library with the source span of each piece."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        with open(path, "rb") as file:
            model = sentencepiece_model_pb2.ModelProto.FromString(file.read())
        if not model.trainer_spec.byte_fallback or any(p.type == 4 for p in model.pieces):
            raise ValueError("the model must have byte pieces and no user-defined symbols")
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.normalize = Normalizer(model.normalizer_spec, model.trainer_spec.treat_whitespace_as_suffix)
        self.widths = np.asarray([1 if p.type == BYTE else len(p.piece.encode()) for p in model.pieces], np.int64)

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.library.encode(texts, num_threads=1) if texts else []

    def decode(self, ids: list[list[int]]) -> list[str]:
        return [self.library.decode(i) for i in ids]

    def spans(self, text: str, ids: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """First and end source byte of every piece."""
        data, begins, ends = self.normalize(text.encode())
        stops = np.cumsum(self.widths[np.asarray(ids, np.int64)]) if ids else np.zeros(0, np.int64)
        if (int(stops[-1]) if ids else 0) != len(data):
            raise ValueError("the pieces do not cover the normalised text")
        if not ids:
            return stops, stops
        starts = np.concatenate([[0], stops[:-1]])
        return begins[starts], ends[stops - 1]


@lru_cache(maxsize=2)
def worker_encoder(path: str) -> PieceEncoder:
    return PieceEncoder(path)


def _pairs(documents: DataFrame, key: str) -> DataFrame:
    return documents.select(F.col(key).cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))


def encode_spans(documents: DataFrame, model: str, key: str = "doc_id", decoded: bool = False) -> DataFrame:
    """One row per document: doc_id, ids, starts, ends (source bytes of each piece).

    With ``decoded`` also the text that the ids give back. A null or empty text
    has no pieces. Null and repeated keys keep their rows; other columns are not
    read. No shuffle.
    """
    types = pa.schema([("doc_id", pa.int64())] + [(n, pa.list_(pa.int32())) for n in ("ids", "starts", "ends")])
    schema = "doc_id bigint, ids array<int>, starts array<int>, ends array<int>"
    if decoded:
        types, schema = types.append(pa.field("decoded", pa.string())), schema + ", decoded string"

    def run(batches: Batches) -> Batches:
        take_over("pieces", worker_encoder.cache_clear)
        encoder = worker_encoder(model)
        for batch in batches:
            texts, keys = texts_of(batch), batch.column("doc_id")
            for low in range(0, len(texts), TEXTS_AT_ONCE):
                part = texts[low : low + TEXTS_AT_ONCE]
                ids = encoder.encode(part)
                spans = [encoder.spans(t, i) for t, i in zip(part, ids)]
                columns = [pa.array(x, pa.list_(pa.int32())) for x in (ids, [s for s, _ in spans], [e for _, e in spans])]
                columns += [pa.array(encoder.decode(ids), pa.string())] if decoded else []
                yield pa.RecordBatch.from_arrays([keys.slice(low, len(part)), *columns], schema=types)

    return map_batches(_pairs(documents, key), run, schema, STAGE_BYTES, TEXTS_AT_ONCE)


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """``doc_id`` and ``ids`` back to doc_id and text; null ids give an empty text."""
    types = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])

    def run(batches: Batches) -> Batches:
        encoder = worker_encoder(model)
        for batch in batches:
            texts = encoder.decode([i or [] for i in batch.column("ids").to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], schema=types)

    return map_batches(encoded.select("doc_id", "ids"), run, "doc_id bigint, text string")


def round_trip(documents: DataFrame, model: str, key: str = "doc_id") -> DataFrame:
    """Digests of encoding and decoding, one row per document, as the ids are made.

    doc_id, n_tokens, ids_sha256, decoded_sha256, n_bytes (of the source) and
    span_bytes (source bytes that pieces cover). Rows as in ``encode_spans``.
    """
    names = ("n_tokens", "n_bytes", "span_bytes")
    types = pa.schema([("doc_id", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])
    for name in names:
        types = types.append(pa.field(name, pa.int64()))

    def run(batches: Batches) -> Batches:
        encoder = worker_encoder(model)
        for batch in batches:
            texts, keys = texts_of(batch), batch.column("doc_id").to_pylist()
            out: dict[str, list] = {n: [] for n in types.names}
            for low in range(0, len(texts), TEXTS_AT_ONCE):
                part = texts[low : low + TEXTS_AT_ONCE]
                ids = encoder.encode(part)
                for text, own, decoded in zip(part, ids, encoder.decode(ids)):
                    starts, ends = encoder.spans(text, own)
                    out["ids_sha256"].append(sha256_hex(",".join(map(str, own))))
                    out["decoded_sha256"].append(sha256_hex(decoded))
                    out["n_tokens"].append(len(own))
                    out["n_bytes"].append(len(text.encode()))
                    out["span_bytes"].append(int((ends - starts).sum()))
            out["doc_id"] = keys
            yield pa.RecordBatch.from_pydict(out, schema=types)

    schema = "doc_id bigint, ids_sha256 string, decoded_sha256 string, " + ", ".join(f"{n} bigint" for n in names)
    return map_batches(_pairs(documents, key), run, schema).select(
        "doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "n_bytes", "span_bytes"
    )
