"""Secrets in texts: known forms, and strings that a token vocabulary compresses badly."""

from __future__ import annotations

import base64
import re
from bisect import bisect_right
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetpulse.llm.common import STAGE_BYTES, Batches, Memo, map_batches, sha256_hex, take_over, texts_of
from fleetpulse.llm.token_counts import PRE_TOKENS

# The base forms, in the order in which they are listed.
BASE_KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ASSIGN_LENGTH, ACCESS_LENGTH, HEX_LENGTH = 8, 16, 32
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # runs are maximal, so the length may stand in the pattern
_ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

KINDS = (*BASE_KINDS, "random")
MIN_LENGTH = 16
MAX_CHARS_PER_TOKEN = 2.4
MAX_CHARS_PER_TOKEN_LETTERS = 1.8  # of a run without a digit, which may be words
_RUN = re.compile(rf"[A-Za-z0-9+/_=-]{{{MIN_LENGTH},}}")
# Lengths in characters of hexadecimal digests in use: MD5, SHA-1, SHA-224, SHA-256, SHA-384, SHA-512.
DIGEST_LENGTHS = (32, 40, 56, 64, 96, 128)
_DIGEST = re.compile("|".join(rf"[0-9a-f]{{{n}}}|[0-9A-F]{{{n}}}" for n in DIGEST_LENGTHS))
# Digests by name and bits, as hexadecimal or base64 of just that length behind the name.
DIGEST_BITS = {"md5": 128, "sha1": 160, "sha224": 224, "sha256": 256, "sha384": 384, "sha512": 512}
_BASE64 = {n: (-(-bits // 6), -(bits // 8) % 3) for n, bits in DIGEST_BITS.items()}  # characters, signs of padding
_LABELLED_DIGEST = re.compile(
    "|".join(f"{n}[-=_](?:[0-9A-Fa-f]{{{DIGEST_BITS[n] // 4}}}|[A-Za-z0-9+/]{{{size}}}={{0,{pad}}})" for n, (size, pad) in _BASE64.items())
)
_UUID = re.compile(r"[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}")
_PART = re.compile(r"[A-Za-z]+|[0-9]+")
_LETTER, _DIGIT = re.compile("[A-Za-z]"), re.compile("[0-9]")

Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    """The known forms, by start and then kind; a match that is too short is consumed but not kept."""
    spans: list[Span] = []
    low = text.lower()  # may differ in length; it only tells whether a word can be there
    if any(w in low for w in _ASSIGN_WORDS):
        spans += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LENGTH]
    if "AKIA" in text:
        spans += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LENGTH]
    spans += [("hex", *m.span()) for m in HEX.finditer(text)]
    return ordered(spans)


def ordered(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def is_known(run: str) -> bool:
    """A digest, a UUID, or numbers and signs."""
    if not _LETTER.search(run):
        return True
    return bool(_DIGEST.fullmatch(run) or _LABELLED_DIGEST.fullmatch(run) or _UUID.fullmatch(run))


def identifier_parts(run: str) -> list[str] | None:
    """The parts of an identifier with a number, each of one sort and joined by signs; None if the run is none."""
    parts = [p for p in re.split(r"[+/_=-]+", run) if p]
    return parts if _DIGIT.search(run) and all(_PART.fullmatch(p) for p in parts) else None


@lru_cache(maxsize=2)
def vocabulary(ranks_path: str):
    """Encoder of a rank file: a base64 token and its rank on each line."""
    import tiktoken

    with open(ranks_path, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    return tiktoken.Encoding("ranks", pat_str=PRE_TOKENS, mergeable_ranks=ranks, special_tokens={})


class SecretFinder:
    def __init__(self, ranks_path: str, max_chars_per_token: float = MAX_CHARS_PER_TOKEN):
        self.encoder = vocabulary(ranks_path)
        self.limit = max_chars_per_token
        self.verdicts = Memo(100_000)

    def spans(self, text: str) -> list[Span]:
        """All spans: the base ones, and random strings among the runs, or their parts, that lie outside them."""
        base = base_spans(text)
        taken = _merged(base)
        ends = [e for _, e in taken]
        found = list(base)
        for match in _RUN.finditer(text):
            for begin, end in _outside(*match.span(), taken, bisect_right(ends, match.start())):
                if end - begin >= MIN_LENGTH and self._random(text[begin:end]):
                    found.append(("random", begin, end))
        return ordered(found) if len(found) > len(base) else base

    def _random(self, run: str) -> bool:
        verdict = self.verdicts.get(run)
        if verdict is None:
            verdict = self.verdicts.recall(run)
        if verdict is None:
            verdict = not is_known(run) and self._compresses_badly(run)
            self.verdicts.trim()
            self.verdicts.keep(run, verdict)
        return verdict


    def _compresses_badly(self, run: str) -> bool:
        """An identifier does if one of its long letter parts does, any other run as a whole."""
        parts = identifier_parts(run)
        if parts is not None:
            return any(len(p) >= MIN_LENGTH and not p.isdigit() and self._compresses_badly(p) for p in parts)
        limit = self.limit if _DIGIT.search(run) else min(self.limit, MAX_CHARS_PER_TOKEN_LETTERS)
        return len(run) < limit * len(self.encoder.encode_ordinary(run))


def _merged(spans: list[Span]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for _, begin, end in sorted(spans, key=lambda s: s[1:]):
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((begin, end))
    return out


def _outside(begin: int, end: int, taken: list[tuple[int, int]], at: int) -> list[tuple[int, int]]:
    """The parts of a run between the taken stretches, of which the first that ends inside or behind it is number ``at``."""
    parts = []
    while at < len(taken) and taken[at][0] < end:
        parts.append((begin, taken[at][0]))
        begin = taken[at][1]
        at += 1
    return [*parts, (begin, end)]


def redact(text: str, spans: list[Span], mask: str) -> str:
    """The text with every stretch of secrets replaced by the mask."""
    out, at = [], 0
    for begin, end in _merged(spans):
        out += [text[at:begin], mask]
        at = end
    return "".join([*out, text[at:]])


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{begin}:{end}" for kind, begin, end in spans)


def scan(documents: DataFrame, ranks_path: str, key: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random.

    ``spans`` lists kind:start:end by start and kind; positions are code points,
    ends exclusive. A null or empty text has none. Null and repeated keys keep
    their rows; other columns are not read. No shuffle.
    """
    counts = ("n_assign", "n_access", "n_hex", "n_random")
    types = pa.schema([("doc_id", pa.int64()), ("base_sha256", pa.string()), ("spans", pa.string())])
    for name in counts:
        types = types.append(pa.field(name, pa.int64()))

    def run(batches: Batches) -> Batches:
        finder = SecretFinder(ranks_path)
        for batch in batches:
            found = [finder.spans(t) for t in texts_of(batch)]
            kinds = [[s[0] for s in spans] for spans in found]
            columns = {name: [k.count(name[2:]) for k in kinds] for name in counts}
            columns["doc_id"] = batch.column("doc_id").to_pylist()
            columns["base_sha256"] = [sha256_hex(_joined([s for s in spans if s[0] in BASE_KINDS])) for spans in found]
            columns["spans"] = [_joined(spans) for spans in found]
            yield pa.RecordBatch.from_pydict(columns, schema=types)

    rows = documents.select(F.col(key).cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id bigint, base_sha256 string, spans string, " + ", ".join(f"{n} bigint" for n in counts)
    return map_batches(rows, run, schema).select("doc_id", *counts[:3], "base_sha256", "spans", "n_random")


def without_secrets(documents: DataFrame, ranks_path: str, mask: str = "[SECRET]", text: str = "text") -> DataFrame:
    """The same rows and columns with every secret in ``text`` masked.

    ``n_chars``, if there is such a column, counts the new text. Null texts stay
    null, other columns pass unread whatever their names, no row is dropped.
    """
    named = list(documents.columns)

    def run(batches: Batches) -> Batches:
        take_over("secrets", vocabulary.cache_clear)
        finder = SecretFinder(ranks_path)
        for batch in batches:
            at = batch.schema.get_field_index(text)
            before = batch.column(at).to_pylist()
            after = [t if not t or not (s := finder.spans(t)) else redact(t, s, mask) for t in before]
            columns = batch.columns
            columns[at] = pa.array(after, batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    masked = map_batches(documents, run, documents.schema, STAGE_BYTES)
    if "n_chars" not in named:
        return masked
    kind = documents.schema["n_chars"].dataType
    return masked.withColumn("n_chars", F.when(F.col(text).isNull(), F.col("n_chars")).otherwise(F.char_length(text).cast(kind)))
