"""Token counts from a broadcast table of pre-token lengths and worker caches."""

from __future__ import annotations

import os

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetpulse.llm import chunks
from fleetpulse.llm.common import Batches, Memo, map_batches, texts_of

# The byte-level pre-token pattern of the tokenizer family.
PRE_TOKENS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

CACHE_PRE_TOKENS = 800_000
CACHE_ODD_PIECES = 100_000
OVER = 512


def _library(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def frequent_lengths(path: str) -> dict[str, int]:
    """Token counts of the pre-tokens that the vocabulary itself lists.

    A vocabulary keeps what is frequent, and its size bounds the table whatever
    the corpus. Empty if the tokenizer does not use the byte-level pattern.
    """
    import regex

    with open(path, encoding="utf-8") as file:
        if chunks.style_of(file.read()) != "leading":
            return {}
    tokenizer = _library(path)
    decoded = [tokenizer.decode([i], skip_special_tokens=False) for i in range(tokenizer.get_vocab_size(False))]
    special = {t.content for t in tokenizer.get_added_tokens_decoder().values()}
    whole = regex.compile(PRE_TOKENS)
    listed = [t for t in decoded if t not in special and chunks.SETTLED.fullmatch(t) and (m := whole.match(t)) and m.end() == len(t)]
    found = tokenizer.encode_batch_fast(listed, add_special_tokens=False)
    return {t: len(e.ids) for t, e in zip(listed, found)}


class TextCounter:
    """Counts of whole texts: the table first, the worker's cache next, the library for what is left.

    Pieces with characters that libraries may class differently have a cache of their own.
    """

    def __init__(self, path: str, frequent: dict[str, int]):
        import regex

        self.tokenizer = _library(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.find = regex.compile(PRE_TOKENS).findall
        self.frequent = frequent
        self.memo, self.odd = Memo(CACHE_PRE_TOKENS), Memo(CACHE_ODD_PIECES)

    def __call__(self, text: str) -> int:
        if not self.frequent or any(s in text for s in self.special):
            return self._encode(text)
        self.memo.trim()
        settled, odd = chunks.parted(text)
        return self._settled(settled) + (self._odd(odd) if odd else 0)

    def _settled(self, text: str) -> int:
        tokens = self.find(text)
        found = list(map(self.frequent.get, tokens))
        if None not in found:
            return sum(found)
        missed = [t for t, n in zip(tokens, found) if n is None]
        cached = list(map(self.memo.get, missed))
        if None in cached:
            cached = [self._pre_token(t) if n is None else n for t, n in zip(missed, cached)]
        return sum(n for n in found if n) + sum(cached)

    def _odd(self, pieces: list[str]) -> int:
        """Pieces with other characters: the cache, and the whole library for new ones."""
        counts = {p: self.odd.get(p) or self.odd.recall(p) for p in dict.fromkeys(pieces)}
        new = [p for p, n in counts.items() if n is None]
        for piece, found in zip(new, self.tokenizer.encode_batch_fast(new, add_special_tokens=False)):
            counts[piece] = len(found.ids)
            self.odd.keep(piece, counts[piece])
        self.odd.trim()
        return sum(map(counts.get, pieces))

    def _pre_token(self, token: str) -> int:
        count = self.memo.get(token) or self.memo.recall(token)
        if count is not None:
            return count
        spelled = token.encode().decode("latin-1").translate(chunks.BYTE_LETTERS)
        count = len(self.tokenizer.model.tokenize(spelled))
        self.memo.keep(token, count)
        return count

    def _encode(self, text: str) -> int:
        return len(self.tokenizer.encode(text, add_special_tokens=False).ids)


_COUNTERS: dict[str, TextCounter] = {}


def _counter(path: str, table: Broadcast) -> TextCounter:
    """One counter a worker process, so its cache outlives a task."""
    if path not in _COUNTERS:
        _COUNTERS[path] = TextCounter(path, table.value)
    return _COUNTERS[path]


def token_counts(documents: DataFrame, tokenizer: str, limit: int = OVER, key: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit.

    A null or empty text has no bytes and no tokens. Null and repeated keys keep
    their rows, other columns are not read. There is no shuffle: pre-tokens are
    looked up where their text is read.
    """
    spark = documents.sparkSession
    frequent = spark.sparkContext.broadcast(frequent_lengths(tokenizer))
    types = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])

    def count(batches: Batches) -> Batches:
        counter = _counter(tokenizer, frequent)
        for batch in batches:
            found = list(map(counter, texts_of(batch)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), pa.array(found, pa.int64())], schema=types)

    text = F.col("text").cast("string")
    rows = documents.select(
        F.col(key).cast("bigint").alias("doc_id"),
        F.coalesce(F.octet_length(text).cast("bigint"), F.lit(0).cast("bigint")).alias("n_bytes"),
        text.alias("text"),
    )
    counted = map_batches(rows, count, "doc_id bigint, n_bytes bigint, n_tokens bigint")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
