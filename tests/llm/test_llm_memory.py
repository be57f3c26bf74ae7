"""What the pipeline's operators leave in a Python worker, and how large the batches are that it gets."""

import pyarrow as pa

from fleetpulse.llm import jaccard_join, piece_spans, secrets
from fleetpulse.llm.catalog import tokenizer


class Captured:
    """Rows that only keep the settings and the work that ``map_batches`` gives them."""

    def __init__(self, batch):
        self.sparkSession, self.conf, self.columns, self.schema, self.batch, self.settings = self, self, ["doc_id", "text"], None, batch, {}

    def set(self, key, value):
        self.settings[key.rpartition(".")[2]] = int(value)

    def select(self, *columns):
        return self

    def mapInArrow(self, work, schema):
        self.rows_out = sum(b.num_rows for b in work(iter([self.batch])))
        return self


def texts(n):
    return [f"one two three four five six seven number{k}" for k in range(n)]


def test_a_worker_drops_the_caches_of_the_stage_before(spark):
    words = texts(300)
    model, ranks = tokenizer("piece_bpe_32k.model"), tokenizer("byte_bpe_50k.tiktoken")
    shingled = pa.RecordBatch.from_pydict({"doc_id": list(range(300)), "text_key": list(range(300)), "text": words})
    plain = shingled.select(["doc_id", "text"])

    class Counts:
        value = jaccard_join.np.zeros(jaccard_join.BUCKETS, "int64")

    signed = Captured(shingled)
    jaccard_join.signatures(signed, Counts())
    assert signed.rows_out == 300 and len(jaccard_join._WORDS) >= 300
    masked = Captured(plain)
    secrets.without_secrets(masked, ranks)
    assert masked.rows_out == 300 and not jaccard_join._WORDS and not jaccard_join._WORDS.old
    assert secrets.vocabulary.cache_info().currsize == 1
    encoded = Captured(plain)
    piece_spans.encode_spans(encoded, model, decoded=True)
    assert encoded.rows_out == 300
    assert secrets.vocabulary.cache_info().currsize == 0
    assert piece_spans.worker_encoder.cache_info().currsize == 1


def test_batches_of_the_pipeline_are_small(spark):
    batch = pa.RecordBatch.from_pydict({"doc_id": [1], "text": ["a few words"]})
    encoded, masked = Captured(batch), Captured(batch)
    piece_spans.encode_spans(encoded, tokenizer("piece_bpe_32k.model"))
    secrets.without_secrets(masked, tokenizer("byte_bpe_50k.tiktoken"))
    assert encoded.settings["maxBytesPerBatch"] == masked.settings["maxBytesPerBatch"] == 4 << 20
    assert encoded.settings["maxRecordsPerBatch"] == piece_spans.TEXTS_AT_ONCE
