"""The compiled map's look-up on a map built here, encoding with its way back, and the whole pipeline on odd tables."""

import random

import corpus_pipeline
import sentencepiece
from fleetpulse.llm import piece_spans
from fleetpulse.llm.catalog import tokenizer


def compiled_map(pairs):
    """A double array in which every inner node has 256 units of its own."""
    trie, texts = {}, b""
    for key, replacement in pairs.items():
        node = trie
        for byte in key:
            node = node.setdefault(byte, {})
        node[None] = len(texts)
        texts += replacement + b"\0"
    units, queue = {0: 0}, [(0, trie)]
    for k, (at, node) in enumerate(queue, 1):  # grows while it is walked
        base = 256 * k
        units[at] |= (at ^ base) << 10 | (None in node) << 8
        for byte, below in node.items():
            units[base ^ (byte or 0)] = 0x80000000 | below if byte is None else byte
            if byte is not None:
                queue.append((base ^ byte, below))
    data = b"".join(units.get(k, 0).to_bytes(4, "little") for k in range(256 * (len(queue) + 1)))
    return len(data).to_bytes(4, "little") + data + texts


def test_longest_prefix_on_a_built_map():
    pairs = {b"a": b"x", b"ab": b"yz", b"abcd": b"", "\u00e9".encode(): b"e", "e\u0301".encode(): "\u00e9".encode(), b"L" * 100: b"long"}
    own, draw = piece_spans.CharacterMap(compiled_map(pairs)), random.Random(2)
    for _ in range(500):
        source = b"".join(draw.choices([*pairs, b"b", b"c", b"L" * 40, b"\xff"], k=6))
        for at in range(len(source)):
            fits = [k for k in pairs if source.startswith(k, at)]
            best = max(fits, key=len, default=None)
            assert own.longest(source, at) == (best and (len(best), pairs[best]))
    assert piece_spans.CharacterMap(b"").longest(b"abc", 0) is None


def test_encoding_with_the_way_back(spark, odd):
    model = tokenizer("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=model)
    expected = sorted((str(r["doc_id"]), tuple(library.encode(r["text"] or "")), library.decode(library.encode(r["text"] or ""))) for r in odd.collect())
    made = piece_spans.encode_spans(odd, model, decoded=True)
    assert sorted((str(r["doc_id"]), tuple(r["ids"]), r["decoded"]) for r in made.collect()) == expected
    back = piece_spans.decode(piece_spans.encode_spans(odd, model), model)
    assert sorted((str(r["doc_id"]), r["text"]) for r in back.collect()) == sorted((k, t) for k, _, t in expected)


def test_pipeline_on_odd_and_empty_tables(spark, odd, none, tmp_path):
    benchmark = spark.createDataFrame([(1, "a passage that nothing holds"), (None, None)], "item_id long, text string")
    for name, docs in (("odd", odd), ("none", none)):
        docs.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        benchmark.write.parquet(f"{tmp_path}/{name}/benchmark.parquet")
        made = corpus_pipeline.run(spark, f"{tmp_path}/{name}")
        assert made.columns == ["doc_id", "ids", "starts", "ends", "decoded"]
        kept = [r["doc_id"] for r in made.collect()]
        assert set(kept) <= {7, 8} and bool(kept) == (name == "odd") and len(kept) <= 1
