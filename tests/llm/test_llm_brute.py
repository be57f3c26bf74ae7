"""Operators that SQL does not express, against brute force or the libraries themselves."""

import gzip
import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from fleetpulse.llm import catalog, chunks, common, decontaminate, graph, jaccard_join, piece_spans, quality, secrets, token_counts, token_files, warc
from fleetpulse.llm.catalog import tokenizer
from fleetpulse.sources.tables import read_parquet

SF = "/root/testdata/sf0.001"
SF_LARGER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def documents(spark):
    return {r["doc_id"]: r["text"] or "" for r in read_parquet(spark, f"{SF}/documents.parquet").collect()}


def rows(query, spark, sf=SF):
    return {r["doc_id"]: r for r in catalog.QUERIES[query](spark, sf).collect()}


def test_suffix_arrays_find_longest_matches():
    draw = random.Random(3)
    words = [f"w{k}" for k in range(6)]
    for _ in range(40):
        texts = [" ".join(draw.choices(words, k=draw.randrange(0, 40))) for _ in range(5)]
        items = [(k, " ".join(draw.choices(words, k=draw.randrange(0, 12)))) for k in range(4)]
        found = decontaminate.search_shard([t.encode() for t in texts], decontaminate.make_block(items, 3), 3)
        for text, (n, matches) in zip(texts, found):
            own, expected = text.split(), set()
            for k, item in items:
                other = item.split()
                size = min(3, len(other))
                for a in range(len(own)):
                    for p in range(len(other)):
                        if a and p and own[a - 1] == other[p - 1] and size > 1 and own[a - 1 : a - 1 + size] == other[p - 1 : p - 1 + size]:
                            continue
                        length = 0
                        while a + length < len(own) and p + length < len(other) and own[a + length] == other[p + length]:
                            length += 1
                        if size and length >= size:
                            expected.add((k, a, p, length))
            short = {k for k, item in items if len(item.split()) == 1}
            assert n == len(own)
            entries = list(dict.fromkeys(tuple(item.split()) for _, item in items if item))  # equal items are one entry
            entry = {k: entries.index(tuple(item.split())) for k, item in items if item}
            assert {m for m in matches if m[0] not in {entry[k] for k in short}} == {(entry[m[0]], *m[1:]) for m in expected if m[0] not in short}


def test_many_equal_short_items(spark):
    items = spark.createDataFrame([(k, "Yes." if k % 2 else "yes") for k in range(100_000)], "item_id long, text string")
    docs = spark.createDataFrame([(1, "yes " * 2000), (2, "no " * 50), (3, "oh yes")], "doc_id long, text string")
    found = {r["doc_id"]: r for r in decontaminate.report(docs, items).collect()}
    assert [(r["n_hit"], r["n_items"], len(r["matches"])) for r in (found[1], found[2], found[3])] == [(2000, 100_000, 2000), (0, 0, 0), (1, 100_000, 1)]
    assert found[1]["matches"][5].asDict() == {"item_id": 0, "doc_word": 5, "item_word": 0, "n_words": 1}
    assert [r["doc_id"] for r in decontaminate.decontaminate(docs, items).collect()] == [2]


def test_benchmark_in_blocks(spark):
    docs, items = (read_parquet(spark, f"{SF}/{n}.parquet") for n in ("documents", "benchmark"))
    whole = decontaminate.report(docs, items).drop("matches")
    parts = decontaminate.report(docs, items, block_bytes=300).drop("matches")
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, parts.collect()))
    assert whole.filter("contaminated").count() > 0


def plain_base(text):
    letters = "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in "password")
    names = ["password", "passwd", "secret", "token", "api_?key"]
    either = ["".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in n) for n in names]
    assert letters == either[0]
    assign = re.compile("(" + "|".join(either) + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    spans = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 8]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return [(("assign", "access", "hex")[k], a, b) for a, k, b in sorted(spans)]


def test_base_secrets(spark, documents):
    found = rows("op2_secrets", spark)
    for doc_id, text in documents.items():
        base = plain_base(text)
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert found[doc_id]["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert [found[doc_id][f"n_{k}"] for k in ("assign", "access", "hex")] == [sum(s[0] == k for s in base) for k in ("assign", "access", "hex")]
    tricky = "toKen=secret:abcdefghijk PASSWORD = 'x.y=z+123' token=short AKIAAKIA0123456789 ſecret=abcdefgh1 api_key:\"q1w2e3r4t5\" " + "a" * 33
    assert secrets.base_spans(tricky) == plain_base(tricky)


def test_random_strings_and_known_ones():
    finder = secrets.SecretFinder(tokenizer("byte_bpe_50k.tiktoken"))
    kinds = lambda text: [k for k, _, _ in finder.spans(text)]
    assert kinds("key xK9vQ2mZ7pLw4RtY8nBc3HdJ here") == ["random"]
    assert kinds("id 123e4567-e89b-12d3-a456-426614174000 page-2024-01-chapter-12 4111111111111111") == []
    assert kinds("sha256-47DEQpj8HBSa+/TImW+5JCeuQeRkm5NMpJWZG3hSuFU= and understandingcommunication") == []
    text = "token=abcdefgh12345678 then xK9vQ2mZ7pLw4RtY8nBc3HdJ."
    assert secrets.redact(text, finder.spans(text), "[S]") == "[S] then [S]."


def test_token_files_round_trip(spark, documents, tmp_path):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer("word_bpe_49k.json"))
    docs = read_parquet(spark, f"{SF}/documents.parquet")
    folder = token_files.write_tokens(docs, str(tmp_path / "t"), tokenizer("word_bpe_49k.json"), end_id=1, parts=5)
    assert folder.dtype == "<u2" and token_files.open_folder(folder.uri) == folder
    found = {r["doc_id"]: r for r in token_files.read_tokens(spark, folder, with_ids=True).collect()}
    start = 0
    for at, doc_id in enumerate(sorted(documents)):
        ids = library.encode(documents[doc_id], add_special_tokens=False).ids + [1]
        row = found[doc_id]
        assert (row["start"], row["n_tokens"], row["ids"]) == (start, len(ids), ids)
        assert row["ids_crc32"] == zlib.crc32(np.asarray(ids, "<u4").tobytes())
        if at % 50 == 0:
            key, begin, mapped = token_files.document_tokens(folder, at)
            assert (key, begin, mapped.tolist()) == (doc_id, start, ids)
        start += len(ids)


ODD_TEXTS = [
    "", " ", "a  b\n\n c\t", "it's 'S 'tis I'LL", "x<|endoftext|>y <|startoftext|>", "...,, a.b,c .\x1cq", "ÀÉ ß ÿ ½ ² ª", "İstanbul ΑΣ ΟΔΟΣ", "é Å ﬁ",
    "漢字かな 한국어", "a b c d\x85e", "#a$b 12,345.67 foo_bar x--y", "word." * 40, "​zero﻿", "🙂🙂 ok",
]


def test_chunked_encoders_equal_the_library():
    from tokenizers import Tokenizer

    words, counts = tokenizer("word_bpe_49k.json"), tokenizer("byte_bpe_50k.json")
    encode = token_files.TextEncoder(words, "<u2")
    count = token_counts.TextCounter(counts, token_counts.frequent_lengths(counts))
    for text in ODD_TEXTS + [" ".join(ODD_TEXTS)]:
        ids = Tokenizer.from_file(words).encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encode(text), "<u2").tolist() == ids, text
        assert count(text) == len(Tokenizer.from_file(counts).encode(text, add_special_tokens=False).ids), text
    assert [chunks.style_of(open(p).read()) for p in (words, counts)] == ["dropped", "leading"]


@pytest.mark.parametrize("read, chunk", [(1, 1), (7, 50), (1 << 16, 1 << 20)])
def test_records_of_any_size(monkeypatch, read, chunk):
    monkeypatch.setattr(warc, "_READ", read)
    monkeypatch.setattr(warc, "_CHUNK", chunk)
    draw = random.Random(read)
    records = []
    for size in [0, 1, 3, 4, 5, 60, 5_000, 2, 0, 900]:
        body = bytes(draw.choices(b"\r\nab", k=size))
        records.append(b"WARC/1.1\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (size, body))
    for members in ([b"".join(records)], records, [b"".join(records[:4]), b"", b"".join(records[4:])]):
        source = pa.BufferReader(b"".join(map(gzip.compress, members)))
        assert [record for _, record in warc.records_in(source)] == records
    with pytest.raises(ValueError, match="inside a record"):
        list(warc.records_in(pa.BufferReader(gzip.compress(b"".join(records)[:-3]))))


def test_mixed_texts_keep_the_table():
    from tokenizers import Tokenizer

    path = tokenizer("byte_bpe_50k.json")
    library, count = Tokenizer.from_file(path), token_counts.TextCounter(path, token_counts.frequent_lengths(path))
    draw = random.Random(5)
    signs = ["word", "don't", " ", "  ", "\n", "\t", "\r\n", "\u201cquoted\u201d", "漢字。", "слово", "\xa0", "\u3000", "\x0b", "\x1c", "\x85", "\u200b", "🙂", "12,5", "—", "\xad"]
    for _ in range(3_000):
        text = "".join(draw.choices(signs, k=draw.randrange(1, 14)))
        assert count(text) == len(library.encode(text, add_special_tokens=False).ids), repr(text)
    settled, odd = chunks.parted("He said \u201cno\u201d to all of them, 漢字 included, and left")
    assert (settled, odd) == ("He said to all of them, included, and left", [" \u201cno\u201d", " 漢字"])
    count.odd.limit = 4
    assert all(count(t) == len(library.encode(t, add_special_tokens=False).ids) for t in ODD_TEXTS * 2)


def test_parts_of_bounded_size(spark, tmp_path, monkeypatch):
    docs = read_parquet(spark, f"{SF}/documents.parquet")
    path = tokenizer("word_bpe_49k.json")
    whole = token_files.write_tokens(docs, str(tmp_path / "w"), path, end_id=1, parts=2)
    monkeypatch.setattr(common, "BATCH_ROWS", 7)
    cut = token_files.write_tokens(docs, str(tmp_path / "c"), path, end_id=1, parts=2, part_bytes=2_000)
    assert len(whole.parts) == 2 < len(cut.parts)
    assert sorted(token_files.read_tokens(spark, cut).collect()) == sorted(token_files.read_tokens(spark, whole).collect())


def test_small_caches_change_nothing(documents):
    full, tiny = (token_files.TextEncoder(tokenizer("word_bpe_49k.json"), "<u2") for _ in range(2))
    tiny.words.limit = tiny.chunks.limit = 20
    assert [full(t) for t in documents.values()] == [tiny(t) for t in documents.values()]


def test_token_counts_equal_the_library(spark, documents):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer("byte_bpe_50k.json"))
    for doc_id, row in rows("op9_token_counts", spark).items():
        n = len(library.encode(documents[doc_id], add_special_tokens=False).ids)
        assert (row["n_tokens"], row["n_bytes"], row["over_limit"]) == (n, len(documents[doc_id].encode()), n > 512)


def test_pieces_equal_the_library(spark, documents):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=tokenizer("piece_bpe_32k.model"))
    for doc_id, row in rows("op8_piece_spans", spark).items():
        ids = library.encode(documents[doc_id])
        assert row["n_tokens"] == len(ids) and row["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()
        assert row["span_bytes"] == row["n_bytes"]


def test_piece_spans_are_source_bytes():
    encoder = piece_spans.PieceEncoder(tokenizer("piece_bpe_32k.model"))
    for text in ODD_TEXTS:
        ids = encoder.encode([text])[0]
        starts, ends = encoder.spans(text, ids)
        assert b"".join(text.encode()[a:b] for a, b in zip(starts, ends)) == text.encode()
        for i, a, b in zip(ids, starts, ends):
            piece = encoder.library.id_to_piece(i)
            if not piece.startswith("<0x"):
                assert text.encode()[a:b].decode().replace(" ", "▁") in (piece, piece.removeprefix("▁"))


def test_compiled_map_equals_the_library():
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2

    with open(tokenizer("piece_bpe_32k.model"), "rb") as file:
        model = sentencepiece_model_pb2.ModelProto.FromString(file.read())
    try:
        library = sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc")
        spec = sentencepiece_model_pb2.ModelProto.FromString(library.serialized_model_proto()).normalizer_spec
    except Exception as error:  # noqa: BLE001
        pytest.skip(f"this build of the library gives no compiled map: {error}")
    assert not model.normalizer_spec.precompiled_charsmap and spec.precompiled_charsmap
    spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces = True, True, True
    own = piece_spans.Normalizer(spec)
    library = sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc")
    for text in ODD_TEXTS + ["①②ｶﾞ ﬁne  ½ Å", "ẹ́"]:
        data, begins, ends = own(text.encode())
        assert data.decode() == library.normalize(text)
        assert len(begins) == len(ends) == len(data) and (np.diff(begins) >= 0).all()


def brute_classes(texts):
    sets = []
    for t in texts:
        w = t.encode().lower().split()
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} if w else set())
    parent = list(range(len(sets)))
    for a in range(len(sets)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 80 * len(sets[a] | sets[b]):
                low, high = sorted((parent[a], parent[b]))
                parent = [low if p == high else p for p in parent]
    return [(len(s), p) for s, p in zip(sets, parent)]


def near_copies(seed, groups, size, words=120):
    draw = random.Random(seed)
    texts = []
    for g in range(groups):
        base = [f"g{g}w{k}" for k in range(words)]
        for _ in range(size):
            own = list(base)
            for _ in range(draw.randrange(0, 7)):
                own[draw.randrange(len(own))] = f"x{draw.randrange(10**9)}"
            texts.append(" ".join(own[: len(own) - draw.randrange(0, 12)]))
    draw.shuffle(texts)
    return texts


@pytest.mark.parametrize("small, task_items", [(32, 2_000_000), (4, 2_000_000), (2, 3_000), (2, 200)])
def test_regions_join_exactly(spark, monkeypatch, small, task_items):
    texts = near_copies(5, 3, 60) + ["", "one", "one", "one two"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    monkeypatch.setattr(jaccard_join.node_classes, "__defaults__", (80, small, task_items))
    found = sorted(tuple(r) for r in jaccard_join.classes(docs).collect())
    assert found == [(i, n, c) for i, (n, c) in enumerate(brute_classes(texts))]


def test_task_links_join_what_pairs_would():
    texts = near_copies(9, 2, 50, 60)
    items = [jaccard_join.shingle_set(t.encode()) for t in texts]
    links = jaccard_join.task_links(items, list(range(len(items))), 80)
    parent = list(range(len(items)))
    for a, b in links:
        low, high = sorted((parent[a], parent[b]))
        parent = [low if p == high else p for p in parent]
    assert parent == [c for _, c in brute_classes(texts)]


def test_components(spark):
    chain = [(k, k + 1) for k in range(40)] + [(100, 50), (50, 100), (7, 7), (200, 201), (201, 202)]
    got = {tuple(r) for r in graph.components(spark.createDataFrame(chain, "u long, v long")).collect()}
    assert got == {(k, 0) for k in range(41)} | {(50, 50), (100, 50)} | {(k, 200) for k in (200, 201, 202)}


def test_pipeline_against_brute_force(spark, documents):
    docs = read_parquet(spark, f"{SF}/documents.parquet")
    named = dict(corpus_pipeline.STAGES)
    assert list(named) == ["quality", "near_duplicates", "decontamination", "secrets", "pieces"]
    kept = named["quality"](spark, docs, SF).cache()
    verdicts = quality.report(docs)
    assert kept.columns == docs.columns
    assert {r[0] for r in kept.select("doc_id").collect()} == {r[0] for r in verdicts.filter("kept").select("doc_id").collect()}
    one = named["near_duplicates"](spark, kept, SF).cache()
    texts = sorted((r["doc_id"], r["text"]) for r in kept.collect())
    classes = brute_classes([t for _, t in texts])
    assert sorted(r[0] for r in one.select("doc_id").collect()) == [texts[k][0] for k, (_, c) in enumerate(classes) if c == k]
    clean = named["decontamination"](spark, one, SF).cache()
    windows = set()
    for r in read_parquet(spark, f"{SF}/benchmark.parquet").collect():
        w = decontaminate.words_of(r["text"].encode())
        windows |= {tuple(w[k : k + 10]) for k in range(len(w) - 9)}
    holds = lambda t: any(tuple(w[k : k + 10]) in windows for w in [decontaminate.words_of(t.encode())] for k in range(len(w) - 9))
    assert {r[0] for r in clean.select("doc_id").collect()} == {r["doc_id"] for r in one.collect() if not holds(r["text"])}
    safe = named["secrets"](spark, clean, SF).cache()
    assert safe.columns == docs.columns and safe.count() == clean.count()
    assert all(not secrets.base_spans(r["text"]) and r["n_chars"] == len(r["text"]) for r in safe.collect())
    last = corpus_pipeline.run(spark, SF)
    decoded = {r["doc_id"]: r["text"] for r in piece_spans.decode(last, tokenizer("piece_bpe_32k.model")).collect()}
    assert decoded == {r["doc_id"]: r["text"] for r in safe.collect()}


def test_batches_keep_arrow_types():
    batch = pa.RecordBatch.from_pydict({"text": pa.array(["a", None])})
    from fleetpulse.llm.common import bytes_of, texts_of

    assert texts_of(batch) == ["a", ""] and bytes_of(batch) == [b"a", b""]
