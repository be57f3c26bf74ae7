"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing names."""

import hashlib

import pytest
from pyspark.sql import functions as F

from fleetpulse.llm import decontaminate, jaccard_join, piece_spans, quality, secrets, token_counts, token_files, toxicity, url_lists, warc
from fleetpulse.llm.catalog import tokenizer
from fleetpulse.session import scratch_path

EMPTY = hashlib.sha256(b"").hexdigest()


def benchmark(spark, rows):
    return spark.createDataFrame([(*r, 7) for r in rows], "item_id long, text string, n_words long")


def tokens(spark, documents):
    folder = token_files.write_tokens(documents, scratch_path(spark, "t"), tokenizer("word_bpe_49k.json"), end_id=1, parts=3)
    return token_files.read_tokens(spark, folder)


REPORTS = {
    "op1": lambda s, d: decontaminate.report(d, benchmark(s, [(1, "two three four five six seven eight nine ten eleven")])),
    "op2": lambda s, d: secrets.scan(d, tokenizer("byte_bpe_50k.tiktoken")),
    "op3": tokens,
    "op6": lambda s, d: toxicity.score(d, toxicity.learn(d, s.createDataFrame([(3, 1), (6, 0), (None, 1), (7, None)], "doc_id long, toxic int"))),
    "op7": lambda s, d: jaccard_join.classes(d),
    "op8": lambda s, d: piece_spans.round_trip(d, tokenizer("piece_bpe_32k.model")),
    "op9": lambda s, d: token_counts.token_counts(d, tokenizer("byte_bpe_50k.json")),
    "op10": lambda s, d: quality.report(d),
}


@pytest.mark.parametrize("name", REPORTS)
def test_one_row_per_row(spark, odd, none, name):
    found = REPORTS[name](spark, odd)
    assert sorted(str(r[0]) for r in found.select("doc_id").collect()) == sorted(str(r[0]) for r in odd.select("doc_id").collect())
    empty = REPORTS[name](spark, none)
    assert empty.schema.names == found.schema.names and empty.count() == 0


def by_id(found, doc_id):
    return [r.asDict() for r in found.filter(F.col("doc_id").eqNullSafe(doc_id)).collect()]


def test_defined_results(spark, odd):
    op1 = REPORTS["op1"](spark, odd).cache()
    assert by_id(op1, 3)[0]["n_words"] == 0 and by_id(op1, 3)[0]["items_sha256"] == EMPTY
    assert [r["n_hit"] for r in by_id(op1, 1)] == [10, 10]
    op2 = by_id(REPORTS["op2"](spark, odd), 4)[0]
    assert (op2["n_assign"], op2["spans"], op2["base_sha256"]) == (0, "", EMPTY)
    assert [r["n_tokens"] for r in by_id(REPORTS["op3"](spark, odd), 4)] == [1]
    op8 = by_id(REPORTS["op8"](spark, odd), 5)[0]
    assert op8["decoded_sha256"] == hashlib.sha256(b" \n\t ").hexdigest()
    assert by_id(REPORTS["op9"](spark, odd), 3)[0] == {"doc_id": 3, "n_bytes": 0, "n_tokens": 0, "over_limit": False}
    op10 = by_id(REPORTS["op10"](spark, odd), 3)[0]
    assert op10["n_words"] == 0 and op10["base_failed"] and not op10["kept"]
    op7 = REPORTS["op7"](spark, odd).cache()
    assert {r["component_id"] for r in by_id(op7, 2) + by_id(op7, 1)} == {1}
    assert by_id(op7, 8)[0]["component_id"] == 7
    assert sorted((r["n_shingles"], r["component_id"]) for r in by_id(op7, None)) == [(0, None), (8, 1)]
    assert by_id(op7, 3)[0] == {"doc_id": 3, "n_shingles": 0, "component_id": 3}
    assert by_id(op7, 4)[0]["component_id"] == 4


def test_filters_keep_columns_and_rows(spark, odd, none):
    names = odd.columns
    items = benchmark(spark, [(1, "word1x1 word2x2 word3x3"), (None, None), (2, "")])
    clean = decontaminate.decontaminate(odd, items)
    assert clean.columns == names and clean.count() == odd.count() - 2
    assert decontaminate.decontaminate(odd, items.limit(0)).count() == odd.count()
    one = jaccard_join.keep_one(odd)
    assert one.columns == names
    assert sorted(str(r[0]) for r in one.select("doc_id").collect()) == sorted(map(str, [1, None, 3, 4, 5, 6, 7, 9, 9]))
    good = quality.keep_good(odd)
    assert good.columns == names and {r[0] for r in good.select("doc_id").collect()} <= {7, 8}
    safe = secrets.without_secrets(odd, tokenizer("byte_bpe_50k.tiktoken"))
    assert safe.columns == names and safe.count() == odd.count()
    for empty in (decontaminate.decontaminate(none, items), jaccard_join.keep_one(none), quality.keep_good(none)):
        assert empty.columns == names and empty.count() == 0


def test_warc_edges(spark):
    long_html = "é" * 600
    rows = [(1, "http://a/ b", long_html, "x"), (2, None, long_html, "x"), (2, None, long_html, "x"), (None, "u\r\nX: y", long_html, "x"),
            (3, "http://c", None, "x"), (4, "http://d", "", "x"), (5, "http://e", "short", "x"), (6, "http://f", "short", "x"),
            (7, "http://g", "a\r\n\r\nWARC/1.1\r\n" * 30_000, "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, payload_digest string").repartition(2)
    source, target = scratch_path(spark, "w"), scratch_path(spark, "w")
    files = warc.normalise(spark, warc.write_monolithic(warc.deduplicated(pages), source), source, target)
    found = warc.read_records(spark, files, target, with_payload=True).collect()
    got = sorted((str(r["page_id"]), r["record_type"], r["refers_to"], r["payload_bytes"]) for r in found)
    assert got == sorted([
        ("1", "revisit", 2, 1200), ("2", "response", None, 1200), ("2", "response", None, 1200), ("None", "revisit", 2, 1200),
        ("3", "response", None, 0), ("4", "response", None, 0), ("5", "response", None, 5), ("6", "response", None, 5),
        ("7", "response", None, 450_000),
    ])
    assert next(r["payload"] for r in found if r["page_id"] == 7).decode() == rows[-1][2]
    assert next(r["payload"] for r in found if r["page_id"] == 1) is None
    assert warc.read_records(spark, warc.normalise(spark, warc.write_monolithic(warc.deduplicated(pages.limit(0)), source + "e"), source + "e", target + "e"), target + "e").count() == 0


def test_url_list_edges(spark):
    changes = spark.createDataFrame(
        [("l", "Bad.example", 10, "add"), ("l", "bad.example", 20, "remove"), ("l", "bad.example", 15, "add"), ("l", "bad.example", 40, "add"),
         ("l", "tie.example", 5, "add"), ("l", "tie.example", 5, "remove"), ("l", None, 1, "add"), ("l", "bad.example", None, "add"),
         ("k", "bad.example/p", 10, "add"), ("l", "x", 3, "other")],
        "list_name string, entry string, changed_at long, action string",
    )
    captures = spark.createDataFrame(
        [(1, "http://www.bad.example/", 10, "z"), (2, "http://bad.example", 19, "z"), (3, "http://bad.example", 20, "z"), (4, "http://u@BAD.example:80/p/q?x", 50, "z"),
         (5, None, 50, "z"), (6, "no url", 50, "z"), (7, "http://bad.example", None, "z"), (8, "http://tie.example", 6, "z"), (8, "http://bad.example", 41, "z"), (8, "http://bad.example", 41, "z")],
        "page_id long, url string, fetched_at long, entry string",
    )
    spans = url_lists.validity(changes)
    assert sorted(tuple(r) for r in spans.collect()) == [
        ("k", "bad.example/p", 10, url_lists.OPEN_END), ("l", "bad.example", 10, 20), ("l", "bad.example", 40, url_lists.OPEN_END)]
    found = url_lists.judge(captures, spans, slice_seconds=7).collect()
    blocked = sorted((r["page_id"], r["entry"]) for r in found if r["blocked"])
    assert blocked == [(1, "bad.example"), (2, "bad.example"), (4, "bad.example/p"), (8, "bad.example"), (8, "bad.example")]
    assert len(found) == 10
    left = url_lists.allowed(captures, spans)
    assert left.columns == captures.columns and sorted(r[0] for r in left.collect()) == [3, 5, 6, 7, 8]
    assert url_lists.judge(captures.limit(0), spans).count() == 0
    assert url_lists.judge(captures, spans.limit(0)).filter("blocked").count() == 0
