"""Token alignment against a plain merge of the libraries' tokens."""

import hashlib
from collections import Counter, defaultdict

import pytest

from fleetpulse.llm import catalog, chunks, token_alignment as ta
from fleetpulse.llm.catalog import tokenizer
from fleetpulse.sources.tables import read_parquet

SF = "/root/testdata/sf0.001"
A, B = "byte_bpe_50k.json", "piece_bpe_32k.model"
ODD = [None, "", " ", "  two  blanks ", "a\n\n b\t\tc \r\n d", "naïve ÇA 漢字 \x1c odd <|endoftext|> <s> </s> é", "has ▁ inside", " x　y z",
       "🙂🙃 emoji 👩‍👩‍👧", "don't we'll I'd", "x" * 9000, "word " * 3000 + "end", "tab\tword\nline\nline", "\nfirst", "a", "▁", "0xAF <0x0A> 12345", "end;\r\nif (x) {\r\n\r x\r", "\r\rq \r w"]


def plain(texts):
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    first = Tokenizer.from_file(tokenizer(A))
    first.encode_special_tokens = True
    second = SentencePieceProcessor(model_file=tokenizer(B))
    back = {v: k for k, v in chunks.BYTE_LETTERS.items()}
    as_a = lambda i: bytes(back[c] for c in first.id_to_token(i))
    as_b = lambda i: bytes([int(second.id_to_piece(i)[3:5], 16)]) if second.is_byte(i) else second.id_to_piece(i).replace("▁", " ").encode()
    per_doc = []
    for text in texts:
        source = (" " + (text or "")).encode()
        a = first.encode(" " + text, add_special_tokens=False).ids if text else []
        b = second.encode(text) if text else []
        spelled_a, spelled_b = [as_a(i) for i in a], [as_b(i) for i in b]
        if not text or b"".join(spelled_a) != source or b"".join(spelled_b) != source:
            per_doc.append(None)
            continue
        spans = []
        for spelled in (spelled_a, spelled_b):
            ends, at = [], 0
            for s in spelled:
                ends.append((at, at + len(s)))
                at += len(s)
            spans.append(ends)
        links, y = [], 0
        for x, (low, high) in enumerate(spans[0]):
            while spans[1][y][1] <= low:
                y += 1
            z = y
            while z < len(b) and spans[1][z][0] < high:
                links.append((x, z))
                z += 1
        cuts = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
        groups, low = [], 0
        for cut in cuts:
            groups.append(tuple([i for i, (s, e) in zip(ids, span) if low <= s and e <= cut] for ids, span in zip((a, b), spans)) if len(cuts) < 300 else None)
            low = cut
        if len(cuts) >= 300:
            groups, x, y = [], 0, 0
            for cut in cuts:
                g = ([], [])
                while x < len(a) and spans[0][x][1] <= cut:
                    g[0].append(a[x])
                    x += 1
                while y < len(b) and spans[1][y][1] <= cut:
                    g[1].append(b[y])
                    y += 1
                groups.append(g)
        per_doc.append((a, b, groups, links))
    counts = Counter()
    for d in per_doc:
        if d:
            counts.update({(d[0][x], d[1][y]) for x, y in d[3]})
    most = defaultdict(int)
    for (a, _), n in counts.items():
        most[a] = max(most[a], n)
    out = []
    for k, d in enumerate(per_doc):
        if d is None:
            out.append((k, 0, 0, 0, 0, 0, 0, ""))
            continue
        a, b, groups, links = d
        held = [counts[a[x], b[y]] for x, y in links]
        best = sum(n == most[a[x]] for n, (x, _) in zip(held, links))
        spelled = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
        out.append((k, len(a), len(b), len(groups), len(links), best, sum(held), hashlib.sha256(spelled.encode()).hexdigest()))
    return out, per_doc


def frame(spark, texts, parts=3):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(parts)


def test_equals_plain_merge(spark):
    texts = ODD + [r["text"] for r in read_parquet(spark, f"{SF}/documents.parquet").orderBy("doc_id").collect()]
    expected, _ = plain(texts)
    got = sorted(tuple(r) for r in ta.report(frame(spark, texts), tokenizer(A), tokenizer(B)).collect())
    assert got == expected
    assert sum(r[7] == "" for r in got) >= 4 and sum(r[1] for r in got) > 10_000


@pytest.mark.parametrize("block, lane, search, table", [(4 << 20, 7, 3, 10), (300, 50, 512, 400_000), (4 << 20, 4_096, 512, 0)])
def test_blocks_lanes_and_tables_do_not_change_results(spark, monkeypatch, block, lane, search, table):
    for name, value in zip(("BLOCK_BYTES", "LANE_TOKENS", "LANE_SEARCH", "TABLE_CHUNKS"), (block, lane, search, table)):
        monkeypatch.setattr(ta, name, value)
    ta.worker_aligner.cache_clear()
    aligner = ta.BlockAligner(tokenizer(A), tokenizer(B))
    _, per_doc = plain(ODD)
    for low, high in ta._blocks([t or "" for t in ODD]):
        good, found = aligner([t or "" for t in ODD][low:high])
        for k in range(low, high):
            start = [int(b[k - low]) for b in found.bounds]
            end = [int(b[k - low + 1]) for b in found.bounds]
            assert good[k - low] == (per_doc[k] is not None)
            if per_doc[k]:
                own = found.links[0] - start[0], found.links[1] - start[1]
                inside = (found.links[0] >= start[0]) & (found.links[0] < end[0])
                assert sorted(zip(own[0][inside].tolist(), own[1][inside].tolist())) == per_doc[k][3]
                assert [i[s:e].tolist() for i, s, e in zip(found.ids, start, end)] == [per_doc[k][0], per_doc[k][1]]


def test_alignments_hold_links_and_cuts(spark):
    _, per_doc = plain(ODD)
    rows = {r["doc_id"]: r for r in ta.alignments(frame(spark, ODD), tokenizer(A), tokenizer(B)).collect()}
    for k, d in enumerate(per_doc):
        row = rows[k]
        if d is None:
            assert all(row[n] == [] for n in ("a_ids", "b_ids", "a_cuts", "b_cuts", "a_links", "b_links"))
            continue
        assert (row["a_ids"], row["b_ids"]) == (d[0], d[1])
        assert list(zip(row["a_links"], row["b_links"])) == d[3]
        ends = list(zip(row["a_cuts"], row["b_cuts"]))
        assert [(d[0][x:p], d[1][y:q]) for (x, y), (p, q) in zip([(0, 0), *ends], ends)] == [tuple(map(list, g)) for g in d[2]]


def test_whole_texts_where_cuts_are_not_safe(spark):
    table = ta.ChunkTable(ta.ByteLevelTokens(tokenizer(A)), ta.PieceTokens(tokenizer(B)))
    assert table.cuts
    cut = table.tokens([t or "" for t in ODD])
    table.clear()
    table.cuts = False
    whole = table.tokens([t or "" for t in ODD])
    assert (cut[0] == whole[0]).all()
    for (x, at), (y, to) in zip(cut[1], whole[1]):
        assert x.tolist() == y.tolist() and at.tolist() == to.tolist()


def test_edges(spark, odd, none):
    got = ta.report(odd, tokenizer(A), tokenizer(B))
    rows = got.collect()
    assert len(rows) == odd.count()
    same = [tuple(r)[1:] for r in rows if r["doc_id"] in (1, 2)]
    assert len(set(same)) == 1 and len(same) == 3
    assert all(r["n_a"] == 0 and r["groups_sha256"] == "" for r in rows if r["doc_id"] in (3, 4))
    empty = ta.report(none, tokenizer(A), tokenizer(B))
    assert empty.columns == got.columns and empty.count() == 0
    assert catalog.QUERIES["op13_token_alignment"](spark, SF).count() == 200
