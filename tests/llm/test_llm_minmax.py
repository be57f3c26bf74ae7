"""Min-max near duplicates against all pairs."""

import random

import numpy as np
import pytest

from fleetpulse.llm import minmax_dedup


def brute(texts, words=4, similar=80):
    sets = []
    for t in texts:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[k : k + words]) for k in range(len(w) - words + 1)} if len(w) >= words else {tuple(w)} if w else set())
    comp = list(range(len(texts)))
    for a, x in enumerate(sets):
        for b in range(a):
            if x & sets[b] and 100 * len(x & sets[b]) >= similar * len(x | sets[b]):
                low, high = sorted((comp[a], comp[b]))
                comp = [low if c == high else c for c in comp]
    return [(i, len(s), c, i == c) for i, (s, c) in enumerate(zip(sets, comp))]


def chains(seed, families, copies, length=90):
    """Families in which a copy changes a few words of an earlier one, so that classes are chains; some share a passage."""
    draw = random.Random(seed)
    common = [f"shared{k}" for k in range(60)]
    texts = []
    for f in range(families):
        own = [[f"w{f}x{draw.randrange(400)}" for _ in range(length)] + (common if f % 2 else [])]
        for _ in range(copies - 1):
            text = list(draw.choice(own[-4:]))
            for _ in range(draw.randrange(0, 5)):
                text[draw.randrange(len(text))] = f"new{draw.randrange(10**6)}"
            own.append(text)
        texts += [" ".join(t) for t in own]
    return texts


SPECIAL = ["", None, " \n\t", "one", "One", "one two", "a b c d", "A b C d", "a b c d e", "a b c d"]


@pytest.mark.parametrize("bounds", [(2_000_000, 20_000_000, 1_000, 50_000), (200, 4, 3, 5)])
def test_classes_equal_all_pairs(spark, monkeypatch, bounds):
    for name, value in zip(("TASK_ITEMS", "TASK_PAIRS", "BLOCK_NODES", "ROWS_PER_TASK"), bounds):
        monkeypatch.setattr(minmax_dedup, name, value)
    texts = chains(3, 4, 25) + SPECIAL + chains(3, 1, 3)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    found = sorted(tuple(r) for r in minmax_dedup.near_duplicates(docs).collect())
    expected = brute(texts)
    assert found == expected
    assert sum(r[3] for r in expected) < len(texts) / 2


def test_signature_is_unbiased_and_both_ends_count():
    draw = np.random.default_rng(5)
    errors = []
    for _ in range(200):
        union = draw.integers(0, 2**64, 500, dtype=np.uint64)
        a, b = np.unique(union[:450]), np.unique(union[50:])
        x, y = minmax_dedup.signature(a), minmax_dedup.signature(b)
        errors.append((x == y).mean() - 0.8)
    assert abs(np.mean(errors)) < 0.01
    # Below the deviation of 128 independent minima, as a minimum and a maximum of one permutation are never the same element.
    assert np.std(errors) < np.sqrt(0.8 * 0.2 / 128) * 1.15


def test_long_sets_are_signed_in_parts(monkeypatch):
    items = np.random.default_rng(1).integers(0, 2**64, 9_001, dtype=np.uint64)
    whole = minmax_dedup.signature(items)
    monkeypatch.setattr(minmax_dedup, "_ROWS_AT_ONCE", 100)
    assert (minmax_dedup.signature(items) == whole).all()


def test_pairs_at_the_limit_share_a_band():
    draw = np.random.default_rng(9)
    for size in (5, 20, 300):
        for _ in range(150):
            union = np.unique(draw.integers(0, 2**64, size, dtype=np.uint64))
            cut = size // 10
            a, b = union[: size - cut], union[size - 4 * size // 5 - (size - cut - 4 * size // 5) :]
            if 100 * len(np.intersect1d(a, b)) < 80 * size:
                b = union[: 4 * size // 5]
                a = union
            keys = minmax_dedup.band_keys(np.stack([minmax_dedup.signature(s) for s in (a, b)]))
            assert (keys[0] == keys[1]).any()


def test_edges(spark, odd, none):
    found = minmax_dedup.near_duplicates(odd)
    rows = sorted(((str(r[0]), r[1], str(r[2]), r[3]) for r in found.collect()))
    assert [r for r in rows if r[0] == "1"] == [("1", 9, "1", True)] * 2
    assert [r[2:] for r in rows if r[0] == "2"] == [("1", False)]
    assert ("None", 9, "1", False) in rows and ("None", 0, "None", True) in rows
    assert [r[2:] for r in rows if r[0] in "345"] == [(i, True) for i in "345"]
    assert [r[2:] for r in rows if r[0] in "78"] == [("7", True), ("7", False)]
    assert len(rows) == odd.count()
    empty = minmax_dedup.near_duplicates(none)
    assert empty.columns == ["doc_id", "n_shingles", "component_id", "kept"] and empty.count() == 0


def test_rows_without_any_id(spark):
    docs = spark.createDataFrame([(None, "a b c d e f")] * 2, "doc_id long, text string")
    assert [tuple(r) for r in minmax_dedup.near_duplicates(docs).collect()] == [(None, 3, None, True)] * 2
