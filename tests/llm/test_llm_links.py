"""Numbers of links against all pairs."""

import numpy as np
import pytest
from test_llm_brute import near_copies

from fleetpulse.llm import jaccard_join


def brute_links(texts):
    sets = []
    for t in texts:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} if w else set())
    similar = lambda x, y: len(x & y) > 0 and 100 * len(x & y) >= 80 * len(x | y)
    return [sum(similar(x, y) for b, y in enumerate(sets) if b != a) for a, x in enumerate(sets)]


@pytest.mark.parametrize("task_items", [2_000_000, 3_000, 400])
def test_every_link_is_counted(spark, task_items):
    texts = near_copies(5, 3, 40)
    texts += texts[:5] + texts[:2] + [None, "", " ", "one", "one", "one two", "ONE"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    rows = jaccard_join.link_counts(docs, task_items=task_items).collect()
    found = sorted((r.doc_id, r.n_links) for r in rows)
    expected = brute_links(texts)
    own = sorted((r.doc_id, r.n_shingles, r.component_id) for r in rows)
    assert own == sorted(tuple(r) for r in jaccard_join.classes(docs).collect())
    assert found == list(enumerate(expected))
    assert max(expected) > 10 and len(set(expected[:40])) > 3


def test_edges_of_link_counts(spark, odd, none):
    found = jaccard_join.link_counts(odd)
    assert sorted((str(r.doc_id), r.n_links) for r in found.collect()) == sorted(
        [("1", 3), ("1", 3), ("2", 3), ("None", 3), ("None", 0), ("3", 0), ("4", 0), ("5", 0), ("6", 0), ("7", 1), ("8", 1), ("9", 0), ("9", 0)]
    )
    empty = jaccard_join.link_counts(none)
    assert empty.columns == ["doc_id", "n_shingles", "component_id", "n_links"] and empty.count() == 0


def test_task_counts_weigh_copies_and_sides():
    sets = [np.arange(0, 100), np.arange(5, 100), np.arange(5, 105), np.arange(500, 503)]
    items, copies, sides = [s.astype(np.uint64) for s in sets], np.array([1, 10, 100, 1000]), np.array([0, 0, 1, 1])
    assert jaccard_join.task_counts(items, copies, sides, False, 80).tolist() == [110, 101, 11, 0]
    assert jaccard_join.task_counts(items, copies, sides, True, 80).tolist() == [100, 100, 11, 0]
