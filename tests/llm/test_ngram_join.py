"""The join's search inside clusters: many sets that share a gram, clusters of several parts, small sets."""

import random
import time
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from tablesync.llm import ngram_join


def components(n, links):
    comp = list(range(n))
    for a, b in links:
        x, y = comp[a], comp[b]
        comp = [min(x, y) if c in (x, y) else c for c in comp]
    return comp


def shingles(t, n):
    ws = (t or "").lower().split()
    return {tuple(ws[i : i + n]) for i in range(len(ws) - n + 1)} or ({tuple(ws)} if ws else set())


@pytest.mark.parametrize("part_grams,num", [(1 << 20, 80), (150, 80), (60, 90)])
def test_clusters_of_several_parts_against_all_pairs(spark, monkeypatch, part_grams, num):
    monkeypatch.setattr(ngram_join, "PART_GRAMS", part_grams)
    rng = random.Random(num)
    head = [f"head{i}" for i in range(4)]
    texts = []
    for k in range(30):
        own = head + [f"t{k % 9}w{i}" for i in range(rng.randrange(2, 40))]
        for _ in range(rng.randrange(1, 6)):
            new = list(own)
            for _ in range(rng.randrange(4)):
                new[rng.randrange(len(new))] = f"x{rng.randrange(5)}"
            texts.append(" ".join(new))
    texts += ["head0 head1 head2 head3", "head0 head1 head2 head3 x", "head0 head1", "a", "a", "", None]
    sets = [shingles(t, 3) for t in texts]
    links = [(a, b) for a, b in combinations(range(len(texts)), 2) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b])]
    got = ngram_join.ngram_join(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3), 3, num, 100).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == {i: (len(sets[i]), c) for i, c in enumerate(components(len(texts), links))}


def _shared_gram(n):
    """Sets of 10 grams that share one, every tenth with a near copy."""
    rng = np.random.default_rng(n)
    sets = []
    for i in range(n):
        x = np.append(rng.integers(1 << 40, 1 << 62, 9).astype(np.uint64), np.uint64(7))
        if i % 10 == 1:
            x = sets[-1].copy()
            x[-1] = np.uint64(rng.integers(1 << 40, 1 << 62))
        sets.append(np.sort(x))
    return pa.table({"node": np.arange(n), "component": np.arange(n), "part": np.zeros(n, np.int32), "low": np.zeros(n, np.int32), "high": np.zeros(n, np.int32), "grams": pa.array([s.tobytes() for s in sets], pa.binary())})


def test_sets_that_share_a_gram_take_time_in_proportion():
    took = {}
    for n in (4000, 32000):
        table = _shared_gram(n)
        began = time.process_time()
        out = ngram_join._search(80, 100)(table)
        took[n] = time.process_time() - began
        assert out.num_rows == n // 10
    assert took[32000] < 20 * took[4000]


def test_a_node_of_the_largest_component_is_found_from_the_other_end():
    a = np.arange(100, 110, dtype=np.uint64)
    sets = [a, a, a, np.sort(np.append(a[:-1], np.uint64(5))), np.arange(10, dtype=np.uint64)]
    table = pa.table({"node": np.arange(5), "component": np.array([0, 0, 0, 3, 4]), "part": np.array([0, 1, 0, 1, 1], np.int32), "low": np.zeros(5, np.int32), "high": np.ones(5, np.int32), "grams": pa.array([s.tobytes() for s in sets], pa.binary())})
    out = ngram_join._search(80, 100)(table)
    assert out.num_rows == 1 and out.to_pylist()[0]["b"] == 3 and out.to_pylist()[0]["a"] in (0, 2)
