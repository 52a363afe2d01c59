"""Dual-tree search against plain scores of all pairs."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tablesync.llm import dual_tree

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(t):
    return TERM.findall(re.sub("[A-Z]+", lambda m: m.group().lower(), t or ""))


def brute(docs, items, k):
    each = [(i, Counter(terms(t))) for i, t in docs]
    total, n = sum(sum(c.values()) for _, c in each), sum(bool(c) for _, c in each)
    df = Counter(t for _, c in each for t in c)
    out = []
    for item, text in dict.fromkeys(items):
        scored = []
        for i, c in each:
            size = sum(c.values())
            if size:
                m = 50 + 50 * size * n // total
                own = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 20 * m)) for t in set(terms(text)) if c[t])
                if own > 0:
                    scored.append((-own, -(1 << 63) if i is None else i, i))
        out += [(item, rank, i, -s) for rank, (s, _, i) in enumerate(sorted(scored, key=lambda x: x[:2])[:k], 1)]
    return sorted(out, key=repr)


def drawn(n, seed):
    rng = random.Random(seed)
    vocabulary = [f"w{int(1.5 ** (rng.random() * 14))}" for _ in range(300)] + ["É", "ß", "CAT", "cat's", "x-y"]
    return [(i, " ".join(rng.choice(vocabulary) for _ in range(int(1.4 ** (rng.random() * 14))))) for i in range(n)]


@pytest.fixture
def small(monkeypatch):
    monkeypatch.setattr(dual_tree, "BLOCK_DOCS", 64)
    monkeypatch.setattr(dual_tree, "LEAF_DOCS", 4)
    monkeypatch.setattr(dual_tree, "LEAF_ITEMS", 2)


@pytest.mark.parametrize("k,item_bytes", [(3, 4 << 20), (50, 700)])
def test_search_equals_plain_scores(spark, small, monkeypatch, k, item_bytes):
    monkeypatch.setattr(dual_tree, "ITEM_BYTES", item_bytes)
    odd = [(None, "cat w1 w2"), (5, "cat w1 w2"), (5, "cat w1 w2"), (700, None), (701, ""), (702, "...!"), (703, "w3 " * 30000), (704, "w1"), (705, "w1")]
    docs = drawn(400, k) + odd
    items = drawn(25, k + 1) + [(90, None), (91, ""), (92, "?!"), (93, "unseen"), (94, "cat"), (94, "cat"), (94, "w1 w2"), (None, "w2 cat")]
    frame = spark.createDataFrame([(i, t, "clash", 1) for i, t in docs], "doc_id long, text string, item string, score int").repartition(3)
    asked = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, block int")
    got = dual_tree.search(frame, asked, k)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute(docs, items, k)


def test_search_of_nothing(spark):
    docs, items = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string"), spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert [tuple(r) for r in dual_tree.search(docs, items).collect()] == brute([(1, "a b"), (2, None)], [(1, "a")], 50)
    assert dual_tree.search(docs.limit(0), items).count() == dual_tree.search(docs, items.limit(0)).count() == dual_tree.search(docs.filter("text IS NULL"), items).count() == 0


def test_copies_in_thousands_and_equal_scores(spark, small):
    docs = [(i, "the same text of all") for i in range(3000)] + [(i, "other words") for i in range(3000, 3040)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    asked = [(1, "same text"), (2, "other text")]
    got = dual_tree.search(frame, spark.createDataFrame(asked, "item_id long, text string"), 50)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(docs, asked, 50)


def test_bounds_leave_most_pairs_and_hold(small):
    """Two topics: items of one leave the other's documents unseen, and no bound lies below a score under it."""
    docs = [(i, " ".join(f"{'ab'[i % 2]}{(i * j) % 17}" for j in range(1, 9))) for i in range(64)]
    items = dual_tree.read_items([(i, " ".join(f"{'ab'[i % 2]}{(i + j) % 17}" for j in range(3))) for i in range(10)])
    rows = [(i, Counter(items.vocabulary.searchsorted(dual_tree.Spans([t.encode()], dual_tree.TERM).hashes(True)).tolist())) for i, t in docs]
    items.n, items.total = 64, 64 * 8
    items.weight = np.full(len(items.vocabulary), 1000)
    block = dual_tree.Block.__new__(dual_tree.Block)
    block.ids, block.n = np.arange(64), np.full(64, 8)
    block.first = np.concatenate(([0], np.cumsum([len(c) for _, c in rows])))
    block.term = np.minimum(np.array([t for _, c in rows for t in sorted(c)]), len(items.vocabulary) - 1)
    block.tf = np.array([c[t] for _, c in rows for t in sorted(c)])
    search = dual_tree.Search(items, block, np.ones(10, np.int64), 3)
    search.run()
    assert search.visited < 0.6 * search.pairs

    def nodes(x):
        return [x, *(y for b in x.below for y in nodes(b))]

    for d in nodes(search.docs.root):
        search.scratch[:] = 0
        search.scratch[d.terms] = d.most
        for n, bound in zip(nodes(items.tree.root), search.bounds(nodes(items.tree.root), d)):
            assert sorted(items.tree.order) == list(range(10))
            for item in items.tree.order[n.lo : n.hi]:
                own = set(items.term[items.first[item] : items.first[item + 1]])
                for x in search.docs.order[d.lo : d.hi]:
                    at = slice(search.docs.first[x], search.docs.first[x + 1])
                    assert sum(v for t, v in zip(search.docs.term[at], search.docs.value[at]) if t in own) * 1000 <= bound


def test_lengths_whose_products_pass_64_bits():
    items = dual_tree.read_items([(1, "a")])
    items.n, items.total = 10**12, 10**15
    block = dual_tree.Block.__new__(dual_tree.Block)
    block.n, block.first, block.tf = np.array([10**9]), np.array([0, 1]), np.array([7])
    assert block.values(items).tolist() == [7 * 10**9 // (7000 + 20 * (50 + 50 * 10**9 * 10**12 // 10**15))]
