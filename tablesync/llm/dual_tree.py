"""Ranked lexical search of all documents for a set of items: dual-tree search with exact top lists.

Documents are read once into blocks of sparse vectors over the items' terms (``index``, a written table). A block
has a tree over its documents, split by their heaviest terms, and the items have one too. A node holds the maximum of
each coordinate below it, so the product of two nodes' maxima bounds every score of a pair below them. A pair of nodes
whose bound is less than the weakest score in the top lists of all the node's items is left with all pairs below it;
the others are opened, the more promising documents first, down to the scores themselves.

Top lists do not begin empty: each item first looks into the one block whose root bounds it highest, and its weakest
score there starts the search of all blocks. A start changes what is visited, never the result: bounds are integers
and only pairs strictly below are left, so ties stay. A block gives its documents that are not below the start, ``k`` an
item at most, and these meet by item in two levels.

Items are taken in batches of about ``ITEM_BYTES`` of text, so that what each task holds of them is bounded however
many there are; documents are read once a batch.

Nulls and empties: null and empty texts have no terms, rank nowhere and are found by nothing. A null doc_id comes
before all others among equal scores. Each row of the documents is a document; rows of items that repeat id and text are
one item, a null item id is an item's id as any other. Other columns are left alone. Terms are told apart by 64-bit
fingerprints: of n distinct ones two are taken for one with a probability of n**2 / 2**65.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablesync.llm.common import materialise, pack, runs, short_batches, unpack
from tablesync.llm.spans import Spans

ITEM_BYTES = 4 << 20
#: Bytes of text and documents in a block.
BLOCK, BLOCK_DOCS = 4 << 20, 1 << 12
#: Rows below which a node is not split.
LEAF_DOCS, LEAF_ITEMS = 32, 4
NULL_ID = -(1 << 63)
TERM = np.zeros(256, bool)
TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def _gathered(first: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the entries of ``rows`` in a table whose row i has first[i]:first[i + 1], and where each row's begin."""
    size = first[rows + 1] - first[rows]
    begin = np.cumsum(size) - size
    return np.repeat(first[rows] - begin, size) + np.arange(size.sum()), begin


@dataclass
class Node:
    """Rows lo:hi of the tree's order; the terms below it in order, with the maximum of each."""

    lo: int
    hi: int
    terms: np.ndarray
    most: np.ndarray
    below: tuple[Node, ...] = ()


class Tree:
    """A hierarchy over sparse rows (first, term, value; all values above 0) that splits by heavy terms."""

    def __init__(self, first: np.ndarray, term: np.ndarray, value: np.ndarray, weight: np.ndarray, leaf: int):
        self.first, self.term, self.value, self.weight, self.leaf = first, term, value, weight, leaf
        self.order = np.arange(len(first) - 1)
        todo, made = [(0, len(self.order))], []
        while todo:
            lo, hi = todo.pop()
            at, begin = _gathered(self.first, self.order[lo:hi])
            by = np.argsort(self.term[at], kind="stable")
            terms, values = self.term[at][by], self.value[at][by]
            cut = runs(terms)
            most = np.maximum.reduceat(values, cut) if len(cut) else values
            made.append([lo, hi, terms[cut], most])
            if hi - lo > leaf:
                middle = lo + self._split(lo, hi, at, begin, terms, values, cut)
                todo += [(middle, hi), (lo, middle)]
        self.root = self._linked(made)

    def _split(self, lo: int, hi: int, at: np.ndarray, begin: np.ndarray, terms: np.ndarray, values: np.ndarray, cut: np.ndarray) -> int:
        """Puts rows with the term that weighs most, and that neither nearly all nor nearly none have, before the others."""
        rows = hi - lo
        has = np.diff(cut, append=len(terms))
        few = np.minimum(has, rows - has)
        if len(cut) and few.max() * 8 >= rows:
            gain = np.where(few * 8 >= rows, np.add.reduceat(values, cut) * self.weight[terms[cut]] / has * few, -1.0)
            chosen = terms[cut[int(np.argmax(gain))]]
            hit = np.zeros(rows, bool)
            owner = np.repeat(np.arange(rows), np.diff(begin, append=len(at)))
            hit[owner[self.term[at] == chosen]] = True
            own = self.order[lo:hi]
            self.order[lo:hi] = np.concatenate((own[hit], own[~hit]))
            return int(hit.sum())
        return rows // 2

    @staticmethod
    def _linked(made: list) -> Node:
        """``made`` is in preorder, so a node's halves come after it."""
        done: dict[tuple[int, int], Node] = {}
        starts: dict[int, list[Node]] = {}
        for lo, hi, terms, most in reversed(made):
            halves = [n for n in starts.get(lo, []) if n.hi < hi]
            left = max(halves, key=lambda n: n.hi, default=None)
            below = (left, done[left.hi, hi]) if left else ()
            node = done[lo, hi] = Node(lo, hi, terms, most, below)
            starts.setdefault(lo, []).append(node)
        return done[made[0][0], made[0][1]]


@dataclass
class Items:
    """A batch of items: ids, their terms as places in ``vocabulary`` (sorted fingerprints), and later the weights."""

    ids: list
    first: np.ndarray
    term: np.ndarray
    vocabulary: np.ndarray
    weight: np.ndarray | None = None
    n: int = 0
    total: int = 0

    @cached_property
    def tree(self) -> Tree:
        return Tree(self.first, self.term, self.weight[self.term], np.ones(len(self.vocabulary)), LEAF_ITEMS)


def read_items(rows: list[tuple]) -> Items:
    """(id, text) rows as a batch."""
    s = Spans([t.encode() if t else None for _, t in rows], TERM)
    vocabulary, term = np.unique(s.hashes(lower=True), return_inverse=True)
    key = np.unique(s.doc * max(len(vocabulary), 1) + term)
    doc, term = np.divmod(key, max(len(vocabulary), 1))
    return Items([i for i, _ in rows], np.searchsorted(doc, np.arange(len(rows) + 1)), term, vocabulary)


def _index(vocabulary: np.ndarray):
    """Blocks of documents as sparse rows over ``vocabulary``; documents without any of its terms only count."""
    numbers, packed = ("block", "with_terms", "terms", "docs", "entries"), ("ids", "n", "size", "term", "tf")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, done = TaskContext.get().partitionId() << 32, 0
        ids, texts, size = [], [], 0

        def block() -> pa.RecordBatch:
            s = Spans(texts, TERM)
            n, h, doc = s.counts, s.hashes(lower=True), s.doc
            at = np.minimum(np.searchsorted(vocabulary, h), len(vocabulary) - 1)
            hit = vocabulary[at] == h
            key, tf = np.unique(doc[hit] * len(vocabulary) + at[hit], return_counts=True)
            doc, term = np.divmod(key, len(vocabulary))
            own, per = np.unique(doc, return_counts=True)
            arrays = [np.array(ids, np.int64)[own], n[own], per, term.astype(np.int32), tf]
            counts = here + done, (n > 0).sum(), n.sum(), len(own), len(term)
            cols = [pa.array([int(x)], pa.int64()) for x in counts] + [pa.array([pa.compress(pack(x), "zstd", asbytes=True)], pa.binary()) for x in arrays]
            return pa.RecordBatch.from_arrays(cols, names=[*numbers, *packed])

        for b in batches:
            for i, t in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist()):
                ids.append(NULL_ID if i is None else i)
                texts.append(t)
                size += len(t or b"")
                if size >= BLOCK or len(ids) >= BLOCK_DOCS:
                    yield block()
                    ids, texts, size, done = [], [], 0, done + 1
        if ids:
            yield block()

    return run


def _column(value: bytes, n: int, dtype=np.int64) -> np.ndarray:
    return unpack(pa.decompress(value, n * np.dtype(dtype).itemsize, "zstd", asbytes=True), dtype) if n else np.zeros(0, dtype)


class Block:
    """Documents of a block: ids, numbers of terms, and sparse rows of (term, tf)."""

    def __init__(self, row: dict):
        raw = {c: pa.py_buffer(row[c]) for c in ("ids", "n", "size", "term", "tf")}
        counts = row["docs"], row["entries"]
        self.ids, self.n, size = (_column(raw[c], counts[0]) for c in ("ids", "n", "size"))
        self.term, self.tf = _column(raw["term"], counts[1], np.int32).astype(np.int64), _column(raw["tf"], counts[1])
        self.first = np.concatenate(([0], np.cumsum(size)))

    def values(self, items: Items) -> np.ndarray:
        """Of each entry, what a weight is multiplied with."""
        n = np.repeat(self.n, np.diff(self.first))
        if 50 * items.n * int(n.max(initial=0)) < 1 << 63:
            m = 50 + 50 * items.n * n // items.total
        else:
            m = np.array([50 + 50 * items.n * int(x) // items.total for x in n], np.int64)
        return 1_000_000_000 * self.tf // (1000 * self.tf + 20 * m)


def _df(items: Items):
    """(term, df): a task's documents by term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(items.vocabulary), np.int64)
        for row in _rows(batches):
            total += np.bincount(Block(row).term, minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["term", "df"])

    return run


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for b in batches:
        for k in range(b.num_rows):
            yield b.slice(k, 1).to_pylist()[0]


class Search:
    """One block against the items of a batch. ``least``: of each item, in the order of the items' tree, the score that
    a document must reach; ``visited`` counts the scores that were taken, of ``pairs`` in all."""

    def __init__(self, items: Items, block: Block, least: np.ndarray, k: int):
        self.items, self.tree, self.k = items, items.tree, k
        value = block.values(items)
        heavy = items.weight[block.term] > 0
        kept = np.concatenate(([0], np.cumsum(heavy)))
        self.ids = block.ids
        self.docs = Tree(kept[block.first], block.term[heavy], value[heavy], items.weight, LEAF_DOCS)
        self.least = least.copy()
        self.tops: list[list] = [[] for _ in items.ids]
        self.scratch = np.zeros(len(items.vocabulary), np.int64)
        self.column = np.zeros(len(items.vocabulary), np.int64)
        self.visited, self.pairs = 0, len(items.ids) * len(block.ids)

    def bounds(self, nodes: list[Node], docs: Node) -> np.ndarray:
        """Bounds of the scores below pairs of item nodes and ``docs``, whose maxima are in ``scratch``."""
        size = np.array([len(n.terms) for n in nodes])
        parts = np.concatenate([n.most for n in nodes]) * self.scratch[np.concatenate([n.terms for n in nodes])]
        over = np.concatenate(([0], np.cumsum(parts)))
        ends = np.cumsum(size)
        return over[ends] - over[ends - size]

    def open(self, nodes: list[Node], docs: Node) -> None:
        """The pairs of item nodes and ``docs`` that may hold a result."""
        self.scratch[docs.terms] = docs.most
        live = self.alive(nodes, docs)
        if docs.below:
            live = [x for n in live for x in n.below or (n,)]
            self.scratch[docs.terms] = 0
            if live:
                for half in sorted(docs.below, key=lambda d: -int(d.most.sum())):
                    self.open(live, half)
            return
        leaves = []
        while live:
            leaves += [n for n in live if not n.below]
            live = self.alive([x for n in live for x in n.below], docs)
        rows = np.concatenate([np.arange(n.lo, n.hi) for n in leaves]) if leaves else np.zeros(0, np.int64)
        at, begin = _gathered(self.items.first, self.tree.order[rows])
        if len(at):
            parts = self.items.weight[self.items.term[at]] * self.scratch[self.items.term[at]]
            over = np.concatenate(([0], np.cumsum(parts)))
            bound = over[np.append(begin[1:], len(at))] - over[begin]
            rows = rows[bound >= self.least[rows]]
        self.scratch[docs.terms] = 0
        if len(rows):
            self.score(rows, docs)

    def alive(self, nodes: list[Node], docs: Node) -> list[Node]:
        if not nodes:
            return []
        return [n for n, b in zip(nodes, self.bounds(nodes, docs).tolist()) if b >= self.least[n.lo : n.hi].min()]

    def score(self, rows: np.ndarray, docs: Node) -> None:
        """Scores of a leaf's documents for items (rows of the tree's order), into the top lists."""
        own = self.docs.order[docs.lo : docs.hi]
        self.column[docs.terms] = np.arange(1, len(docs.terms) + 1)
        at, begin = _gathered(self.docs.first, own)
        table = np.zeros((len(own), len(docs.terms) + 1), np.int64)
        table[np.repeat(np.arange(len(own)), np.diff(begin, append=len(at))), self.column[self.docs.term[at]]] = self.docs.value[at]
        at, begin = _gathered(self.items.first, self.tree.order[rows])
        term = self.items.term[at]
        over = np.zeros((len(own), len(at) + 1), np.int64)
        np.cumsum(table[:, self.column[term]] * self.items.weight[term], axis=1, out=over[:, 1:])
        scores = over[:, np.append(begin[1:], len(at))] - over[:, begin]
        self.column[docs.terms] = 0
        self.visited += scores.size
        d, i = np.nonzero(scores >= self.least[rows])
        for x, item, s in zip(own[d].tolist(), rows[i].tolist(), scores[d, i].tolist()):
            top = self.tops[item]
            entry = s, -int(self.ids[x]), x
            if len(top) < self.k:
                heapq.heappush(top, entry)
            elif entry > top[0]:
                heapq.heapreplace(top, entry)
            if len(top) == self.k and top[0][0] > self.least[item]:
                self.least[item] = top[0][0]

    def run(self) -> list[tuple[int, int, int]]:
        """(item, doc_id, score) of the block's top lists."""
        if len(self.ids) and self.items.ids:
            self.open([self.tree.root], self.docs.root)
        order = self.tree.order.tolist()
        return [(order[r], -i, s) for r, top in enumerate(self.tops) for s, i, _ in top]


def _promising(items: Items):
    """(item, bound, block): of each item, a task's block with the highest bound."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, where = np.full(len(items.ids), -1, np.int64), np.zeros(len(items.ids), np.int64)
        owner = np.repeat(np.arange(len(items.ids)), np.diff(items.first))
        for row in _rows(batches):
            block, most = Block(row), np.zeros(len(items.vocabulary), np.int64)
            np.maximum.at(most, block.term, block.values(items))
            bound = np.zeros(len(items.ids), np.int64)
            np.add.at(bound, owner, most[items.term] * items.weight[items.term])
            better = (bound > best) & (bound > 0)
            best[better], where[better] = bound[better], row["block"]
        at = np.flatnonzero(best > 0)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(best[at]), pa.array(where[at])], names=["item", "bound", "block"])

    return run


def _searched(items: Items, k: int, least: np.ndarray | None, only: dict[int, list[int]] | None):
    """(item, doc_id, score) of each block; ``only``: the items that a block is searched for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = items.tree.order
        for row in _rows(batches):
            start = np.ones(len(order), np.int64) if least is None else np.maximum(least[order], 1)
            if only is not None:
                start[~np.isin(order, only.get(row["block"], []))] = np.iinfo(np.int64).max
            found = Search(items, Block(row), start, k).run()
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (zip(*found) if found else ([], [], []))], names=["item", "doc_id", "score"])

    return run


def _best(found: DataFrame, k: int) -> DataFrame:
    """(item, rank, doc_id, score): first the best of each task's neighbourhood, then of these."""
    order = [F.desc("score"), F.asc("doc_id")]
    lane = found.withColumn("lane", F.spark_partition_id() % 64)
    near = lane.withColumn("r", F.row_number().over(Window.partitionBy("item", "lane").orderBy(*order))).filter(F.col("r") <= k)
    return near.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).filter(F.col("rank") <= k).select("item", "rank", "doc_id", "score")


def _batches(items: DataFrame) -> Iterator[list[tuple]]:
    """Rows (item_id, text) of distinct items, by hash into as many batches as keep each near ``ITEM_BYTES``."""
    size = F.coalesce(F.octet_length("text"), F.lit(0)) + 64
    sized = items.select("item_id", "text", size.alias("size"), F.xxhash64("item_id", "text").alias("key"))
    total, largest = sized.agg(F.coalesce(F.sum("size"), F.lit(0)), F.coalesce(F.max("size"), F.lit(0))).first()
    many = -(-total // ITEM_BYTES)
    while many > 1 and sized.groupBy(F.pmod("key", F.lit(many))).agg(F.sum("size").alias("size")).agg(F.max("size")).first()[0] > 2 * max(ITEM_BYTES, largest):
        many *= 2
    for b in range(many):
        yield [(r["item_id"], r["text"]) for r in sized.filter(F.pmod("key", F.lit(many)) == b).orderBy("key").select("item_id", "text").collect()]


def search(docs: DataFrame, items: DataFrame, k: int = 50, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): of each item the ``k`` best documents with a score above 0."""
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    asked = items.select(F.col(item_id).cast("long").alias("item_id"), F.col(item_text).alias("text")).distinct()
    out = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    columns = "block long, with_terms long, terms long, docs long, entries long, ids binary, n binary, size binary, term binary, tf binary"
    for batch in _batches(asked):
        own = read_items(batch)
        if not len(own.vocabulary):
            continue
        with short_batches(spark, 4):
            blocks = materialise(rows.mapInArrow(_index(own.vocabulary), columns), "blocks")
            own.n, own.total = (x or 0 for x in blocks.agg(F.sum("with_terms"), F.sum("terms")).first())
            df = np.zeros(len(own.vocabulary), np.int64)
            # a row for each term of the batch
            for r in blocks.mapInArrow(_df(own), "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
                df[r["term"]] = r["df"]
            own.weight = np.array([math.floor(1000 * math.log((2 * own.n + 2) / (2 * x + 1))) if x else 0 for x in df.tolist()], np.int64)
            start = _start(blocks, own, k)
            found = materialise(blocks.mapInArrow(_searched(own, k, start, None), "item long, doc_id long, score long"), "found")
        names = spark.createDataFrame([(i, x) for i, x in enumerate(own.ids)], "item long, item_id long")
        best = _best(found, k).join(names, "item").select("item_id", "rank", F.when(F.col("doc_id") != NULL_ID, F.col("doc_id")).alias("doc_id"), "score")
        out = out.unionByName(best)
    return out


def _start(blocks: DataFrame, items: Items, k: int) -> np.ndarray:
    """Of each item, the weakest of ``k`` scores in the block that bounds it highest; 0 if there are fewer. A row an item."""
    best = blocks.mapInArrow(_promising(items), "item long, bound long, block long").groupBy("item").agg(F.max_by("block", F.struct("bound", "block")).alias("block")).collect()
    only: dict[int, list[int]] = {}
    for r in best:
        only.setdefault(r["block"], []).append(r["item"])
    start = np.zeros(len(items.ids), np.int64)
    if only:
        chosen = blocks.join(blocks.sparkSession.createDataFrame([(b,) for b in only], "block long"), "block", "left_semi")
        found = chosen.mapInArrow(_searched(items, k, None, only), "item long, doc_id long, score long")
        for r in found.groupBy("item").agg(F.min("score").alias("score"), F.count("*").alias("n")).filter(F.col("n") >= k).collect():
            start[r["item"]] = r["score"]
    return start


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return search(read("documents"), read("benchmark"))


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
                  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS ts FROM documents),
t AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(ts) AS term FROM d) GROUP BY r, term),
s AS (SELECT count(*) FILTER (WHERE len(ts) > 0) AS n, CAST(sum(len(ts)) AS BIGINT) AS total FROM d),
w AS (SELECT term, CAST(floor(1000 * ln((2 * n + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM t, s GROUP BY term, n),
m AS (SELECT r, doc_id, 50 + (50 * len(ts) * n) // total AS m FROM d, s),
i AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+')) AS term FROM benchmark),
p AS (SELECT item_id, r, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
      FROM i JOIN t USING (term) JOIN w USING (term) JOIN m USING (r) GROUP BY item_id, r, doc_id),
k AS (SELECT item_id, doc_id, score, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM p WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM k WHERE rank <= 50
"""

QUERIES = {"op12_lexical_search": op12_lexical_search}
ORACLES = {"op12_lexical_search": SQL}
