"""N-gram Jaccard join by T-occurrence search (DivideSkip), as Spark jobs.

A document's set: its distinct word n-grams. Sets x, y with Jaccard J >= s share at least T grams, with T at
least ceil(s |x|) for either; so if x sets its L longest inverted lists aside, every partner appears in
T - L of its short lists at least. L is chosen so that T - L is |x| - T + 1. Both sides keep their short
lists only: the shuffle by gram merges and counts them, and pairs that reach T - L are verified by probing
the partner's sorted set (the long lists) with binary search.

Which lists are long is told by document frequencies over all documents, kept in ``1 << FREQ_BITS`` hashed
counters; they only order a set's grams (ties by gram), so collisions cost time, never links.

Documents with equal sets are one node. Within a list, a first round tests each node with one leader only; pairs
that these links join are never formed, so a tight group of near copies costs about its size, not its square.
Clusters that still hold several components are then searched whole, in blocks of a bounded number of grams: each
node outside the largest component asks the block's inverted lists (``Lists.search``), merging its short ones, probing
its long ones, for nodes of other components. A block returns no more links than join its components. No pair is
capped. Sets so small that only equal ones reach the Jaccard are nodes without lists.

A gram is a 64-bit fingerprint, and so is a set (with its size): sets of n documents are mistaken for equal
with a probability of about n**2 / 2**65.

Nulls and empties: without words or text the set is empty and links with nothing; with fewer words than n
the whole sequence is one gram. Null ids are kept: their component is the least id of the others, or null.
Repeated rows each get their row. Other columns are left alone.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.llm.common import added, bucket_count, components, materialise, named, numbered, pack, place, row_key, runs, unpack
from tablesync.llm.words import Words, grams, inside, mix

FREQ_BITS = 20
BLOCK = 8 << 20
CHUNKS = 64
PART_GRAMS = 1 << 20


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list]]:
    keys, texts, size = [], [], 0
    for b in batches:
        for k, t in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist()):
            keys.append(k)
            texts.append(t)
            size += len(t or b"")
            if size >= BLOCK:
                yield keys, texts
                keys, texts, size = [], [], 0
    if keys:
        yield keys, texts


def gram_sets(texts: list[bytes | None], n: int) -> tuple[np.ndarray, np.ndarray]:
    """All texts' sets, each sorted, one after another; and where each begins, with the end."""
    w = Words(texts)
    h = w.hashes(lower=True)
    at = inside(w.first, n)
    g, doc = grams(h, n)[at], w.doc[at]
    short = np.flatnonzero((w.counts > 0) & (w.counts < n))
    if len(short):
        few = [int(mix(np.array([grams(h[w.first[d] : w.first[d + 1]], int(w.counts[d]))[0] ^ np.uint64(w.counts[d])]))[0]) for d in short]
        g, doc = np.concatenate((g, np.array(few, np.uint64))), np.concatenate((doc, short))
    by = np.lexsort((g, doc))
    g, doc = g[by], doc[by]
    new = np.ones(len(g), bool)
    new[1:] = (g[1:] != g[:-1]) | (doc[1:] != doc[:-1])
    g, doc = g[new], doc[new]
    return g, np.searchsorted(doc, np.arange(len(texts) + 1))


def set_prints(g: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A fingerprint of each set, from a sum over its grams and its size."""
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(g ^ np.uint64(0x5DEECE66D1234567)))))
    return mix((total[first[1:]] - total[first[:-1]]) ^ (np.diff(first).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))).view(np.int64)


def _frequencies(n: int):
    """Documents for each hashed counter, in chunks; copies inside a block count once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << FREQ_BITS, np.int64)
        for _, texts in _blocks(batches):
            g, _ = gram_sets(texts, n)
            total += np.bincount((g >> np.uint64(64 - FREQ_BITS)).astype(np.int64), minlength=len(total))
        if total.any():
            each = total.reshape(CHUNKS, -1)
            yield pa.RecordBatch.from_arrays([pa.array(range(CHUNKS), pa.int32()), pa.array([pack(x) for x in each], pa.binary())], names=["chunk", "counts"])

    return run


def _add(table: pa.Table) -> pa.Table:
    total = sum(unpack(x, np.int64) for x in table.column("counts").to_pylist())
    return pa.table({"chunk": table.column("chunk").slice(0, 1), "counts": pa.array([pack(total)], pa.binary())})


def _short_lists(n: int, num: int, den: int, buckets: int, freq_of):
    """Rows of two kinds: one a document (bucket null), and packed short lists for each bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        freq = freq_of.value
        schema = pa.schema([("bucket", pa.int32()), ("row_key", pa.int64()), ("node", pa.int64()), ("size", pa.int64()), ("gram", pa.binary()), ("nodes", pa.binary()), ("sizes", pa.binary()), ("many", pa.binary())])
        none = pa.nulls
        for keys, texts in _blocks(batches):
            g, first = gram_sets(texts, n)
            size, node = np.diff(first), set_prints(g, first)
            k = len(keys)
            yield pa.RecordBatch.from_arrays([none(k, pa.int32()), pa.array(keys, pa.int64()), pa.array(node), pa.array(size.astype(np.int64)), *(none(k, pa.binary()) for _ in range(4))], schema=schema)
            _, once = np.unique(node, return_index=True)
            # beside copies of itself, a set's nearest possible partner has one gram more
            once = np.sort(once[(size[once] > 0) & (den * size[once] >= num * (size[once] + 1))])
            if not len(once):
                continue
            kept = np.zeros(k, bool)
            kept[once] = True
            doc = np.repeat(np.arange(k), size)
            g, doc = g[kept[doc]], doc[kept[doc]]
            by = np.lexsort((g, freq[(g >> np.uint64(64 - FREQ_BITS)).astype(np.int64)], doc))
            g = g[by]
            begin = np.searchsorted(doc, doc)
            s = size[doc]
            short = np.arange(len(g)) - begin < 2 * (s - (-(-num * s // den))) + 1
            g, doc = g[short], doc[short]
            bucket = ((mix(g) >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
            by = np.argsort(bucket, kind="stable")
            bounds = np.searchsorted(bucket[by], np.arange(buckets + 1))
            for b in range(buckets):
                one = by[bounds[b] : bounds[b + 1]]
                if len(one):
                    r = runs(doc[one])
                    d = doc[one][r]
                    yield pa.RecordBatch.from_pydict({"bucket": [b], "row_key": [None], "node": [None], "size": [None], "gram": [g[one].tobytes()], "nodes": [node[d].tobytes()], "sizes": [pack(size[d].astype(np.int64))], "many": [pack(np.diff(r, append=len(one)).astype(np.int32))]}, schema=schema)

    return run


def _merge(table: pa.Table) -> pa.Table:
    """(list, node, size, weight) of the lists with more than one node; equal lists are one, with a weight."""
    got: list[list] = [[], [], []]
    for r in table.to_pylist():
        many = unpack(r["many"], np.int32)
        got[0].append(np.frombuffer(r["gram"], np.uint64))
        got[1].append(np.repeat(np.frombuffer(r["nodes"], np.int64), many))
        got[2].append(np.repeat(unpack(r["sizes"], np.int64), many))
    g, node, size = (np.concatenate(x) for x in got)
    by = np.lexsort((node, g))
    g, node, size = g[by], node[by], size[by]
    new = np.ones(len(g), bool)
    new[1:] = (g[1:] != g[:-1]) | (node[1:] != node[:-1])
    g, node, size = g[new], node[new], size[new]
    same = g[1:] == g[:-1]
    more = np.zeros(len(g), bool)
    more[1:] |= same
    more[:-1] |= same
    g, node, size = g[more], node[more], size[more]
    r = runs(g)
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(node.view(np.uint64)))))
    end = np.concatenate((r[1:], [len(g)])).astype(np.int64)
    name = total[end] - total[r]
    _, first, weight = np.unique(name, return_index=True, return_counts=True)
    times = np.zeros(len(r), np.int64)
    times[first] = weight
    times = np.repeat(times, end - r)
    keep = times > 0
    return pa.table({"list": pa.array(np.repeat(name, end - r)[keep].view(np.int64)), "node": pa.array(node[keep]), "size": pa.array(size[keep]), "weight": pa.array(times[keep])})


def _verify(num: int, den: int):
    """Pairs (a, b) whose sets reach the overlap: probes the smaller set's grams in the larger one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, keep = batch.column(0), batch.column(1), []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                if len(x) > len(y):
                    x, y = y, x
                hit = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
                keep.append(den * hit >= num * (len(x) + len(y) - hit))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([a.filter(mask), b.filter(mask)], names=["a", "b"])

    return run


def _sets(n: int):
    """Each node's sorted set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for node, texts in _blocks(batches):
            g, first = gram_sets(texts, n)
            yield pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array([g[i:j].tobytes() for i, j in zip(first[:-1], first[1:])], pa.binary())], names=["node", "grams"])

    return run


class Lists:
    """Inverted lists of some sets: ``keys`` holds (list, set) as one number, sorted."""

    def __init__(self, sets: list[np.ndarray]):
        self.n, self.size = len(sets), np.array([len(x) for x in sets], np.int64)
        g, own = np.concatenate(sets), np.repeat(np.arange(self.n), self.size)
        by = np.lexsort((own, g))
        new = np.concatenate(([True], g[by][1:] != g[by][:-1]))
        number = np.cumsum(new) - 1
        self.sets, self.start = own[by], np.flatnonzero(new)
        self.length = np.diff(self.start, append=len(g))
        self.keys = number * self.n + self.sets
        of = np.empty(len(g), np.int64)
        of[by] = number
        self.of = np.split(of, np.cumsum(self.size)[:-1])

    def search(self, i: int, num: int, den: int, wanted: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        """Of the other sets that are ``wanted``, those that reach the Jaccard with set ``i``, by DivideSkip.

        Set i shares T grams with each. Its short lists are merged and their occurrences counted; sets that
        reach T less the number of long lists are looked up in these by binary search. The work is that of the short
        lists' lengths, whatever the number of sets.
        """
        size, lists = int(self.size[i]), self.of[i]
        t = -(-num * size // den)
        lists = lists[np.argsort(self.length[lists], kind="stable")]
        short, long = lists[: 2 * (size - t) + 1], lists[2 * (size - t) + 1 :]
        many = self.length[short]
        at = np.repeat(self.start[short] - (np.cumsum(many) - many), many) + np.arange(many.sum())
        found, hit = np.unique(self.sets[at], return_counts=True)
        fits = (hit >= max(t - len(long), 1)) & (found != i) & (den * np.minimum(self.size[found], size) >= num * np.maximum(self.size[found], size))
        found, hit = found[fits], hit[fits]
        own = wanted(found)
        found, hit = found[own], hit[own]
        if len(long) and len(found):
            probe = long[:, None] * self.n + found[None]
            hit = hit + (self.keys[np.minimum(np.searchsorted(self.keys, probe), len(self.keys) - 1)] == probe).sum(0)
        return found[den * hit >= num * (size + self.size[found] - hit)]


def _search(num: int, den: int):
    """Between two parts of a cluster (or in one): links that join components, which at most join all its nodes."""

    def run(table: pa.Table) -> pa.Table:
        node, label, part = (table.column(c).to_numpy() for c in ("node", "component", "part"))
        same = table.column("low")[0].as_py() == table.column("high")[0].as_py()
        lists = Lists([np.frombuffer(x.as_buffer(), np.uint64) for x in table.column("grams")])
        _, comp = np.unique(label, return_inverse=True)
        inside = np.split(np.argsort(comp, kind="stable"), np.cumsum(np.bincount(comp))[:-1])
        # a link of two components has an end outside the largest one, from which it is found
        largest = max(range(len(inside)), key=lambda c: len(inside[c]))
        a, b = [], []
        for i in np.flatnonzero(comp != largest).tolist():
            for j in lists.search(i, num, den, lambda x: (comp[x] != comp[i]) & (same | (part[x] != part[i]))):
                if comp[j] != comp[i]:
                    a.append(node[i])
                    b.append(node[j])
                    less, more = sorted((comp[i], comp[j]), key=lambda c: len(inside[c]))
                    comp[inside[less]] = more
                    inside[more] = np.concatenate((inside[more], inside[less]))
        a, b = np.array(a, np.int64), np.array(b, np.int64)
        return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    return run


def ngram_join(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, row_key, n_shingles, component_id, part): near duplicates where den * |x and y| >= num * |x or y|.

    ``row_key`` names the row by id and text; ``component_id`` is the smallest id reachable by links, ``part``
    a name of its group that also tells apart groups without an id.
    """
    spark = docs.sparkSession
    keyed = docs.select(F.col(doc_id).cast("long").alias("doc_id"), row_key(doc_id, text).alias("row_key"), F.col(text).alias("text"))
    own = keyed.select("row_key", "text")
    counts = added(own.mapInArrow(_frequencies(n), "chunk int, counts binary"), ["chunk"], _add).collect()
    freq = np.zeros((CHUNKS, (1 << FREQ_BITS) // CHUNKS), np.int64)
    for r in counts:
        freq[r["chunk"]] = unpack(bytes(r["counts"]), np.int64)
    freq_of = spark.sparkContext.broadcast(np.minimum(freq.reshape(-1), (1 << 31) - 1).astype(np.int32))

    buckets = bucket_count(docs, text, BLOCK)
    schema = "bucket int, row_key long, node long, size long, gram binary, nodes binary, sizes binary, many binary"
    made = materialise(own.mapInArrow(_short_lists(n, num, den, buckets, freq_of), schema), "short-lists")
    rows = made.filter("bucket IS NULL").select("row_key", "node", "size").distinct()
    merged = made.filter("bucket IS NOT NULL").select("bucket", "gram", "nodes", "sizes", "many").groupBy("bucket").applyInArrow(_merge, "list long, node long, size long, weight long")
    lists = merged.groupBy("list", "node", "size").agg(F.sum("weight").alias("weight"))
    least = lambda size: F.expr(f"({num} * {size} + {den - 1}) div {den}")  # noqa: E731  T of a set
    need = lambda size: F.col(size) - least(size) + 1  # noqa: E731  T - L of a set
    # short lists that a set shares with any other, all counted: its smallest partner needs as many
    enough = lists.groupBy("node", "size").agg(F.sum("weight").alias("all")).withColumn("low_size", least("size")).filter(F.col("all") >= need("low_size")).select("node")
    lists = materialise(lists.join(enough, "node"), "lists")

    # one row of each node that has a candidate, and from its text the set to verify with
    wanted = lists.select("node").distinct()
    one = rows.join(wanted, "node", "left_semi").groupBy("node").agg(F.min("row_key").alias("row_key"))
    texts = keyed.select("row_key", "text").join(one, "row_key").select("node", "text")
    sets = materialise(texts.mapInArrow(_sets(n), "node long, grams binary").dropDuplicates(["node"]), "sets")

    def verified(pairs: DataFrame) -> DataFrame:
        x, y = sets.select(F.col("node").alias("a"), F.col("grams").alias("x")), sets.select(F.col("node").alias("b"), F.col("grams").alias("y"))
        return materialise(pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(_verify(num, den), "a long, b long"), "links")

    lead = lists.groupBy("list").agg(F.min("node").alias("a"), F.min_by("size", "node").alias("lead_size"))
    fits = (den * F.least("size", "lead_size") >= num * F.greatest("size", "lead_size")) & (F.col("node") != F.col("a"))
    seen = lists.join(lead, "list").filter(fits).withColumn("low_size", F.least("size", "lead_size")).select("a", F.col("node").alias("b"), "low_size", "weight")
    often = lambda pairs: pairs.groupBy("a", "b", "low_size").agg(F.sum("weight").alias("have")).filter(F.col("have") >= need("low_size")).select("a", "b")
    stars = materialise(often(seen), "stars")
    links = verified(stars)
    # nodes that share a list share its leader's cluster; a large cluster is compared block by block
    clusters = materialise(lists.join(lead.select("list", F.col("a").alias("lead")), "list").select("lead", "node", "size").distinct(), "clusters")
    tagged = clusters.join(components(links), "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed = tagged.groupBy("lead").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.ceil(F.sum("size") / PART_GRAMS).cast("int").alias("parts")).filter("lo <> hi").select("lead", "parts")
    dealt = tagged.join(mixed, "lead").withColumn("part", F.pmod(F.xxhash64("node"), "parts").cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    blocks = dealt.join(sets, "node").select("lead", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"), "part", "node", "component", "grams")
    links = links.union(materialise(blocks.groupBy("lead", "low", "high").applyInArrow(_search(num, den), "a long, b long"), "links"))
    labels = components(links)

    joined = rows.join(labels, "node", "left").select("row_key", "size", F.coalesce("component", "node").alias("component"))
    every = keyed.select("doc_id", "row_key").join(joined, "row_key")
    # an empty set links with nothing, so each such row stands alone
    lone = F.col("size") == 0
    least = every.filter(~lone).groupBy("component").agg(F.min("doc_id").alias("component_id"))
    out = every.join(least, "component", "left")
    return out.select("doc_id", "row_key", F.col("size").alias("n_shingles"), F.when(lone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"), F.when(lone, F.col("row_key")).otherwise(F.col("component")).alias("part"))


def keep_one(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each group of near duplicates: that of the least id (null last), then key."""
    groups = ngram_join(docs, n, num, den, doc_id, text)
    first = groups.groupBy("part").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_key")).alias("first"))
    kept = first.select(F.col("first.row_key").alias("__row_key"))
    keyed = numbered(docs).withColumn("__row_key", row_key(place(docs, doc_id), place(docs, text)))
    return keyed.join(kept, "__row_key", "left_semi").dropDuplicates(["__row_key"]).select(*named(docs))


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return ngram_join(docs, n=3, num=90, den=100).drop("row_key", "part")


SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '^$', ''), '[^ \t\n\x0B\f\r]+') AS ws FROM documents),
sh AS (SELECT DISTINCT doc_id, g FROM (
  SELECT doc_id, array_to_string(list_slice(ws, i, i + 2), ' ') AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) >= 3)
  UNION ALL SELECT doc_id, array_to_string(ws, ' ') FROM w WHERE len(ws) BETWEEN 1 AND 2)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM sh a JOIN sh b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT p.a, p.b FROM p JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b WHERE 100 * k >= 90 * (x.n + y.n - k)),
r AS (SELECT doc_id, doc_id AS c FROM n UNION SELECT r.doc_id, l.b FROM r JOIN l ON l.a = r.c)
SELECT w.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, coalesce(m.c, w.doc_id) AS component_id
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT doc_id, min(c) AS c FROM r GROUP BY doc_id) m USING (doc_id)
"""

QUERIES = {"op9_ngram_join": op9_ngram_join}
ORACLES = {"op9_ngram_join": SQL}
