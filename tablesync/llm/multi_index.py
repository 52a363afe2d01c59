"""Embedding near-dedup over an inverted multi-index.

A unit vector's halves are quantised by a codebook each, trained on a bounded sample; the two codes name a
cell of the product grid. A half of q is nearer to code c' than to c by ``(|q - c|**2 - |q - c'|**2) / (2 |c - c'|)``
along the line between them, so no half in the cell of c is nearer to it than the greatest of these over c'.
A vector visits cells in the order of multi-sequence traversal, that is by the growing sum of both halves'
squared bounds, up to ``2 - 2 least``: no link lies in a cell beyond, so none is missed. As the bound holds from
either side, only one of two cells visits the other. Each candidate is verified in double precision.

Codebooks have as many codes as let a vector visit ``VISITS`` cells in the mean of a sample, 4 at least. Where
vectors are spread so evenly that bounds leave most cells, the codes are few and the pairs compared grow with
the square of a label's distinct vectors.

Only equal, non-null labels are compared. Equal vectors of a label are one node with a multiplicity. A cell's
vectors are dealt to blocks of bounded size, and visitors to a few groups each; a task gets one block and
one group and returns counts and a star of links for each component, never the pairs.

Nulls and empties: a null, empty or zero vector, or one with null or non-finite components, or one without
a label links with nothing; null ids are kept (component null, kept true). Vectors of unlike length are
never compared. Rows with the same id are one node of the components. Other columns are left alone.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.llm.common import components, materialise

SAMPLE = 8192
PROBED = 256
VISITS = 32
BLOCK = 2048
GROUP = 8192


def _matrix(column) -> np.ndarray:
    """Rows of doubles from a list column without nulls, all of one length."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.asarray(column.flatten(), np.float64).reshape(len(column), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    top = np.abs(x).max(1, keepdims=True)
    x = x / np.where(top > 0, top, 1)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def kmeans(x: np.ndarray, k: int, rounds: int = 8, seed: int = 1) -> np.ndarray:
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        own = _squares(x, c).argmin(1)
        n = np.bincount(own, minlength=len(c))
        total = np.zeros_like(c)
        np.add.at(total, own, x)
        c[n > 0] = total[n > 0] / n[n > 0, None]
    return c


def _squares(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return (x * x).sum(1)[:, None] + (c * c).sum(1)[None] - 2 * x @ c.T


def traverse(a: list[float], b: list[float], reach: float) -> list[tuple[int, int]]:
    """Places (i, j) of two sorted lists by growing a[i] + b[j], up to ``reach``.

    A place waits until both places before it are done, so few wait at a time.
    """
    out: list[tuple[int, int]] = []
    done = [-1] * len(a)  # the last j done in each row
    waiting = [(a[0] + b[0], 0, 0)]
    while waiting and waiting[0][0] <= reach:
        _, i, j = heapq.heappop(waiting)
        out.append((i, j))
        done[i] = j
        if i + 1 < len(a) and (j == 0 or done[i + 1] >= j - 1) and done[i + 1] < j:
            heapq.heappush(waiting, (a[i + 1] + b[j], i + 1, j))
        if j + 1 < len(b) and (i == 0 or done[i - 1] >= j + 1):
            heapq.heappush(waiting, (a[i] + b[j + 1], i, j + 1))
    return out


class Grid:
    """Two codebooks, and how far traversal goes: cells of a squared distance of at least ``reach`` are left out."""

    def __init__(self, first: np.ndarray, second: np.ndarray, reach: float):
        self.codes, self.reach = (first, second), reach
        self.gaps = []
        for code in self.codes:
            gap = 2 * np.sqrt(((code[:, None] - code[None]) ** 2).sum(2))
            self.gaps.append(np.where(gap > 1e-6, gap, np.inf))  # codes so near bound nothing

    def bounds(self, unit: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """For each half: its code, and the least squared distance that a vector of every code's cell can have."""
        h = unit.shape[1] // 2
        own, least = [], []
        for half, code, gap in zip((unit[:, :h], unit[:, h:]), self.codes, self.gaps):
            d = _squares(half, code)
            low = np.zeros_like(d)
            for c in range(len(code)):
                np.maximum(low, (d - d[:, c : c + 1]) / gap[c], out=low)
            own.append(d.argmin(1))
            least.append(low**2)
        return own, least

    def cells(self, own: list[np.ndarray], least: list[np.ndarray], row: int) -> tuple[np.ndarray, np.ndarray]:
        """Cells that a vector visits, nearest first, by multi-sequence traversal; it ends at ``reach``."""
        a, b = least[0][row], least[1][row]
        i, j = np.argsort(a, kind="stable"), np.argsort(b, kind="stable")
        steps = np.array(traverse(a[i].tolist(), b[j].tolist(), self.reach), np.int64).reshape(-1, 2)
        i, j = i[steps[:, 0]], j[steps[:, 1]]
        cell, mine = i * len(self.codes[1]) + j, own[0][row] * len(self.codes[1]) + own[1][row]
        # of two cells one visits the other: the higher number where their sum is even, else the lower
        take = (cell == mine) | ((cell < mine) == ((cell + mine) % 2 == 0))
        return i[take], j[take]


def fit_grid(vectors: DataFrame, least: float, most_codes: int = 256) -> Grid:
    """Codebooks from ``SAMPLE`` vectors; their size is halved until ``PROBED`` of these visit few enough cells."""
    n = vectors.count()
    sample = vectors.orderBy(F.xxhash64("node", F.lit(1)), "node").limit(SAMPLE).select("v").toArrow()
    unit = _unit(_matrix(sample.column("v")))
    k, h = int(min(most_codes, max(4, round((n / 8) ** 0.5)))), unit.shape[1] // 2
    while True:
        grid = Grid(kmeans(unit[:, :h], k), kmeans(unit[:, h:], k, seed=2), 2 - 2 * least + 1e-6)
        own, low = grid.bounds(unit[:PROBED])
        if k == 4 or np.mean([len(grid.cells(own, low, r)[0]) for r in range(len(own[0]))]) <= VISITS:
            return grid
        k = max(4, k // 2)


def _place(grid_of):
    """For each vector a row for its own cell and one for every other cell it visits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grid: Grid = grid_of.value
        for batch in batches:
            for lo in range(0, batch.num_rows, 128):
                b = batch.slice(lo, 128)
                unit = _unit(_matrix(b.column(3)))
                own, least = grid.bounds(unit)
                row, i, j = [], [], []
                for r in range(len(unit)):
                    x, y = grid.cells(own, least, r)
                    row.append(np.full(len(x), r))
                    i.append(x)
                    j.append(y)
                row, i, j = (np.concatenate(x).astype(np.int64) for x in (row, i, j))
                home = (i == own[0][row]) & (j == own[1][row])
                take = lambda c: b.column(c).take(pa.array(row))
                width = len(grid.codes[1])
                yield pa.RecordBatch.from_arrays(
                    [take(1), pa.array((i * width + j).astype(np.int32)), pa.array(home), take(0), take(2), pa.array([u.tobytes() for u in unit], pa.binary()).take(pa.array(row))],
                    names=["label", "cell", "home", "node", "many", "unit"],
                )

    return run


def _search(least: float):
    """Counts of links and a star of each component, between one block of a cell and one group of visitors."""

    def run(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
        empty = pa.table({"node": pa.array([], pa.int64()), "links": pa.array([], pa.int64()), "to": pa.array([], pa.int64())})
        if not len(left) or not len(right):
            return empty
        read = lambda t: np.frombuffer(b"".join(t.column("unit").to_pylist()), np.float64).reshape(len(t), -1)
        col = lambda t, c: t.column(c).to_numpy()
        x, node, many = read(left), col(left, "node"), col(left, "many")
        count, low, out = np.zeros(len(x), np.int64), node.copy(), []
        for lo in range(0, len(right), 1024):
            part = right.slice(lo, 1024)
            q, qn, qm, home = read(part), col(part, "node"), col(part, "many"), col(part, "home")
            hit = (q @ x.T >= least) & (qn[:, None] != node[None])
            i, j = np.nonzero(hit)
            # a visitor from elsewhere, whose own cell this vector does not visit: count for this side too
            alone = ~home[i]
            np.add.at(count, j[alone], qm[i[alone]])
            got = hit @ many
            qlow = qn.copy()
            while True:
                before = qlow.sum(dtype=object), low.sum(dtype=object)
                np.minimum.at(qlow, i, low[j])
                np.minimum.at(low, j, qlow[i])
                if (qlow.sum(dtype=object), low.sum(dtype=object)) == before:
                    break
            any_ = hit.any(1)
            met = hit.any(0)
            # each step's star joins its links; a label that falls in a later step does not undo it
            out += [(qn[any_], got[any_], qlow[any_]), (node[met], np.zeros(met.sum(), np.int64), low[met])]
        out.append((node[count > 0], count[count > 0], low[count > 0]))
        node, links, to = (np.concatenate(c) for c in zip(*out))
        return pa.table({"node": pa.array(node.astype(np.int64)), "links": pa.array(links.astype(np.int64)), "to": pa.array(to.astype(np.int64))})

    return run


def near_duplicates(rows: DataFrame, least: float = 0.93, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label") -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row."""
    spark = rows.sparkSession
    v = F.col(embedding)
    fine = F.col(label).isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    base = rows.select(F.col(vec_id).cast("long").alias("vec_id"), F.when(fine, F.xxhash64(F.col(label), v)).alias("node"), F.col(label).alias("label"), v.cast("array<double>").alias("v"))
    base = materialise(base, "vectors")
    nodes = base.filter("node IS NOT NULL").groupBy("node").agg(F.first("label").alias("label"), F.count("*").alias("many"), F.first("v").alias("v"))
    nodes = materialise(nodes, "nodes")
    found = []
    for size in sorted(r[0] for r in nodes.select(F.size("v")).distinct().collect()):
        own = nodes.filter(F.size("v") == size)
        if size == 1:  # halves need two components
            own = own.withColumn("v", F.concat("v", F.array(F.lit(0.0))))
        grid_of = spark.sparkContext.broadcast(fit_grid(own, least))
        kind = nodes.schema["label"].dataType.simpleString()
        placed = materialise(own.select("node", "label", "many", "v").mapInArrow(_place(grid_of), f"label {kind}, cell int, home boolean, node long, many long, unit binary"), "placed")
        sizes = placed.groupBy("label", "cell").agg(F.ceil(F.count_if("home") / BLOCK).cast("int").alias("blocks"), F.ceil(F.count("*") / GROUP).cast("int").alias("groups")).filter("blocks > 0")
        dealt = placed.join(sizes, ["label", "cell"])
        at = lambda n, seed: F.pmod(F.xxhash64("node", F.lit(seed)), F.col(n)).cast("int")
        upto = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        keys = ["label", "cell", "block", "group"]
        left = dealt.filter("home").withColumn("block", at("blocks", 1)).withColumn("group", upto("groups")).select(*keys, "node", "many", "unit")
        right = dealt.withColumn("group", at("groups", 2)).withColumn("block", upto("blocks")).select(*keys, "node", "many", "unit", "home")
        right = right.select(*(F.col(c).alias(c) for c in right.columns))
        got = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_search(least), "node long, links long, to long")
        found.append(materialise(got, "links"))
    links = spark.createDataFrame([], "node long, links long, to long") if not found else found[0]
    for f in found[1:]:
        links = links.union(f)
    # each row's id stands for it; equal vectors and linked nodes reach each other through their node
    labels = components(links.select(F.col("node").alias("a"), F.col("to").alias("b")))
    per_node = nodes.select("node", "many").join(links.groupBy("node").agg(F.sum("links").alias("links")), "node", "left").join(labels, "node", "left").select("node", (F.coalesce("links", F.lit(0)) + F.col("many") - 1).alias("links"), F.coalesce("component", "node").alias("part"))
    every = base.select("vec_id", "node").join(per_node, "node", "left")
    least_id = materialise(every.filter("part IS NOT NULL").groupBy("part").agg(F.min("vec_id").alias("low")), "least")
    # ids that come in several parts join them
    again = every.filter("part IS NOT NULL AND vec_id IS NOT NULL").join(least_id, "part").select(F.col("vec_id").alias("a"), F.col("low").alias("b"))
    ids = components(again)
    out = every.join(ids.select(F.col("node").alias("vec_id"), "component"), "vec_id", "left")
    out = out.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op4_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label"))


SQL = r"""
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
r AS (SELECT DISTINCT a AS vec_id, a AS c FROM l UNION SELECT r.vec_id, l.b FROM r JOIN l ON l.a = r.c),
n AS (SELECT a AS vec_id, count(*) AS n FROM l GROUP BY a), m AS (SELECT vec_id, min(c) AS c FROM r GROUP BY vec_id)
SELECT e.vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, coalesce(m.c, e.vec_id) AS component_id, coalesce(m.c, e.vec_id) = e.vec_id AS kept
FROM embeddings e LEFT JOIN n USING (vec_id) LEFT JOIN m USING (vec_id)
"""

QUERIES = {"op4_embedding_near_dedup": op4_embedding_near_dedup}
ORACLES = {"op4_embedding_near_dedup": SQL}
