"""Exact top-k search by inner product: a distributed M-tree, searched best first.

Inner products become distances: with M the greatest norm, x is extended by sqrt(M**2 - |x|**2) and a query
by 0, so the squared distance is |q|**2 + M**2 - 2 q.x, and the nearest are those with the highest product.

The tree grows from the top: a node with more than ``BLOCK`` vectors promotes up to ``FANOUT`` of them, each
vector goes to the nearest, and each entry keeps its distance to the parent object and its covering radius;
so the depth follows the number of vectors. A leaf holds pages around promoted vectors, whose entries are
sorted by their stored distance to the page's object. Vectors that no distance tells apart are dealt to
several leaves of one object.

Queries go down level by level. The first time each follows its nearest entries to ``BEAM`` leaves, whose k-th
best score is its floor. The second time it visits every leaf that the floor leaves: the stored distance to the
parent rules entries out before any distance is computed, then the distance less the radius does. In a leaf
all queries of a group move together, each through its own pages, nearest first, with a limit that tightens
as it goes; of a page only the ring that the triangle inequality leaves is scored. Bounds only prune
strictly, so ties stay; scores are integers and exact.

A task gets one leaf and one group of queries, and leaves go only to groups that visit them. Where distances
hardly differ, as among random vectors of many components, an exact search visits each leaf with each query.

Nulls and empties: vectors that are null or empty or hold null or non-finite components, or have a null id,
take no part. A vector shorter than another counts as if padded with zeros. Repeated rows are candidates of
their own; a query id that repeats is asked once for each distinct vector it has, and each takes its k best.
If the greatest norms allow a score of 2**63 or more, which no long holds, the call raises.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablesync.llm.common import materialise

FANOUT = 64
BLOCK = 4096
PAGE = 64
GROUP = 8192
BEAM = 2
DEPTH = 10
#: Rows of a node that one task routes.
ROUTED = 1 << 16
ASK = "qkey long, query_id long, v array<long>, floor double, cell long, up double"


def _matrix(column, width: int) -> np.ndarray:
    """Rows of a list column, padded with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    flat, many = column.flatten().to_numpy(zero_copy_only=False), column.value_lengths().to_numpy(zero_copy_only=False)
    if len(many) and (many == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(many), width), np.int64)
    out[np.arange(width)[None] < many[:, None]] = flat
    return out


def _extend(x: np.ndarray, square: float) -> np.ndarray:
    """Candidates as points of one distance to the origin."""
    x = x.astype(np.float64)
    return np.concatenate((x, np.sqrt(np.maximum(square - (x * x).sum(1), 0))[:, None]), 1)


def _point(q: np.ndarray) -> np.ndarray:
    return np.concatenate((q.astype(np.float64), np.zeros((len(q), 1))), 1)


def _far(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances by one product; ``reach`` allows for their error."""
    return np.sqrt(np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * a @ b.T, 0))


def reach(base: np.ndarray, low: np.ndarray) -> np.ndarray:
    """How far a vector of at least the score ``low`` can be; ``base`` is |q|**2 + M**2."""
    far = np.sqrt(np.maximum(base - 2 * np.where(np.isfinite(low), low, 0), 0)) * (1 + 1e-9) + 2e-6 * np.sqrt(base)
    return np.where(np.isfinite(low), far, np.inf)


def _route(square: float, width: int):
    """A share of a node's vectors, each with the nearest of the node's promoted ones."""

    def run(key: tuple[pa.Scalar, ...], rows: pa.Table, heads: pa.Table) -> pa.Table:
        h = _extend(_matrix(heads.column("v"), width), square)
        child, own, far = heads.column("child").to_numpy(), [], []
        for lo in range(0, len(rows), 4096):
            d = _far(_extend(_matrix(rows.column("v").slice(lo, 4096), width), square), h)
            own.append(d.argmin(1))
            far.append(d.min(1))
        own, far = np.concatenate([np.zeros(0, np.int64), *own]), np.concatenate([np.zeros(0), *far])
        return pa.table({"vec_id": rows.column("vec_id"), "v": rows.column("v"), "cell": pa.array(child[own]), "far": pa.array(far)})

    return run


def _leaf(square: float, width: int):
    """One leaf: pages around promoted vectors, entries with their distances to these."""

    def run(key: tuple[pa.Scalar, ...], rows: pa.Table, head: pa.Table) -> pa.Table:
        out = []
        if len(rows):
            ids, v = rows.column("vec_id").to_numpy(), _matrix(rows.column("v"), width)
            x, parent = _extend(v, square), _extend(_matrix(head.column("v").slice(0, 1), width), square)
            heads = x[np.random.default_rng(len(ids)).choice(len(x), max(1, len(x) // PAGE), replace=False)]
            d = _far(x, heads)
            own, far = d.argmin(1), d.min(1)
            by = np.lexsort((far, own))
            used, first = np.unique(own[by], return_index=True)
            first = np.append(first, len(by))
            node = {"heads": heads[used], "up": _far(heads[used], parent)[:, 0], "radius": far[by][first[1:] - 1], "first": first, "v": v[by], "ids": ids[by], "far": far[by]}
            out.append((key[0].as_py(), key[1].as_py(), pickle.dumps(node)))
        return pa.table([pa.array([o[n] for o in out], t) for n, t in enumerate((pa.int64(), pa.int32(), pa.binary()))], names=["cell", "block", "node"])

    return run


def best_of(row: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each row the k highest scores, ties to smaller ids; and their ranks from 0."""
    by = np.lexsort((ids, -score, row))
    row, score, ids = row[by], score[by], ids[by]
    at = np.arange(len(row))
    new = np.ones(len(row), bool)
    new[1:] = row[1:] != row[:-1]
    rank = at - np.maximum.accumulate(np.where(new, at, 0))
    keep = rank < k
    return row[keep], score[keep], ids[keep], rank[keep]


def search_leaf(node: dict, q: np.ndarray, own: np.ndarray, up: np.ndarray, base: np.ndarray, floor: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query's row, score, id) of a leaf's k best for each query; ``up``: distances to the leaf's object.

    ``floor``: a score known to be the query's k-th best at least, or NaN.
    """
    low = np.where(np.isnan(floor), -np.inf, floor)
    limit = reach(base, low)
    # before any distance to a page's object: what the stored distances to the leaf's object allow
    bound = np.abs(up[:, None] - node["up"][None]) - node["radius"][None]
    d, some = np.zeros(bound.shape), np.flatnonzero((bound <= limit[:, None]).any(0))
    d[:, some] = _far(_point(q), node["heads"][some])
    bound = np.where(bound <= limit[:, None], np.maximum(bound, d - node["radius"][None]), np.inf)
    order = np.argsort(bound, 1, kind="stable")
    best = (np.zeros(0, np.int64), np.zeros(0, q.dtype), np.zeros(0, np.int64))
    at, step = 0, 1
    while at < order.shape[1]:
        pages = order[:, at : at + step]
        row, c = np.nonzero(np.take_along_axis(bound, pages, 1) <= limit[:, None])
        if not len(row):
            break
        page = pages[row, c]
        by = np.argsort(page, kind="stable")
        row, page = row[by], page[by]
        cut = np.flatnonzero(np.diff(page, prepend=-1))
        got = [best]
        for i, j in zip(cut, [*cut[1:], len(page)]):
            r, p = row[i:j], page[i]
            lo, hi = node["first"][p], node["first"][p + 1]
            far = node["far"][lo:hi]
            # entries are sorted by distance to their object: only a ring of them can be near enough
            a = np.searchsorted(far, (d[r, p] - limit[r]).min(), "left")
            z = np.searchsorted(far, (d[r, p] + limit[r]).max(), "right")
            score, ids = q[r] @ node["v"][lo + a : lo + z].T, node["ids"][lo + a : lo + z]
            x, y = np.nonzero((score >= low[r][:, None]) & (ids[None] != own[r][:, None]))
            got.append((r[x], score[x, y], ids[y]))
        *best, rank = best_of(*(np.concatenate(x) for x in zip(*got)), k)
        full = rank == k - 1
        low[best[0][full]] = np.maximum(low[best[0][full]], best[1][full])
        limit = reach(base, low)
        at, step = at + step, 2 * step
    return tuple(best)


def _queries(table: pa.Table, width: int, square: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    q = _matrix(table.column("v"), width)
    floor = table.column("floor").to_numpy().astype(np.float64)
    return q, (q.astype(np.float64) ** 2).sum(1) + square, floor, table.column("up").to_numpy()


def _search(square: float, width: int, k: int, exact: bool):
    def run(key: tuple[pa.Scalar, ...], nodes: pa.Table, queries: pa.Table) -> pa.Table:
        row = score = ids = np.zeros(0, np.int64)
        if len(nodes) and len(queries):
            node = pickle.loads(nodes.column("node")[0].as_py())
            q, base, floor, up = _queries(queries, width, square)
            if exact:  # products below 2**53 are exact in doubles too, and faster
                q, node["v"] = q.astype(np.float64), node["v"].astype(np.float64)
            row, score, ids = search_leaf(node, q, queries.column("query_id").to_numpy(), up, base, floor, k)
        take = pa.array(row)
        return pa.table({"qkey": queries.column("qkey").take(take), "query_id": queries.column("query_id").take(take), "vec_id": pa.array(ids), "score": pa.array(score.astype(np.int64))})

    return run


def _descend(square: float, width: int, beam: int | None):
    """The entries of a node that a group's queries visit: all that the floor leaves, or the ``beam`` nearest."""

    def run(key: tuple[pa.Scalar, ...], queries: pa.Table, kids: pa.Table) -> pa.Table:
        q, base, floor, up = _queries(queries, width, square)
        limit = reach(base, np.where(np.isnan(floor), -np.inf, floor))
        stored, radius = kids.column("up").to_numpy(), kids.column("radius").to_numpy()
        ok = np.abs(up[:, None] - stored[None]) - radius[None] <= limit[:, None]
        d, some = np.full(ok.shape, np.inf), np.flatnonzero(ok.any(0))
        d[:, some] = _far(_point(q), _extend(_matrix(kids.column("v"), width)[some], square))
        ok &= d - radius[None] <= limit[:, None]
        if beam is not None:
            ok &= np.argsort(np.argsort(d, 1, kind="stable"), 1) < beam
        row, kid = np.nonzero(ok)
        take, of = pa.array(row), pa.array(kid)
        own = {c: queries.column(c).take(take) for c in ("qkey", "query_id", "v", "floor")}
        return pa.table({**own, "cell": kids.column("cell").take(of), "up": pa.array(d[row, kid]), "inner": kids.column("inner").take(of), "blocks": kids.column("blocks").take(of)})

    return run


def _apart(df: DataFrame) -> DataFrame:
    """``df`` with columns of its own, so that it can meet the table it comes from."""
    return df.select(*(F.col(c).alias(c) for c in df.columns))


def grow(rows: DataFrame, square: float, width: int) -> tuple[list[DataFrame], DataFrame]:
    """Of rows (vec_id, v): the entries of each level, from the root down, and the leaves.

    Entries: (parent, cell, v, up, radius, blocks, inner); leaves: (cell, block, node). The root is cell 0.
    """
    level = rows.withColumns({"cell": F.lit(0).cast("long"), "far": F.lit(0.0)})
    levels: list[DataFrame] = []
    leaves: list[DataFrame] = []
    entries = None
    for depth in range(DEPTH + 1):
        sizes = materialise(level.groupBy("cell").agg(F.count("*").alias("n"), F.max("far").alias("radius")), "sizes")
        big = sizes if not depth else sizes.filter((F.col("n") > BLOCK) & (F.col("radius") > 0) & F.lit(depth < DEPTH))
        # a few promoted vectors of each large node: a share of its rows that is about 3 * FANOUT of them
        draw = F.pmod(F.xxhash64("vec_id", "v", F.lit(depth)), F.lit(1 << 32))
        drawn = level.join(big.select("cell", "n"), "cell").withColumn("draw", draw).filter(F.col("draw") < F.lit(3.0 * FANOUT * (1 << 32)) / F.col("n"))
        one = drawn.groupBy("cell", "v").agg(F.min("draw").alias("draw"), F.min("far").alias("up"))
        ranked = one.withColumn("i", F.row_number().over(Window.partitionBy("cell").orderBy("draw", "v")))
        heads = materialise(ranked.filter(F.col("i") <= FANOUT).select(F.col("cell").alias("parent"), (F.col("cell") * (FANOUT + 1) + F.col("i")).alias("child"), "v", "up"), "heads")
        split = heads.select(F.col("parent").alias("cell")).distinct()
        if entries is not None:
            known = entries.join(sizes, "cell").withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
            flagged = known.join(split.withColumn("inner", F.lit(True)), "cell", "left")
            levels.append(materialise(flagged.select("parent", "cell", "v", "up", F.col("radius") * (1 + 1e-9), "blocks", F.coalesce("inner", F.lit(False)).alias("inner")).toDF("parent", "cell", "v", "up", "radius", "blocks", "inner"), "entries"))
            ends = levels[-1].filter("NOT inner")
            dealt = level.join(ends.select("cell", "blocks"), "cell").withColumn("block", F.pmod(F.xxhash64("vec_id", F.lit(7)), "blocks").cast("int"))
            objects = ends.select("cell", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "v")
            leaves.append(dealt.select("cell", "block", "vec_id", "v").groupBy("cell", "block").cogroup(_apart(objects).groupBy("cell", "block")).applyInArrow(_leaf(square, width), "cell long, block int, node binary"))
        if not heads.limit(1).count():
            break
        shared = level.join(sizes.join(split, "cell").select("cell", F.ceil(F.col("n") / ROUTED).alias("shares")), "cell")
        shared = shared.withColumn("share", F.pmod(F.xxhash64("vec_id", "v", F.lit(11)), "shares")).select("cell", "share", "vec_id", "v")
        sent = heads.join(shared.select(F.col("cell").alias("parent"), "share").distinct(), "parent").select(F.col("parent").alias("cell"), "share", "child", "v")
        routed = shared.groupBy("cell", "share").cogroup(_apart(sent).groupBy("cell", "share")).applyInArrow(_route(square, width), "vec_id long, v array<long>, cell long, far double")
        entries, level = heads.select("parent", F.col("child").alias("cell"), "v", "up"), materialise(routed, "routed")
    nodes = leaves[0]
    for more in leaves[1:]:
        nodes = nodes.union(more)
    return levels, materialise(nodes, "leaves")


def visits(levels: list[DataFrame], asked: DataFrame, groups: int, square: float, width: int, beam: int | None) -> DataFrame:
    """(qkey, query_id, v, floor, cell, up, blocks): the leaves to visit for queries with their floors."""
    group = F.pmod("qkey", F.lit(groups)).cast("int").alias("group")
    front, found = asked.withColumns({"cell": F.lit(0).cast("long"), "up": F.lit(0.0)}), []
    for depth, entries in enumerate(levels):
        q = front.select("*", group)
        kids = entries.withColumnRenamed("cell", "kid").withColumnRenamed("parent", "cell").join(q.select("cell", "group").distinct(), "cell").withColumnRenamed("cell", "parent").withColumnRenamed("kid", "cell")
        step = _descend(square, width, None if beam is None else beam if not depth else 1)
        down = q.groupBy("cell", "group").cogroup(_apart(kids).groupBy("parent", "group")).applyInArrow(step, ASK + ", inner boolean, blocks int")
        down = materialise(down, "visits")
        found.append(down.filter("NOT inner").drop("inner"))
        front = down.filter("inner").drop("inner", "blocks")
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out


def top_k(candidates: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """(query_id, rank int, vec_id, score) of integer vectors ``v``: both inputs have (vec_id, v array<long>)."""
    spark = candidates.sparkSession
    rows = materialise(candidates.select(F.col("vec_id").cast("long").alias("vec_id"), "v"), "candidates")
    asked = queries.select(F.xxhash64("vec_id", "v").alias("qkey"), F.col("vec_id").cast("long").alias("query_id"), "v").dropDuplicates(["qkey"])
    asked = materialise(asked, "queries")
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    most = [x.agg(F.max(square), F.max(F.size("v")), F.count("*")).first() for x in (rows, asked)]
    if not most[0][2] or not most[1][2]:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    score = (most[0][0] * most[1][0]) ** 0.5
    if score >= 2.0**63:
        raise ValueError("scores may pass the range of a long")
    square, width, groups = float(most[0][0]) * (1 + 1e-12), max(most[0][1], most[1][1]), -(-most[1][2] // GROUP)
    levels, leaves = grow(rows, square, width)
    by_score = Window.partitionBy("qkey", "query_id").orderBy(F.desc("score"), "vec_id")

    def search(floors: DataFrame, beam: int | None) -> DataFrame:
        q = visits(levels, floors, groups, square, width, beam)
        q = q.withColumns({"group": F.pmod("qkey", F.lit(groups)).cast("int"), "block": F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))}).drop("blocks")
        keys = ["cell", "block", "group"]
        n = leaves.join(q.select(*keys).distinct(), ["cell", "block"])
        found = _apart(n).groupBy(*keys).cogroup(q.groupBy(*keys)).applyInArrow(_search(square, width, k, score < 2.0**52), "qkey long, query_id long, vec_id long, score long")
        # the limit is applied on both sides of the shuffle
        return found.withColumn("rank", F.row_number().over(by_score)).filter(F.col("rank") <= k)

    start = asked.withColumn("floor", F.lit(None).cast("double"))
    first = materialise(search(start, BEAM).filter(F.col("rank") == k).select("qkey", F.col("score").cast("double").alias("floor")), "floors")
    # a long's rounding to double must not lift the floor
    floor = (F.col("floor") - F.abs("floor") * 2.0**-52).alias("floor")
    return search(asked.join(first, "qkey", "left").select("qkey", "query_id", "v", floor), None).select("query_id", "rank", "vec_id", "score")


def scaled(rows: DataFrame, factor: int = 256) -> DataFrame:
    """(vec_id, v): whole vectors times ``factor``, rounded down; others and null ids are left out."""
    v = F.col("embedding")
    fine = F.col("vec_id").isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.filter(F.coalesce(fine, F.lit(False))).select("vec_id", F.transform(v, lambda x: F.floor(x.cast("double") * factor)).alias("v"))


def op5_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scaled(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))
    return top_k(rows, rows.filter("vec_id % 50 = 0"))


SQL = r"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""

QUERIES = {"op5_exact_top_k": op5_exact_top_k}
ORACLES = {"op5_exact_top_k": SQL}
