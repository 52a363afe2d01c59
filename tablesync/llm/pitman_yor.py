"""LM scoring by a hierarchical Pitman-Yor model.

Restaurants: one for each context, the preceding word, whose customers are tokens; all share one parent, the
restaurant of the empty context, whose customers are their tables. A word with more than one in ``FREQUENT``
of all training tokens is a context of its own (there are fewer than ``FREQUENT``, by definition); rarer words
are contexts in ``FREQUENT`` classes by fingerprint, so totals of contexts are of a fixed size. A text begins
in the context of the end token. A root table serves a word that no other one serves; the mass of words not
yet seen is that of the unknown word.

Seating is sampled by Gibbs, blocked so that words are independent. The root is drawn as explicit masses given
its customers: Gamma(customers - discount) for each word and Gamma(strength + discount * words) for unknown
ones, over their sum. For each context, x ~ Gamma(strength / discount + tables) stands for its other words:
given x, a new table of a word has the weight discount * x * its mass in the root (``alpha``), whatever
others do. Then all customers of a word in a context are seated anew at once: with n of them, t tables have the
probability S(n, t) * alpha**t over its sum, S being the generalised Stirling numbers of the discount, which count the
ways to seat them. Sizes of tables decide nothing else, so they are not drawn. S is exact up to ``EXACT``
customers. Beyond, its shape over (t - 1) * Gamma(n - 2 d) / Gamma(n - d), which tends to a limit, is that of
``REFERENCE`` customers; where tables are so many that they hold few customers each, t is normal (``crowded``). The
means are within a fiftieth of the exact ones (tests). Strengths are drawn from their posterior on a grid, at each sweep; discounts are the estimate
n1 / (n1 + 2 n2) from all counts. All begin with one table a word.

Words are dealt to buckets, a word's customers in all contexts to one. Every draw is a function of word, context
and sweep, so neither a lost task nor the number of buckets changes it; a sweep repeats earlier ones from their recorded
totals. The predictive probability is the mean over the states after ``burn_in`` sweeps, ``samples`` of them.

Postings of a token are its document's place in a block of documents. Words with over a 256th of all tokens
(fewer than 256, by definition) send counts only, and their probabilities come back as broadcast rows of
65,536 values, so that no bucket gathers them. All counts and statistics cover all training documents.

Nulls and empties: a null or empty text is the end token alone. A row with a null id is scored, not learned
from and not held out. Rows that repeat id and text are each counted and get the same score. With nothing to
learn from, all words are unknown. Other columns are left alone.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.llm.common import added, crc_mod, group_count, materialise, pack, row_key, runs, short_batches, unpack
from tablesync.llm.words import Words, mix

BLOCK = 5 << 20
BUCKET = 4 << 20
CONTEXTS = 1 << 16
CHUNK = 1 << 12
END = np.uint64(0x0E9D0F7E4B8A2C11)
HOT_SHARE = 256
FREQUENT = 1 << 15
EXACT, REFERENCE = 1 << 10, 1 << 12
#: Of more customers, so many a table in the mean, or more, follow the limit; fewer are normal.
DENSE = 16
Z = np.linspace(-8, 8, 4001)
PHI = np.array([0.5 * math.erfc(-x / math.sqrt(2)) for x in Z])
#: Elements of a table of probabilities that are made at a time.
AT_ONCE = 1 << 20
SUMS = 1 << 20
GRID = np.exp(np.linspace(np.log(0.01), np.log(1e5), 49))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list, list]]:
    """Row keys, folds and texts, about ``BLOCK`` bytes of text at a time."""
    keys, learn, texts, size = [], [], [], 0
    for b in batches:
        for k, f, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).cast(pa.binary()).to_pylist()):
            keys.append(k)
            learn.append(bool(f))
            texts.append(t)
            size += len(t or b"")
            if size >= BLOCK:
                yield keys, learn, texts
                keys, learn, texts, size = [], [], [], 0
    if keys:
        yield keys, learn, texts


def tokens(texts: list[bytes | None], frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all texts, one after another: each token's fingerprint, context and text. A text ends with END.

    ``frequent``: sorted fingerprints of the words that are contexts of their own.
    """
    w = Words(texts)
    many = w.counts + 1
    end = np.cumsum(many) - 1
    total = int(end[-1]) + 1 if len(end) else 0
    is_word = np.ones(total, bool)
    is_word[end] = False
    h = np.empty(total, np.uint64)
    h[end] = END
    h[is_word] = w.hashes(lower=True)
    before = np.concatenate((np.full(1, END), h[:-1]))[:total]
    context = (before >> np.uint64(49)).astype(np.uint16)
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, before), len(frequent) - 1)
        own = frequent[at] == before
        context[own] = FREQUENT + at[own]
    return h, context, np.repeat(np.arange(len(texts)), many)


def _frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words with over half a ``FREQUENT``-th of a block's training tokens, and under 0 the number of those tokens."""
    for _, learn, texts in _blocks(batches):
        h, _, doc = tokens(texts, np.zeros(0, np.uint64))
        h = h[np.array(learn)[doc]]
        own, n = np.unique(h, return_counts=True)
        top = n * 2 * FREQUENT > len(h)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(own[top], np.uint64(0)).view(np.int64)), pa.array(np.append(n[top], len(h)).astype(np.int64))], names=["word", "n"])


PARTS = ("words", "pairs", "context", "count", "posts", "docs")


def _deal(buckets: int, hot_of):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("keys", pa.binary()), *((c, pa.binary()) for c in PARTS)])
        block, (hot, frequent) = TaskContext.get().partitionId() << 32, hot_of.value
        for keys, learn, texts in _blocks(batches):
            h, context, doc = tokens(texts, frequent)
            n = np.array(learn)[doc]
            bucket = ((mix(h) >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
            by = np.lexsort((doc, context, h, bucket))
            h, context, doc, n, bucket = h[by], context[by], doc[by], n[by], bucket[by]
            post = ~np.isin(h, hot)
            bounds = np.searchsorted(bucket, np.arange(buckets + 1))
            yield pa.RecordBatch.from_pydict({"bucket": [block % buckets], "block": [block], "keys": [np.array(keys, np.int64).tobytes()], **{c: [None] for c in PARTS}}, schema=schema)
            for k in range(buckets):
                s = slice(bounds[k], bounds[k + 1])
                if s.start == s.stop:
                    continue
                w, c = h[s], context[s]
                new = np.ones(len(w), bool)
                new[1:] = (w[1:] != w[:-1]) | (c[1:] != c[:-1])
                pair = np.flatnonzero(new)
                word = runs(w[pair])
                out = {
                    "words": w[pair][word].tobytes(),
                    "pairs": pack(np.diff(word, append=len(pair)).astype(np.uint32)),
                    "context": pack(c[pair]),
                    "count": pack(np.add.reduceat(n[s].astype(np.uint32), pair).astype(np.uint32)),
                    "posts": pack(np.add.reduceat(post[s].astype(np.uint32), pair).astype(np.uint32)),
                    "docs": pack(doc[s][post[s]].astype(np.uint32)) if post[s].any() else b"",
                }
                yield pa.RecordBatch.from_pydict({"bucket": [k], "block": [block], "keys": [None], **{c: [v] for c, v in out.items()}}, schema=schema)
            block += 1

    return run


MERGED = "bucket int, block long, keys binary, words binary, pairs binary, context binary, count binary, posts binary, docs binary, at binary, blocks binary"


def _merge(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """One row for the bucket's words, contexts, counts and postings; rows of blocks pass."""
    schema = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), *((c, pa.binary()) for c in ("keys", *PARTS, "at", "blocks"))])
    out: list[dict] = []
    got: dict[str, list] = {c: [] for c in ("w", "c", "n", "p", "doc", "at")}
    blocks: list[int] = []
    for r in table.to_pylist():
        if r["keys"] is not None:
            out.append({"bucket": r["bucket"], "block": r["block"], "keys": r["keys"]})
            continue
        got["w"].append(np.repeat(np.frombuffer(r["words"], np.uint64), unpack(r["pairs"], np.uint32)))
        got["c"].append(unpack(r["context"], np.uint16))
        got["n"].append(unpack(r["count"], np.uint32))
        got["p"].append(unpack(r["posts"], np.uint32))
        got["doc"].append(unpack(r["docs"], np.uint32) if r["docs"] else np.zeros(0, np.uint32))
        got["at"].append(np.full(len(got["doc"][-1]), len(blocks), np.uint32))
        blocks.append(r["block"])
    if blocks:
        w, c, n, p, doc, at = (np.concatenate(got[x]) for x in ("w", "c", "n", "p", "doc", "at"))
        by = np.lexsort((c, w))
        start = np.cumsum(p, dtype=np.int64) - p
        w, c, n, p, start = w[by], c[by], n[by].astype(np.int64), p[by].astype(np.int64), start[by]
        post = np.repeat(start - (np.cumsum(p) - p), p) + np.arange(p.sum())
        new = np.ones(len(w), bool)
        new[1:] = (w[1:] != w[:-1]) | (c[1:] != c[:-1])
        pair = np.flatnonzero(new)
        word = runs(w[pair])
        out.append(
            {"bucket": key[0].as_py(), "block": None, "keys": None, "words": w[pair][word].tobytes(), "pairs": pack(np.diff(word, append=len(pair)).astype(np.uint32)), "context": pack(c[pair]), "count": pack(np.add.reduceat(n, pair).astype(np.uint64)), "posts": pack(np.add.reduceat(p, pair).astype(np.uint64)), "docs": pack(doc[post]) if len(post) else b"", "at": pack(at[post]) if len(post) else b"", "blocks": np.array(blocks, np.int64).tobytes()}
        )
    return pa.Table.from_pylist(out, schema=schema)


def lgamma(z: np.ndarray) -> np.ndarray:
    """Logarithm of the gamma function for z > 0, by Stirling's series beyond 8."""
    z = np.asarray(z, np.float64)
    low = np.where(z < 8, np.log(np.prod([np.minimum(z, 8) + i for i in range(8)], 0)), 0.0)
    z = np.where(z < 8, z + 8, z)
    return (z - 0.5) * np.log(z) - z + 0.5 * np.log(2 * np.pi) + 1 / (12 * z) - 1 / (360 * z**3) + 1 / (1260 * z**5) - low


def strength(rng: np.random.Generator, tables: np.ndarray, customers: np.ndarray, discount: float) -> float:
    """A draw of the strength that restaurants share, given their totals; uniform over ``GRID``."""
    log = np.zeros(len(GRID))
    for k, s in enumerate(GRID):
        log[k] = (lgamma(s / discount + tables) - lgamma(s / discount) - lgamma(s + customers) + lgamma(s)).sum()
    p = np.exp(log - log.max())
    return float(rng.choice(GRID, p=p / p.sum()))


def discount(one: int, two: int) -> float:
    return float(np.clip(one / max(one + 2 * two, 1), 0.05, 0.95))


class State:
    """What all words share in a sweep: totals by context, strengths, discounts, and the draws from them."""

    def __init__(self, number: int, customers: np.ndarray, tables: np.ndarray, mass: float, words: int, discounts: tuple[float, float]):
        rng = np.random.default_rng((21, number))
        self.customers, self.tables, self.words, self.discounts = customers, tables, words, discounts
        used = customers > 0
        root, leaf = discounts
        self.strength = strength(rng, tables[used], customers[used], leaf)
        top = strength(rng, np.array([words]), np.array([tables.sum()]), root) if words else 1.0
        self.x = rng.gamma(self.strength / leaf + tables)
        self.rest = rng.gamma(top + root * words)
        self.norm = mass + self.rest


def uniform(key: np.ndarray, number: int) -> np.ndarray:
    """A number between 0 and 1 for each 64-bit key, drawn by its value."""
    return ((mix(key + np.uint64(number * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def gamma(shape: np.ndarray, key: np.ndarray, number: int) -> np.ndarray:
    """Gamma draws (Marsaglia and Tsang), each by its key: of shape + 1, times a power of a uniform one."""
    d = np.asarray(shape, np.float64) + 2 / 3
    out, left, key = np.zeros(len(d)), np.arange(len(d)), mix(key + np.uint64(number))
    power = uniform(key, 0) ** (1 / np.asarray(shape, np.float64))
    k = 1
    while len(left):
        own, at = key[left], d[left]
        x = np.sqrt(-2 * np.log(uniform(own, k))) * np.cos(2 * np.pi * uniform(own, k + 1))
        v = (1 + x / np.sqrt(9 * at)) ** 3
        with np.errstate(invalid="ignore", divide="ignore"):
            fits = (v > 0) & (np.log(uniform(own, k + 2)) < 0.5 * x * x + at - at * v + at * np.log(v))
        out[left[fits]] = at[fits] * v[fits]
        left, k = left[~fits], k + 3
    return out * power


@lru_cache(4)
def stirling(d: float) -> tuple[np.ndarray, np.ndarray]:
    """Logarithms of S(n, t) up to ``EXACT`` customers, and of S(REFERENCE, t) * d**t * Gamma(t) from t = 1 on."""
    table, row = np.full((EXACT + 1, EXACT + 1), -np.inf), np.full(REFERENCE + 2, -np.inf)
    row[1] = 0.0
    table[1, 1] = 0.0
    for n in range(1, REFERENCE):
        t = np.arange(1, n + 1)
        new = np.logaddexp(row[:n], np.log(n - d * t) + row[1 : n + 1])
        row[n + 1] = row[n]
        row[1 : n + 1] = new
        if n < EXACT:
            table[n + 1, 1 : n + 2] = row[1 : n + 2]
    t = np.arange(1, REFERENCE + 1)
    return table, row[1 : REFERENCE + 1] + t * np.log(d) + lgamma(t)


def crowded(n: np.ndarray, alpha: np.ndarray, d: float) -> tuple[np.ndarray, np.ndarray]:
    """Mean and deviation of the number of tables of very many customers at very many tables.

    Tables come as a Poisson number, with sizes of weight z**c / c! * (1 - d)(2 - d)...(c - 1 - d), and hold n customers
    in all; z is such that they hold n in the mean, and the condition takes what customers tell of tables off the variance.
    """
    low, high = np.full(len(n), -40.0), np.full(len(n), -1e-12)  # of log(1 - z)
    for _ in range(60):
        middle = (low + high) / 2
        more = alpha * -np.expm1(middle) * np.exp((d - 1) * middle) > n
        low, high = np.where(more, middle, low), np.where(more, high, middle)
    z, rest = -np.expm1(low), np.exp(low)
    f, first, second = -np.expm1(d * low) / d, z * rest ** (d - 1), z * z * (1 - d) * rest ** (d - 2)
    return alpha * f, np.sqrt(np.maximum(alpha * f - n * n / (alpha * (first + second)), 1e-9))


class Tables:
    """How many tables the customers of words in contexts have; of those with one customer nothing is left to draw."""

    def __init__(self, customers: np.ndarray):
        self.at = np.flatnonzero(customers > 1)
        self.at = self.at[np.argsort(customers[self.at], kind="stable")]
        self.n = customers[self.at]
        # neighbours of nearly equal counts are drawn together
        self.cuts, i = [], 0
        exact = int(np.searchsorted(self.n, EXACT, "right"))
        while i < exact:
            j = int(np.searchsorted(self.n[:exact], self.n[i] * 5 // 4, "right"))
            j = min(j, i + max(AT_ONCE // int(self.n[j - 1]), 1))
            self.cuts.append((i, j))
            i = j
        self.exact = exact

    def draw(self, alpha: np.ndarray, d: float, u: np.ndarray) -> np.ndarray:
        """Numbers of tables for ``alpha`` and uniform draws ``u``, in the order of ``at``."""
        table, limit = stirling(d)
        out, log = np.empty(len(self.n), np.int64), np.log(np.maximum(alpha, 1e-300))
        for i, j in self.cuts:
            most = int(self.n[j - 1])
            p = table[self.n[i:j], 1 : most + 1] + log[i:j, None] * np.arange(1, most + 1)
            p = np.cumsum(np.exp(p - p.max(1, keepdims=True)), axis=1)
            out[i:j] = 1 + (p < u[i:j, None] * p[:, -1:]).sum(1)
        rest = np.arange(self.exact, len(self.n))
        dense = alpha[rest] / d * DENSE > self.n[rest]
        own, rest = rest[dense], rest[~dense]
        if len(own):
            mean, sd = crowded(self.n[own], alpha[own], d)
            out[own] = np.maximum(np.rint(mean + sd * np.interp(u[own], PHI, Z)), 1)
        scale = lambda n: np.exp(lgamma(n - 2 * d) - lgamma(n - d))
        shrink = scale(self.n[rest].astype(np.float64)) / scale(np.array([float(REFERENCE)])) if len(rest) else []
        for i, c in zip(rest, shrink):
            mean = alpha[i] / d
            k = np.arange(int(min(self.n[i], 1.5 * mean + 12 * np.sqrt(mean) + 30)), dtype=np.float64)
            p = k * (log[i] - np.log(d)) - lgamma(k + 1) + np.interp(k * c, np.arange(len(limit)), limit, right=-np.inf)
            p = np.cumsum(np.exp(p - p.max()))
            out[i] = 1 + np.searchsorted(p, u[i] * p[-1])
        return np.minimum(out, self.n)


class Bucket:
    """The words of a bucket with their customers; sweeps seat them under given totals."""

    def __init__(self, row: dict):
        self.words = np.frombuffer(row["words"], np.uint64)
        pairs = unpack(row["pairs"], np.uint32).astype(np.int64)
        self.context, self.n = unpack(row["context"], np.uint16).astype(np.int64), unpack(row["count"], np.uint64).astype(np.int64)
        self.word_of = np.repeat(np.arange(len(pairs), dtype=np.int32), pairs)
        self.word_at = np.cumsum(pairs) - pairs
        self.count = np.add.reduceat(self.n, self.word_at)
        self.seats = Tables(self.n)
        at = self.seats.at
        self.keys = mix(self.words[self.word_of[at]] ^ mix(self.context[at].astype(np.uint64)))
        self.t = (self.n > 0).astype(np.int64)

    def draw_root(self, number: int, root: float) -> None:
        customers = np.add.reduceat(self.t, self.word_at)
        self.mass = gamma(np.maximum(customers - root, 1e-9), self.words, number) * (customers > 0)

    def root(self, g: State) -> np.ndarray:
        """Each word's mass in the root; the unknown word's if it is not known."""
        return np.where(self.count > 0, self.mass, g.rest) / g.norm

    def predict(self, g: State, root: np.ndarray) -> np.ndarray:
        leaf = g.discounts[1]
        share = (g.strength + leaf * g.tables[self.context]) * root[self.word_of]
        return (self.n - leaf * self.t + share) / (g.strength + g.customers[self.context])

    def sweep(self, g: State, number: int) -> None:
        at = self.seats.at
        alpha = g.discounts[1] * g.x[self.context[at]] * self.root(g)[self.word_of[at]]
        self.t[at] = self.seats.draw(alpha, g.discounts[1], uniform(self.keys, number))
        self.draw_root(number + 1, g.discounts[0])

    def counts(self) -> np.ndarray:
        """Customers and tables by context, numbers of words and of customers and contexts that come once and twice."""
        words = np.add.reduceat(self.t, self.word_at)
        tail = np.zeros(CHUNK, np.int64)
        tail[:5] = (self.count > 0).sum(), (self.n == 1).sum(), (self.n == 2).sum(), (words == 1).sum(), (words == 2).sum()
        by = lambda n: np.bincount(self.context, n, CONTEXTS).astype(np.int64)
        return np.concatenate((by(self.n), by(self.t), tail))

    def dense(self, g: State, word: int, mass: float) -> np.ndarray:
        """The word's predictive probability in every context."""
        leaf = g.discounts[1]
        out = (g.strength + leaf * g.tables) * mass
        at = np.flatnonzero(self.word_of == word)
        out[self.context[at]] += self.n[at] - leaf * self.t[at]
        return out / (g.strength + g.customers)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for b in batches:
        for i in range(b.num_rows):
            yield b.slice(i, 1).to_pylist()[0]


def _sum_tables(discounts: tuple[float, float] | None, history_of):
    """Totals after the next sweep: all before are repeated, draw for draw, from the recorded states."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, mass = None, 0.0
        for row in _rows(batches):
            b = Bucket(row)
            if discounts:
                b.draw_root(0, discounts[0])
                for i, g in enumerate(history_of.value):
                    b.sweep(g, i)
                mass += b.mass.sum()
            total = b.counts() if total is None else total + b.counts()
        if total is not None:
            each = total.reshape(-1, CHUNK)
            yield pa.RecordBatch.from_arrays([pa.array(range(len(each)), pa.int32()), pa.array([pack(x) for x in each], pa.binary()), pa.array([mass] * len(each))], names=["chunk", "sums", "mass"])

    return run


def _add(table: pa.Table) -> pa.Table:
    total = sum(unpack(x, np.int64) for x in table.column("sums").to_pylist())
    return pa.table({"chunk": table.column("chunk").slice(0, 1), "sums": pa.array([pack(total)], pa.binary()), "mass": pa.array([float(np.sort(table.column("mass").to_numpy()).sum())])})


def _totals(model: DataFrame, discounts: tuple[float, float] | None, history_of) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Customers and tables by context, the five numbers of ``counts``, and the sum of masses."""
    schema = "chunk int, sums binary, mass double"
    got = added(model.mapInArrow(_sum_tables(discounts, history_of), schema), ["chunk"], _add).collect()
    flat = np.zeros((2 * CONTEXTS // CHUNK + 1, CHUNK), np.int64)
    for r in got:
        flat[r["chunk"]] = unpack(bytes(r["sums"]), np.int64)
    flat = flat.reshape(-1)
    return flat[:CONTEXTS], flat[CONTEXTS : 2 * CONTEXTS], flat[2 * CONTEXTS :][:5], got[0]["mass"] if got else 0.0


def combined(parts: list[tuple[np.ndarray, ...]]) -> list[tuple[np.ndarray, ...]]:
    """One part (block, doc, sums) of parts that hold some documents several times, sorted."""
    block, doc, *sums = (np.concatenate(x) for x in zip(*parts))
    by = np.lexsort((doc, block))
    block, doc = block[by], doc[by]
    cut = np.flatnonzero(np.concatenate(([True], (doc[1:] != doc[:-1]) | (block[1:] != block[:-1]))))
    return [(block[cut], doc[cut], *(np.add.reduceat(x[by], cut) for x in sums))]


def _score(discounts: tuple[float, float], history_of, samples: int, hot_of):
    """Sums for each block's documents; for hot words their count and log probabilities by context.

    Sums of a task's buckets are added up, ``SUMS`` documents at a time, before they leave it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("block", pa.int64()), ("hot", pa.int64()), ("n", pa.int64()), *((c, pa.binary()) for c in ("keys", "docs", "score", "base", "known"))])
        make = lambda **x: pa.RecordBatch.from_pylist([x], schema=schema)
        history, hot_words = history_of.value, hot_of.value[0]
        trained = int(history[0].customers.sum())
        parts: list[tuple[np.ndarray, ...]] = []

        def sent() -> Iterator[pa.RecordBatch]:
            for blocks, doc, *sums in combined(parts) if parts else ():
                edge = runs(blocks)
                for i, j in zip(edge, [*edge[1:], len(doc)]):
                    step = np.diff(doc[i:j], prepend=0).astype(np.uint32)
                    yield make(block=int(blocks[i]), docs=pack(step), score=sums[0][i:j].tobytes(), base=sums[1][i:j].tobytes(), known=pack(sums[2][i:j].astype(np.uint32)))

        for row in _rows(batches):
            if row["keys"] is not None:
                yield make(block=row["block"], keys=row["keys"])
                continue
            b = Bucket(row)
            hot = np.flatnonzero(np.isin(b.words, hot_words))
            mean, dense = np.zeros(len(b.n)), np.zeros((len(hot), CONTEXTS))
            b.draw_root(0, discounts[0])
            for i, g in enumerate(history):
                if i >= len(history) - samples:
                    root = b.root(g)
                    mean += b.predict(g, root) / samples
                    for k, w in enumerate(hot):
                        dense[k] += b.dense(g, w, root[w]) / samples
                if i + 1 < len(history):
                    b.sweep(g, i)
            for k, w in enumerate(hot):
                yield make(hot=int(b.words[w : w + 1].view(np.int64)[0]), n=int(b.count[w]), score=np.log10(dense[k]).tobytes())
            posts = unpack(row["posts"], np.uint64).astype(np.int64)
            if not posts.sum():
                continue
            base = np.log10((b.count + 0.1) / (trained + 0.1 * (history[0].words + 1)))
            doc, at, blocks = unpack(row["docs"], np.uint32).astype(np.int64), unpack(row["at"], np.uint32).astype(np.int64), np.frombuffer(row["blocks"], np.int64)
            score, word = np.repeat(np.log10(mean), posts), np.repeat(b.word_of, posts)
            parts += combined([(blocks[at], doc, score, base[word], (b.count[word] > 0).astype(np.int64))])
            if sum(len(x[0]) for x in parts) > SUMS:
                parts = combined(parts)
                if len(parts[0][0]) > SUMS // 2:
                    yield from sent()
                    parts = []
        yield from sent()

    return run


def _by_document(table: pa.Table) -> pa.Table:
    rows = table.to_pylist()
    keys = next((np.frombuffer(r["keys"], np.int64) for r in rows if r["keys"] is not None))
    score, base, known = np.zeros(len(keys)), np.zeros(len(keys)), np.zeros(len(keys), np.int64)
    for r in rows:
        if r["keys"] is None:
            d = np.cumsum(unpack(r["docs"], np.uint32), dtype=np.int64)
            score[d] += np.frombuffer(r["score"], np.float64)
            base[d] += np.frombuffer(r["base"], np.float64)
            known[d] += unpack(r["known"], np.uint32)
    return pa.table({"row_key": pa.array(keys), "score": pa.array(score), "base": pa.array(base), "known": pa.array(known)})


def _hot_sums(table_of):
    """Each row's number of tokens, and the sums over its hot words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, count, log, base, frequent = table_of.value
        for keys, _, texts in _blocks(batches):
            h, context, doc = tokens(texts, frequent)
            k = len(keys)
            at = np.minimum(np.searchsorted(words, h), max(len(words) - 1, 0))
            is_hot = (words[at] == h) if len(words) else np.zeros(len(h), bool)
            d, a = doc[is_hot], at[is_hot]
            cols = [np.bincount(doc, minlength=k), np.bincount(d, log[a, context[is_hot]] if len(a) else None, k), np.bincount(d, base[a] if len(a) else None, k), np.bincount(d, (count[a] > 0).astype(float) if len(a) else None, k)]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(cols[0].astype(np.int64)), pa.array(cols[1].astype(float)), pa.array(cols[2].astype(float)), pa.array(cols[3].astype(np.int64))], names=["row_key", "n_tokens", "hot_score", "hot_base", "hot_known"])

    return run


def score(docs: DataFrame, learn: str, burn_in: int = 2, samples: int = 3, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(row_key, n_tokens, n_known, train_tokens, base_score, score, perplexity) of each row.

    ``learn``: SQL condition of the rows to learn from. ``row_key`` names a row by id and text; ``base_score``
    is the smoothed unigram's log10 probability, ``score`` the model's.
    """
    spark = docs.sparkSession
    keyed = docs.select(row_key(doc_id, text).alias("row_key"), F.coalesce(F.expr(learn), F.lit(False)).alias("learn"), F.col(text).alias("text"))
    top = keyed.mapInArrow(_frequent, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    trained = (top.filter("word = 0").first() or [0, 0])[1]
    # fewer than FREQUENT rows, by definition
    common = top.filter((F.col("word") != 0) & (F.col("n") * FREQUENT > trained)).collect()
    sort = lambda rows: np.sort(np.array([r["word"] for r in rows], np.int64).view(np.uint64))
    frequent = sort(common)
    hot_of = spark.sparkContext.broadcast((sort(r for r in common if r["n"] * HOT_SHARE > trained), frequent))
    buckets = group_count(docs, text, BUCKET)
    dealt = keyed.mapInArrow(_deal(buckets, hot_of), "bucket int, block long, keys binary, " + ", ".join(f"{c} binary" for c in PARTS))
    merged = materialise(dealt.groupBy("bucket").applyInArrow(_merge, MERGED), "counts")
    model = merged.filter("keys IS NULL").select("bucket", "words", "pairs", "context", "count")
    with short_batches(spark):
        _, _, of, _ = _totals(model, None, None)
        discounts = discount(int(of[3]), int(of[4])), discount(int(of[1]), int(of[2]))
        history: list[State] = []
        for n in range(burn_in + samples):
            customers, tables, of, mass = _totals(model, discounts, spark.sparkContext.broadcast(history))
            history.append(State(n, customers, tables, mass, int(of[0]), discounts))
        history_of = spark.sparkContext.broadcast(history)
        # some buckets a task, as a document's sums leave each task once
        few = merged.coalesce(max(spark.sparkContext.defaultParallelism, buckets // 16))
        sums = materialise(few.mapInArrow(_score(discounts, history_of, samples, hot_of), "block long, hot long, n long, keys binary, docs binary, score binary, base binary, known binary"), "sums")
    per_row = sums.filter("block IS NOT NULL").select("block", "keys", "docs", "score", "base", "known").groupBy("block").applyInArrow(_by_document, "row_key long, score double, base double, known long").dropDuplicates(["row_key"])
    own = sorted(((int(np.int64(r["hot"]).view(np.uint64)), r["n"], np.frombuffer(bytes(r["score"]), np.float64)) for r in sums.filter("hot IS NOT NULL").select("hot", "n", "score").collect()), key=lambda x: x[0])
    count = np.array([x[1] for x in own], np.int64)
    base = np.log10((count + 0.1) / (trained + 0.1 * (history[0].words + 1)))
    table_of = spark.sparkContext.broadcast((np.array([x[0] for x in own], np.uint64), count, np.stack([x[2] for x in own]) if own else np.zeros((0, CONTEXTS)), base, frequent))
    hot_rows = keyed.mapInArrow(_hot_sums(table_of), "row_key long, n_tokens long, hot_score double, hot_base double, hot_known long")
    out = hot_rows.join(per_row.hint("merge"), "row_key", "left")
    part = lambda c: F.coalesce(c, F.lit(0))
    total = F.col("hot_score") + part("score")
    return out.select(
        "row_key", "n_tokens", (F.col("hot_known") + part("known")).alias("n_known"), F.lit(trained).cast("long").alias("train_tokens"),
        (F.col("hot_base") + part("base")).alias("base_score"), total.alias("score"), F.pow(F.lit(10.0), -total / F.col("n_tokens")).alias("perplexity"),
    )


def op1_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    held = F.coalesce(crc_mod("doc_id", 10) == 0, F.lit(False))
    scores = score(docs, "crc32(cast(cast(doc_id AS string) AS binary)) % 10 <> 0").dropDuplicates(["row_key"])
    rows = docs.select("doc_id", held.alias("held_out"), row_key().alias("row_key"))
    return rows.join(scores.hint("merge"), "row_key").drop("row_key")


QUERIES = {"op1_lm_score": op1_lm_score}
ORACLES: dict[str, str] = {}
