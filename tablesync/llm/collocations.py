"""Phrase collocation mining by vertical partitioning of the suffixes of word sequences.

Every word of a piece begins a suffix, cut at ``most`` words, the depth that phrases need. Prefixes that begin
``BUDGET`` suffixes or fewer are left as they are; longer ones are counted only below those that begin more, word by
word. So each suffix has a prefix of fitting frequency (or is one whole, and then travels as one counted entry a
block), prefixes are dealt to groups of about ``BUDGET`` suffixes, and a group holds whole subtrees and fits a task.
It sorts its suffixes and builds their subtrees by itself: a node at depth d is a run of neighbours with d words in
common, and its count is the sum of its leaves. Counts of longer prefixes than their group's share come from the
group; those of prefixes that were lengthened have been counted before. A block of texts sends equal suffixes once,
with their number.

A candidate is a phrase of 2 to ``most`` words that occurs ``least`` times or more. Its ancestors' counts are on its path
through the tree, those of what follows each cut come by joins.

Languages have trees of their own, since the language is part of each word's key, a 64-bit fingerprint: of n distinct
words two are taken for one with a probability of n**2 / 2**65. Sums are 64-bit integers, products 38-digit decimals.

Nulls and empties: null and empty texts have no words, a null language counts as ``und``. Rows are texts each, repeated
ones too. Other columns are left alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablesync.llm.common import group_count, materialise, pack, runs, short_batches, unpack
from tablesync.llm.spans import Spans
from tablesync.llm.words import mix

BLOCK = 8 << 20
#: Suffixes that a group may hold, and that a prefix may begin before it is lengthened.
BUDGET = 1 << 20
UNKNOWN = "und"
INSIDE, BREAK = np.ones(256, bool), np.zeros(256, bool)
BREAK[[*b".,;:!?\n\x0b\x0c\r"]] = True
INSIDE[[*b" \t"]] = False
INSIDE &= ~BREAK
STEP = np.uint64(0xD6E8FEB86659FD93)


class Suffixes:
    """The suffixes of a block's texts: ``words``[k] are the keys of their k-th words, 0 after the end of a piece."""

    def __init__(self, langs: list[str], texts: list[bytes | None], most: int):
        s = Spans(texts, INSIDE)
        self.spans = s
        own = {x: k for k, x in enumerate(dict.fromkeys(langs))}
        self.langs, self.lang = list(own), np.array([own[x] for x in langs], np.int32)[s.doc]
        seed = np.array([int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "little") for x in self.langs], np.uint64)
        key = mix(s.hashes(lower=True) ^ seed[self.lang]) if s.n else np.zeros(0, np.uint64)
        key[key == 0] = 1
        breaks = np.cumsum(BREAK[s.data])[s.start] if s.n else np.zeros(0, np.int64)
        ends = np.ones(s.n, bool)
        ends[:-1] = (breaks[1:] != breaks[:-1]) | (s.doc[1:] != s.doc[:-1])
        self.words = [key]
        for _ in range(most - 1):
            last = self.words[-1]
            nxt = np.zeros(s.n, np.uint64)
            nxt[:-1] = np.where(ends[:-1], 0, last[1:])
            self.words.append(nxt)


def chained(words: list[np.ndarray], k: int) -> np.ndarray:
    """Keys of the first ``k`` words, or fewer where a piece ends."""
    out = words[0].copy()
    for w in words[1:k]:
        out = mix(out * STEP + w)
    return out


def _blocks(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[Suffixes]:
    langs, texts, size = [], [], 0
    for b in batches:
        for x, t in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist()):
            langs.append(x)
            texts.append(t)
            size += len(t or b"")
            if size >= BLOCK:
                yield Suffixes(langs, texts, most)
                langs, texts, size = [], [], 0
    if texts:
        yield Suffixes(langs, texts, most)


def _zip(a: np.ndarray) -> bytes:
    return len(a).to_bytes(8, "little") + pa.compress(pack(a), "zstd", asbytes=True)


def _unzip(b: bytes, dtype) -> np.ndarray:
    n = int.from_bytes(b[:8], "little")
    return unpack(pa.decompress(b[8:], n * np.dtype(dtype).itemsize, "zstd", asbytes=True), dtype) if n else np.zeros(0, dtype)


def _packed(b: bytes) -> bytes:
    return len(b).to_bytes(8, "little") + pa.compress(b, "zstd", asbytes=True)


def _unpacked(b: bytes) -> bytes:
    n = int.from_bytes(b[:8], "little")
    return pa.decompress(b[8:], n, "zstd", asbytes=True) if n else b""


def _dealt(key: np.ndarray, groups: int) -> np.ndarray:
    return ((mix(key ^ STEP) & np.uint64(0xFFFFFFFF)) * np.uint64(groups) >> np.uint64(32)).astype(np.int64)


def _vocabulary(groups: int):
    """For each block and group: distinct words by key, with their text, language and number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s in _blocks(batches, 1):
            if not s.spans.n:
                continue
            key, first, n = np.unique(s.words[0], return_index=True, return_counts=True)
            group = _dealt(key, groups)
            by = np.argsort(group, kind="stable")
            cut, data = runs(group[by]), s.spans.data.tobytes()
            langs = "\n".join(x.replace("\\", "\\\\").replace("\n", "\\n") for x in s.langs).encode()
            for i, j in zip(cut, [*cut[1:], len(by)]):
                at = by[i:j]
                begin, end = s.spans.start[first[at]].tolist(), s.spans.end[first[at]].tolist()
                text = b"\n".join([data[a:b] for a, b in zip(begin, end)]).lower()
                cols = [_zip(key[at]), _zip(n[at].astype(np.int64)), _zip(s.lang[first[at]]), _packed(langs), _packed(text)]
                yield pa.RecordBatch.from_arrays([pa.array([int(group[at[0]])], pa.int32()), *(pa.array([c], pa.binary()) for c in cols)], names=["grp", "key", "n", "lang", "langs", "words"])

    return run


def _counted(least: int):
    """(lang, key, word, f) of a group's words with ``least`` occurrences, and of all words of a language, without key."""

    def run(table: pa.Table) -> pa.Table:
        keys, ns, langs, words, names = [], [], [], [], {}
        for row in range(table.num_rows):
            r = {c: table.column(c)[row].as_py() for c in table.column_names}
            own = [x.replace("\\n", "\n").replace("\\\\", "\\") for x in _unpacked(r["langs"]).decode().split("\n")]
            code = np.array([names.setdefault(x, len(names)) for x in own])
            keys.append(_unzip(r["key"], np.uint64))
            ns.append(_unzip(r["n"], np.int64))
            langs.append(code[_unzip(r["lang"], np.int32)])
            words.append((len(keys[-1]), _unpacked(r["words"])))
        key, n, lang = np.concatenate(keys), np.concatenate(ns), np.concatenate(langs)
        by = np.argsort(key, kind="stable")
        cut = runs(key[by])
        f = np.add.reduceat(n[by], cut)
        kept = np.flatnonzero(f >= least)
        at = by[cut[kept]]
        text, over = {}, np.cumsum([0, *(x for x, _ in words)])
        where = np.searchsorted(over, at, "right") - 1
        for b in np.unique(where).tolist():
            own = words[b][1].split(b"\n")
            text |= {int(i): own[i - over[b]].decode() for i in at[where == b].tolist()}
        total = np.zeros(len(names), np.int64)
        np.add.at(total, lang, n)
        called = list(names)
        return pa.table(
            {
                "lang": pa.array([called[x] for x in lang[at]] + called, pa.string()),
                "key": pa.array([*key[at].view(np.int64).tolist(), *[None] * len(called)], pa.int64()),
                "word": pa.array([*(text[int(i)] for i in at), *[None] * len(called)], pa.string()),
                "f": pa.array([*f[kept].tolist(), *total.tolist()], pa.int64()),
            }
        )

    return run


class Heavy:
    """Sorted keys of the prefixes of 1, 2, ... words that begin more than the budget of suffixes, with their counts."""

    def __init__(self) -> None:
        self.keys: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []

    def add(self, keys: list[int], counts: list[int]) -> None:
        own = np.array(keys, np.int64).view(np.uint64)
        by = np.argsort(own)
        self.keys.append(own[by])
        self.counts.append(np.array(counts, np.int64)[by])

    def has(self, k: int, key: np.ndarray) -> np.ndarray:
        """Which keys are of heavy prefixes of ``k`` words."""
        if k > len(self.keys) or not len(self.keys[k - 1]):
            return np.zeros(len(key), bool)
        own = self.keys[k - 1]
        return own[np.minimum(np.searchsorted(own, key), len(own) - 1)] == key

    def count(self, k: int, key: np.ndarray) -> np.ndarray:
        """Counts of keys, which all are heavy."""
        return self.counts[k - 1][np.searchsorted(self.keys[k - 1], key)]

    def lengths(self, words: list[np.ndarray]) -> np.ndarray:
        """For each suffix, how many words its prefix has: the fewest that are not heavy, or all."""
        out, left = np.ones(len(words[0]), np.int8), np.arange(len(words[0]))
        for k in range(1, len(words)):
            left = left[self.has(k, chained([w[left] for w in words[:k]], k))]
            out[left] += 1
        return out


def _longer(k: int, heavy: Heavy):
    """Counts of the prefixes of ``k`` words whose first and last ``k - 1`` are heavy; others cannot be."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s in _blocks(batches, k):
            at = np.flatnonzero(s.words[-1] != 0)
            for part in (s.words[:-1], s.words[1:]):
                at = at[heavy.has(k - 1, chained([w[at] for w in part], k - 1))]
            words = [w[at] for w in s.words]
            key, first, n = np.unique(chained(words, k), return_index=True, return_counts=True)
            cols = [pa.array(key.view(np.int64)), pa.array(n.astype(np.int64)), *(pa.array(w[first].view(np.int64)) for w in words)]
            yield pa.RecordBatch.from_arrays(cols, names=["key", "n", *(f"w{i + 1}" for i in range(k))])

    return run


def _places(own: np.ndarray, words: np.ndarray) -> np.ndarray:
    return np.where(words == 0, 0, np.searchsorted(own, words) + 1).astype(np.uint32)


def _suffixes(most: int, groups: int, heavy: Heavy):
    """For each block and group: its distinct suffixes in order, with their numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s in _blocks(batches, most):
            if not s.spans.n:
                continue
            length = heavy.lengths(s.words)
            prefix = s.words[0].copy()
            for k in range(2, most + 1):
                at = np.flatnonzero(length == k)
                prefix[at] = chained([w[at] for w in s.words], k)
            group = _dealt(prefix, groups)
            own, here = np.unique(s.words[0], return_inverse=True)
            here = np.concatenate((here + 1, np.zeros(most, np.int64))).astype(np.uint32)
            places = [np.where(w == 0, np.uint32(0), here[k : k + s.spans.n]) for k, w in enumerate(s.words)]
            by = np.lexsort((*places[::-1], group))
            columns = [group[by], *(p[by] for p in places)]
            new = np.ones(len(by), bool)
            new[1:] = reduce(np.logical_or, (c[1:] != c[:-1] for c in columns))
            first = np.flatnonzero(new)
            n = np.diff(first, append=len(by)).astype(np.uint32)
            columns = [c[first] for c in columns]
            cut = runs(columns[0])
            for i, j in zip(cut, [*cut[1:], len(n)]):
                # places of words in the part's own list
                used = np.unique(np.concatenate([c[i:j] for c in columns[1:]]))
                used = used[used > 0]
                local = [_places(used, c[i:j]) for c in columns[1:]]
                local[0] = np.diff(local[0], prepend=np.uint32(0)).astype(np.uint32)
                cols = [_zip(own[used - 1]), _zip(n[i:j]), *(_zip(c) for c in local)]
                yield pa.RecordBatch.from_arrays([pa.array([int(columns[0][i])], pa.int32()), *(pa.array([c], pa.binary()) for c in cols)], names=["grp", "words", "n", *(f"p{k + 1}" for k in range(most))])

    return run


def _subtrees(most: int, least: int, heavy: Heavy):
    """Nodes of a group's subtrees that occur ``least`` times: their words, count and their ancestors' counts."""

    def run(table: pa.Table) -> pa.Table:
        parts: list[list[np.ndarray]] = []
        for row in range(table.num_rows):
            r = {c: table.column(c)[row].as_py() for c in table.column_names}
            own = np.concatenate((np.zeros(1, np.uint64), _unzip(r["words"], np.uint64)))
            places = [_unzip(r[f"p{k + 1}"], np.uint32) for k in range(most)]
            places[0] = np.cumsum(places[0], dtype=np.uint32)
            parts.append([_unzip(r["n"], np.uint32).astype(np.int64), *(own[p] for p in places)])
        n, *words = (np.concatenate(x) for x in zip(*parts))
        by = np.lexsort(words[::-1])
        n, words = n[by], [w[by] for w in words]
        length = heavy.lengths(words)
        total = np.concatenate(([0], np.cumsum(n)))
        counts, out = [], []
        new = np.zeros(len(n), bool)
        new[:1] = True
        for k in range(1, most + 1):
            new[1:] |= words[k - 1][1:] != words[k - 1][:-1]
            first = np.flatnonzero(new)
            f = np.diff(total[np.append(first, len(n))])
            each = np.repeat(f, np.diff(first, append=len(n)))
            # of lengthened prefixes only a part is here
            short = np.flatnonzero(length > k)
            if len(short):
                each[short] = heavy.count(k, chained([w[short] for w in words[:k]], k))
            counts.append(each)
            if k > 1:
                at = first[(words[k - 1][first] != 0) & (each[first] >= least)]
                at = at[length[at] <= k]
                out.append([np.full(len(at), k), *(w[at].view(np.int64) for w in words[:k]), *[None] * (most - k), each[at], *(c[at] for c in counts[:-1]), *[None] * (most - k)])
        names = ["k", *(f"w{i + 1}" for i in range(most)), "a", *(f"l{i + 1}" for i in range(most - 1))]
        tables = [pa.table([pa.nulls(len(x[0]), pa.int64()) if c is None else pa.array(c, pa.int64()) for c in x], names=names) for x in out]
        return pa.concat_tables(tables)

    return run


def phrases(docs: DataFrame, most: int = 3, least: int = 10, lang: str = "lang", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Counted words (lang, key, word, f; without key: all of a language) and counted longer phrases (k, w1, ..., a, l1, ...).

    ``a`` is the count of a phrase of k words, ``l1`` that of its first word, and so on. Words and phrases occur ``least``
    times or more. Both are written tables.
    """
    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col(text).alias("text"))
    spread = group_count(docs, text)
    binary = lambda names: ", ".join(f"{x} binary" for x in names)
    with short_batches(docs.sparkSession, 16):
        sent = rows.mapInArrow(_vocabulary(spread), f"grp int, {binary(('key', 'n', 'lang', 'langs', 'words'))}")
        words = materialise(sent.groupBy("grp").applyInArrow(_counted(least), "lang string, key long, word string, f long"), "words")
        total = words.filter("key IS NULL").agg(F.coalesce(F.sum("f"), F.lit(0))).first()[0]
        heavy = Heavy()
        # as many as the budget goes into all suffixes, at most
        found = words.filter(F.col("key").isNotNull() & (F.col("f") > BUDGET)).select("key", "f").collect()
        heavy.add([r["key"] for r in found], [r["f"] for r in found])
        lengthened = []
        for k in range(2, most + 1):
            if k == most or not len(heavy.keys[-1]):
                break
            names = [f"w{i + 1}" for i in range(k)]
            counted = rows.mapInArrow(_longer(k, heavy), "key long, n long, " + ", ".join(f"{x} long" for x in names)).groupBy("key").agg(F.sum("n").alias("f"), *(F.first(x).alias(x) for x in names))
            found = counted.filter(F.col("f") > BUDGET).collect()
            heavy.add([r["key"] for r in found], [r["f"] for r in found])
            lengthened += [(k, *(r[x] for x in names), *[None] * (most - k), r["f"]) for r in found if r["f"] >= least]
        groups = max(spread, -(-total // BUDGET))
        columns = [f"w{i + 1}" for i in range(most)]
        sent = rows.mapInArrow(_suffixes(most, groups, heavy), f"grp int, {binary(('words', 'n', *(f'p{i + 1}' for i in range(most))))}")
        nodes = sent.groupBy("grp").applyInArrow(_subtrees(most, least, heavy), ", ".join(f"{c} long" for c in ("k", *columns, "a", *(f"l{i + 1}" for i in range(most - 1)))))
        out = materialise(nodes, "phrases")
    if lengthened:
        out = out.unionByName(_with_ancestors(docs.sparkSession, lengthened, most, heavy))
    return words, out


def _with_ancestors(spark: SparkSession, rows: list[tuple], most: int, heavy: Heavy) -> DataFrame:
    """Lengthened prefixes as phrases: all their ancestors are lengthened ones too."""
    out = []
    for k, *words, f in rows:
        own = [np.array([w], np.int64).view(np.uint64) for w in words[:k]]
        before = [int(heavy.count(i, chained(own[:i], i))[0]) for i in range(1, k)]
        out.append((k, *words, f, *before, *[None] * (most - k)))
    return spark.createDataFrame(out, ", ".join(f"{c} long" for c in ("k", *(f"w{i + 1}" for i in range(most)), "a", *(f"l{i + 1}" for i in range(most - 1)))))


def _same(left: list[str], right: list[str]) -> Column:
    return reduce(and_, (F.col(a) == F.col(b) for a, b in zip(left, right)))


def collocations(docs: DataFrame, most: int = 3, least: int = 10, best: int | None = 2000, share: int = 50, lang: str = "lang", text: str = "text") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score), by score, count and phrase; ``best``: of each language, None for all.

    A phrase's score is that of its weakest cut, 1000000 * a * a div (l * r). Phrases inside a longer candidate that
    has at least ``share`` percent of their count are left out.
    """
    words, counted = phrases(docs, most, least, lang, text)
    known = words.filter("key IS NOT NULL")
    scored = None
    w = [f"w{i + 1}" for i in range(most)]
    wide = "decimal(38,0)"
    for k in range(2, most + 1):
        own = counted.filter(F.col("k") == k).select(*w[:k], "a", *(f"l{i}" for i in range(1, k)))
        for cut in range(1, k):
            rest = w[cut:k]
            to = [f"x{i}" for i in range(len(rest))]
            if len(rest) == 1:
                after = known.select(F.col("key").alias("x0"), F.col("f").alias(f"r{cut}"))
            else:
                after = counted.filter(F.col("k") == len(rest)).select(*(F.col(a).alias(b) for a, b in zip(w, to)), F.col("a").alias(f"r{cut}"))
            own = own.join(after, _same(rest, to)).drop(*to)
        at = [F.struct(F.expr(f"(1000000 * cast(a as {wide}) * a) div (cast(l{c} as {wide}) * r{c})").alias("score"), F.lit(c).alias("cut"), F.col(f"l{c}").alias("l"), F.col(f"r{c}").alias("r")) for c in range(1, k)]
        own = own.withColumn("worst", F.least(*at) if k > 2 else at[0])
        longer = [counted.filter(F.col("k") == more).select(*(F.col(a).alias(f"x{i}") for i, a in enumerate(w[s : s + k])), F.col("a").alias("longer")) for more in range(k + 1, most + 1) for s in range(more - k + 1)]
        if longer:
            to = [f"x{i}" for i in range(k)]
            above = reduce(DataFrame.unionByName, longer).groupBy(*to).agg(F.max("longer").alias("longer"))
            own = own.join(above, _same(w[:k], to), "left").filter(F.coalesce(F.lit(100) * F.col("longer") < F.lit(share) * F.col("a"), F.lit(True)))
        for i in range(k):
            name = known.select(F.col("key").alias("x"), F.col("word").alias(f"t{i}"), *(["lang"] if i == 0 else []))
            own = own.join(name, F.col(w[i]) == F.col("x")).drop("x")
        own = own.select("lang", F.concat_ws(" ", *(f"t{i}" for i in range(k))).alias("phrase"), "a", F.col("worst.l").alias("l"), F.col("worst.r").alias("r"), F.col("worst.score").alias("score"))
        scored = own if scored is None else scored.unionByName(own)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    if best is not None:
        # a lane's best first: a language may hold most phrases
        lane = scored.withColumn("lane", F.pmod(F.xxhash64("phrase"), F.lit(64)))
        scored = lane.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "lane").orderBy(*order))).filter(F.col("rank") <= best).drop("lane", "rank")
    ranked = scored.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    ranked = ranked if best is None else ranked.filter(F.col("rank") <= best)
    all_words = words.filter("key IS NULL").groupBy("lang").agg(F.sum("f").alias("n"))
    return ranked.join(all_words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = r"""
WITH p AS (SELECT row_number() OVER () AS p, lang, regexp_extract_all(piece, '[^ \t]+') AS ws
           FROM (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\n\x0B\f\r]')) AS piece FROM documents)),
w AS (SELECT p, lang, unnest(ws) AS a, unnest(range(1, len(ws) + 1)) AS i, ws FROM p),
n AS (SELECT lang, count(*) AS n FROM w GROUP BY lang),
f1 AS (SELECT lang, a, count(*) AS f FROM w GROUP BY ALL),
f2 AS (SELECT lang, a, ws[i + 1] AS b, count(*) AS f FROM w WHERE i < len(ws) GROUP BY ALL),
f3 AS (SELECT lang, a, ws[i + 1] AS b, ws[i + 2] AS c, count(*) AS f FROM w WHERE i + 1 < len(ws) GROUP BY ALL),
s2 AS (SELECT x.lang, x.a || ' ' || x.b AS phrase, x.f AS a, l.f AS l, r.f AS r, CAST((1000000 * CAST(x.f AS HUGEINT) * x.f) // (CAST(l.f AS HUGEINT) * r.f) AS BIGINT) AS score
       FROM f2 x JOIN f1 l ON l.lang = x.lang AND l.a = x.a JOIN f1 r ON r.lang = x.lang AND r.a = x.b
       LEFT JOIN (SELECT lang, a, b, max(f) AS f FROM (SELECT lang, a, b, f FROM f3 WHERE f >= 10 UNION ALL SELECT lang, b, c, f FROM f3 WHERE f >= 10) GROUP BY lang, a, b) m ON m.lang = x.lang AND m.a = x.a AND m.b = x.b
       WHERE x.f >= 10 AND (m.f IS NULL OR 100 * m.f < 50 * x.f)),
s3 AS (SELECT lang, phrase, a, CASE WHEN s1 <= s2 THEN l1 ELSE l2 END AS l, CASE WHEN s1 <= s2 THEN r1 ELSE r2 END AS r, least(s1, s2) AS score FROM
       (SELECT x.lang, x.a || ' ' || x.b || ' ' || x.c AS phrase, x.f AS a, l1.f AS l1, r1.f AS r1, l2.f AS l2, r2.f AS r2,
               CAST((1000000 * CAST(x.f AS HUGEINT) * x.f) // (CAST(l1.f AS HUGEINT) * r1.f) AS BIGINT) AS s1, CAST((1000000 * CAST(x.f AS HUGEINT) * x.f) // (CAST(l2.f AS HUGEINT) * r2.f) AS BIGINT) AS s2
        FROM f3 x JOIN f1 l1 ON l1.lang = x.lang AND l1.a = x.a JOIN f2 r1 ON r1.lang = x.lang AND r1.a = x.b AND r1.b = x.c
        JOIN f2 l2 ON l2.lang = x.lang AND l2.a = x.a AND l2.b = x.b JOIN f1 r2 ON r2.lang = x.lang AND r2.a = x.c WHERE x.f >= 10)),
k AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM (SELECT * FROM s2 UNION ALL SELECT * FROM s3))
SELECT k.lang, rank, phrase, a, l, r, n, score FROM k JOIN n ON n.lang = k.lang WHERE rank <= 2000
"""

QUERIES = {"op11_collocations": op11_collocations}
ORACLES = {"op11_collocations": SQL}
