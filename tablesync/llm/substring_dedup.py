"""Substring dedup: prefix-partitioned suffix trees over words.

Every position with ``window`` words ahead begins a suffix. Suffixes that share a prefix go to one group; the
prefix is as long as its frequency asks for: 1 word, or 2, 4, 8, 16 or ``window`` where shorter ones begin more
than ``CAP`` suffixes. Longer prefixes are counted, over all documents, only below those that are too frequent, so the
list of frequent ones has at most one entry for each ``CAP`` suffixes and length, and a length is counted only while
there are any. A group therefore holds whole subtrees of the suffix tree and fits a task. It sorts its suffixes; a run that shares ``window`` words is an internal node of at least that
depth, a repeat. The suffix that starts first keeps its words, the words under all others go. Neighbouring
nodes of one text, taken together, give the maximal repeats (``repeats``).

Nodes above the depth asked for decide nothing and are not drawn. Suffixes are compared inside their group, by
fingerprints of all their ``window`` words, of 64 bits; groups follow from others, drawn apart. So of n suffixes in g groups, about n**2 / (2**65 g)
pairs of unlike ones are taken for equal: with about a million in a group, one pair in 4e13 suffixes (100 TB).

A block of documents sorts its own suffixes first and sends the first of each node only to its group; the others are
later ones already, and go straight to where their documents' repeats are gathered. So a passage adds one suffix a
block to its group, however often it occurs.

Nulls and empties: null or empty text has no words, a null id comes before all others. Rows that repeat both
id and text are one document, and each gets its result. Other columns are left alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.llm.common import group_count, materialise, pack, row_key, runs, unpack
from tablesync.llm.words import Words, grams, inside, mix

BLOCK = 8 << 20
GROUP = 12 << 20
CAP = 1 << 18
LENGTHS = (1, 2, 4, 8, 16)
NULL_ID = -(1 << 63)
SECOND = np.uint64(0x6A09E667F3BCC909)


def _texts(column: pa.ChunkedArray) -> list[bytes | None]:
    return column.cast(pa.binary()).to_pylist()


class Suffixes:
    """Suffixes of a block's documents, in the order of (id, row key, position): each has ``window`` words at least."""

    def __init__(self, ids: list, keys: list, texts: list, window: int):
        ids, keys = np.array(ids, np.int64), np.array(keys, np.int64)
        order = np.lexsort((keys, ids))
        one = np.concatenate(([True], (np.diff(ids[order]) != 0) | (np.diff(keys[order]) != 0)))
        order = order[one]
        w = Words([texts[i] for i in order])
        self.ids, self.keys = ids[order], keys[order]
        self.at, self.h, self.window = inside(w.first, window), w.hashes(lower=False), window
        self.doc = w.doc[self.at].astype(np.int32)
        self.pos = (self.at - w.first[self.doc]).astype(np.int32)

    def prefixes(self) -> Iterator[np.ndarray]:
        """Fingerprints of the suffixes' first words, for each of ``LENGTHS`` below the window."""
        span, width, q = self.h, 1, 0x8CB92BA72F3D8DD7 | 1
        for length in LENGTHS:
            if length >= self.window:
                return
            while width < length:
                span = span[: len(span) - width] + span[width:] * np.uint64(pow(q, width, 1 << 64))
                width *= 2
            yield mix(span[self.at])


def _blocks(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[Suffixes]:
    """About ``BLOCK`` bytes of text at a time."""
    ids, keys, texts, size = [], [], [], 0
    for b in batches:
        for i, k, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), _texts(b.column(2))):
            ids.append(NULL_ID if i is None else i)
            keys.append(k)
            texts.append(t)
            size += len(t or b"")
            if size >= BLOCK:
                yield Suffixes(ids, keys, texts, window)
                ids, keys, texts, size = [], [], [], 0
    if ids:
        yield Suffixes(ids, keys, texts, window)


class Heavy:
    """For each of ``LENGTHS`` that was counted, the sorted fingerprints of the prefixes that are too frequent."""

    def __init__(self, levels: list[np.ndarray] | None = None):
        self.levels = levels or []

    def has(self, n: int, prefix: np.ndarray) -> np.ndarray:
        if n >= len(self.levels) or not len(self.levels[n]):
            return np.zeros(len(prefix), bool)
        own = self.levels[n]
        return own[np.minimum(np.searchsorted(own, prefix), len(own) - 1)] == prefix


def _group(prefix: np.ndarray, groups: int) -> np.ndarray:
    return ((mix(prefix) & np.uint64(0xFFFFFFFF)) * np.uint64(groups) >> np.uint64(32)).astype(np.int64)


def _count(window: int, groups: int, heavy: Heavy):
    """For each block and group: numbers of suffixes by the first prefix length that ``heavy`` does not know yet, of
    those whose shorter prefixes are all heavy."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s in _blocks(batches, window):
            left = np.arange(len(s.at))
            for n, own in enumerate(s.prefixes()):
                if n == len(heavy.levels):
                    prefix, many = np.unique(own[left], return_counts=True)
                    group = _group(prefix, groups)
                    by = np.argsort(group, kind="stable")
                    cut = runs(group[by])
                    each = [by[i:j] for i, j in zip(cut, [*cut[1:], len(by)])]
                    packed = [[prefix[at].tobytes() for at in each], [pa.compress(pack(many[at].astype(np.int64)), "zstd", asbytes=True) for at in each]]
                    cols = [pa.array(group[by][cut].astype(np.int32)), *(pa.array(x, pa.binary()) for x in packed)]
                    yield pa.RecordBatch.from_arrays(cols, names=["grp", "prefix", "n"])
                    break
                left = left[heavy.has(n, own[left])]

    return run


def _frequent(cap: int):
    """The prefixes of a group that begin more than ``cap`` suffixes."""

    def run(table: pa.Table) -> pa.Table:
        prefix = [np.frombuffer(x.as_buffer(), np.uint64) for x in table.column("prefix")]
        n = [unpack(pa.decompress(x.as_buffer(), 8 * len(p), "zstd", asbytes=True), np.int64) for p, x in zip(prefix, table.column("n"))]
        prefix, n = np.concatenate(prefix), np.concatenate(n)
        by = np.argsort(prefix)
        cut = runs(prefix[by])
        return pa.table({"prefix": pa.array(prefix[by][cut][np.add.reduceat(n[by], cut) > cap].view(np.int64))})

    return run


def groups_of(s: Suffixes, whole: np.ndarray, heavy: Heavy, groups: int) -> np.ndarray:
    """Each suffix's group, by the shortest of its prefixes that is not heavy, else all its words."""
    prefix, left = whole.copy(), np.arange(len(whole))
    for n, own in enumerate(s.prefixes()):
        more = heavy.has(n, own[left])
        prefix[left[~more]] = own[left[~more]]
        left = left[more]
        if not len(left):
            break
    return _group(prefix, groups)


def _places(s: Suffixes, at: np.ndarray) -> bytes:
    """Ids, row keys and positions of the suffixes ``at`` (in order), packed by document."""
    doc, pos = s.doc[at], s.pos[at]
    r = runs(doc)
    step = np.diff(pos, prepend=np.int32(0))
    step[r] = pos[r]
    docs = doc[r]
    body = b"".join((pack(np.diff(s.ids[docs], prepend=0)), s.keys[docs].tobytes(), pack(np.diff(r, append=len(at)).astype(np.int32)), pack(step)))
    return len(r).to_bytes(4, "little") + len(at).to_bytes(4, "little") + pa.compress(body, "zstd", asbytes=True)


def _read_places(b: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    many, n = int.from_bytes(b[:4], "little"), int.from_bytes(b[4:8], "little")
    body = pa.decompress(b[8:], 20 * many + 4 * n, "zstd", asbytes=True)
    ids, keys, size = np.cumsum(unpack(body[: 8 * many], np.int64)), np.frombuffer(body[8 * many : 16 * many], np.int64), unpack(body[16 * many : 20 * many], np.int32)
    step = unpack(body[20 * many :], np.int32).astype(np.int64)
    total, begin = np.cumsum(step), np.cumsum(size) - size
    return np.repeat(ids, size), np.repeat(keys, size), total - np.repeat(total[begin] - step[begin], size)


def _suffixes(window: int, groups: int, heavy: Heavy):
    """For each block and group: the fingerprints of its first suffixes; and, in groups of their own by document, the
    later ones, without fingerprints."""
    schema = pa.schema([("grp", pa.int32()), ("first", pa.binary()), ("places", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s in _blocks(batches, window):
            if not len(s.at):
                continue
            h = grams(s.h, window)[s.at]
            group = groups_of(s, grams(mix(s.h ^ SECOND), window)[s.at], heavy, groups)
            by = np.lexsort((h, group))
            first = np.ones(len(by), bool)
            first[by[1:]] = (h[by][1:] != h[by][:-1]) | (group[by][1:] != group[by][:-1])
            group[~first] = groups + (s.keys[s.doc[~first]].view(np.uint64) % np.uint64(groups)).astype(np.int64)
            by = np.argsort(group, kind="stable")
            cut = runs(group[by])
            for i, j in zip(cut, [*cut[1:], len(by)]):
                at = by[i:j]
                prints = h[at].tobytes() if first[at[0]] else None
                yield pa.RecordBatch.from_pydict({"grp": [int(group[at[0]])], "first": [prints], "places": [_places(s, at)]}, schema=schema)

    return run


def later(h: np.ndarray, doc: np.ndarray, row: np.ndarray, pos: np.ndarray) -> np.ndarray:
    """Places in the arrays of the suffixes whose node has another one that starts earlier."""
    by = np.argsort(h)
    same = np.zeros(len(h), bool)
    equal = h[by][1:] == h[by][:-1]
    same[1:] |= equal
    same[:-1] |= equal
    by = by[same]
    by = by[np.lexsort((pos[by], row[by], doc[by], h[by]))]
    node = runs(h[by])
    first = np.repeat(by[node], np.diff(node, append=len(by)))
    return by[(doc[by] != doc[first]) | (row[by] != row[first]) | (pos[by] != pos[first])]


def _nodes(parts: int):
    """Of a group's subtrees: the suffixes that are not the first of their node, dealt by document."""

    def run(table: pa.Table) -> pa.Table:
        prints, firsts, others = [], [], []
        for b, p in zip(table.column("first"), table.column("places")):
            places = _read_places(p.as_buffer().to_pybytes())
            if b.is_valid:
                prints.append(b.as_buffer())
                firsts.append(places)
            else:
                others.append(places)
        row = pos = np.zeros(0, np.int64)
        if firsts:
            h = np.concatenate([np.frombuffer(b, np.uint64) for b in prints])
            doc, row, pos = (np.concatenate(x) for x in zip(*firsts))
            at = later(h, doc, row, pos)
            row, pos = row[at], pos[at]
        row, pos = np.concatenate([row, *(x[1] for x in others)]), np.concatenate([pos, *(x[2] for x in others)])
        part = (row.view(np.uint64) % np.uint64(parts)).astype(np.int64)
        by = np.lexsort((pos, row, part))
        part, row, pos = part[by], row[by], pos[by].astype(np.int32)
        cut = runs(part)
        each = [slice(i, j) for i, j in zip(cut, [*cut[1:], len(row)])]
        return pa.table({"part": pa.array(part[cut].astype(np.int32)), "row": pa.array([pack(row[x]) for x in each], pa.binary()), "pos": pa.array([pack(pos[x]) for x in each], pa.binary())})

    return run


def _by_document(window: int):
    """A row for each document with repeats: word ranges [from, to) under later suffixes, packed."""

    def run(table: pa.Table) -> pa.Table:
        row = np.concatenate([unpack(x.as_buffer(), np.int64) for x in table.column("row")])
        pos = np.concatenate([unpack(x.as_buffer(), np.int32) for x in table.column("pos")]).astype(np.int64)
        by = np.lexsort((pos, row))
        row, pos = row[by], pos[by]
        new = np.concatenate(([True], row[1:] != row[:-1]))
        cut = np.flatnonzero(new | np.concatenate(([True], pos[1:] > pos[:-1] + window)))
        begin, end = pos[cut], pos[np.append(cut[1:], len(pos)) - 1] + window
        docs = np.searchsorted(cut, np.flatnonzero(new))
        return pa.table({"row_key": pa.array(row[cut[docs]]), "ranges": pa.array([np.stack((begin[i:j], end[i:j])).tobytes() for i, j in zip(docs, [*docs[1:], len(cut)])], pa.binary())})

    return run


def repeats(docs: DataFrame, window: int = 20, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(row_key, ranges): for each document with a repeat that starts earlier elsewhere, its maximal word
    ranges; ``ranges`` packs int64 starts, then ends."""
    groups = group_count(docs, text, GROUP)
    keyed = docs.select(F.col(doc_id).cast("long").alias("id"), row_key(doc_id, text).alias("row_key"), F.col(text).alias("text"))
    heavy = Heavy()
    while len(heavy.levels) < sum(x < window for x in LENGTHS):
        counts = keyed.mapInArrow(_count(window, groups, heavy), "grp int, prefix binary, n binary")
        found = np.array(counts.groupBy("grp").applyInArrow(_frequent(CAP), "prefix long").toArrow().column(0).to_numpy(), np.int64)
        heavy.levels.append(np.sort(found.view(np.uint64)))
        if not len(found):
            break
    sent = keyed.mapInArrow(_suffixes(window, groups, heavy), "grp int, first binary, places binary")
    found = sent.groupBy("grp").applyInArrow(_nodes(groups), "part int, row binary, pos binary")
    return found.groupBy("part").applyInArrow(_by_document(window), "row_key long, ranges binary")


def _rest(digest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 500):
                part = b.slice(lo, 500)
                texts, ranges = _texts(part.column(1)), part.column(2).to_pylist()
                w = Words(texts)
                out = []
                for k, spans in enumerate(ranges):
                    i, j = int(w.first[k]), int(w.first[k + 1])
                    keep = np.ones(j - i, bool)
                    if spans:
                        for x, y in np.frombuffer(spans, np.int64).reshape(2, -1).T:
                            keep[x:y] = False
                    if keep.all():
                        kept = texts[k] or b""
                        kept = b" ".join(kept.split())
                    else:
                        data = w.data
                        kept = b" ".join([data[s:e].tobytes() for s, e in zip(w.start[i:j][keep], w.end[i:j][keep])])
                    out.append((j - i, int((~keep).sum()), hashlib.sha256(kept).hexdigest() if digest else kept.decode()))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64()), pa.array([x[2] for x in out], pa.string())],
                    names=["doc_id", "n_words", "n_removed", "kept"],
                )

    return run


def remove_repeats(docs: DataFrame, window: int = 20, doc_id: str = "doc_id", text: str = "text", digest: bool = False) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): each document without the words under repeats that start earlier.

    ``kept``: the remaining words, joined by a space; with ``digest`` their SHA-256 instead.
    """
    spans = materialise(repeats(docs, window, doc_id, text), "repeats")
    keyed = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), row_key(doc_id, text).alias("row_key"))
    return keyed.join(spans, "row_key", "left").select("doc_id", "text", "ranges").mapInArrow(_rest(digest), "doc_id long, n_words long, n_removed long, kept string")


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return remove_repeats(docs, digest=True).withColumnRenamed("kept", "kept_sha256")


SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^ \t\n\x0B\f\r]+') AS ws FROM documents),
win AS (SELECT doc_id, i, array_to_string(list_slice(ws, i, i + 19), ' ') AS g
        FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS i FROM w WHERE len(ws) >= 20)),
dup AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY g ORDER BY doc_id, i) AS rn FROM win) WHERE rn > 1),
gone AS (SELECT doc_id, list(DISTINCT j) AS js FROM (SELECT doc_id, unnest(range(i, i + 20)) AS j FROM dup) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(len(js), 0) AS BIGINT) AS n_removed,
       sha256(array_to_string(CASE WHEN js IS NULL THEN ws
              ELSE list_transform(list_filter(list_zip(ws, range(1, len(ws) + 1)), lambda x: NOT list_contains(js, x[2])), lambda x: x[1]) END, ' ')) AS kept_sha256
FROM w LEFT JOIN gone USING (doc_id)
"""

QUERIES = {"op10_substring_dedup": op10_substring_dedup}
ORACLES = {"op10_substring_dedup": SQL}
